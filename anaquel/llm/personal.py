"""Personal data: e-mail and IP addresses, card and phone numbers.

Base rules find spans by pattern and check; a character-level bidirectional LSTM with CRF transitions adds
spans that are written in other ways. It is trained in numpy, on the driver, from labelled spans: those that
the base rules find in a bounded sample of the documents (``Settings.sample`` of those with a digit or @, the
first by a hash of id and text, whole texts), and rewritten forms of them. Every kind holds a digit or an @, so
the stretches around these characters are decoded, all of them, in whole texts; long stretches are cut into
overlapping windows. Where windows overlap, each character takes the label from the window in whose
middle it lies deepest; spans are read off the united labels. A span that overlaps a base span, or fails its
kind's check, is not added.

Offsets count code points, the end is exclusive. Null texts count as empty and hold no spans. Rows are judged
each by itself, so repeated rows and ids give repeated results. A sample without base spans trains no
model, and nothing is added. An empty table gives an empty table. Other columns are kept; a column of the
written name is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import with_arrow_column

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Runs are possessive and start where no digit stands before, so a long run of digits is read once.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
EMAIL_CHARACTER = re.compile(r"[A-Za-z0-9._%+-]")
DIGIT = re.compile(r"[0-9]")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def sound_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def sound_card(text: str) -> bool:
    number = digits(text)
    return 12 <= len(number) <= 19 and luhn(number)


def sound_phone(text: str) -> bool:
    return 9 <= len(digits(text)) <= 15


def emails(text: str) -> list[Span]:
    """What the pattern finds from left to right, in time linear in the text: the part before an @ is the
    whole run of its characters, back to the last match."""
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and not NOT_LOCAL.match(text[begin - 1]):
            begin -= 1
        free = max(free, at + 1)
        if begin < at and (match := DOMAIN.match(text, at)):
            found.append(("email", begin, match.end()))
            free = match.end()
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[Span]:
    found = emails(text) if "@" in text else []
    for match in IP.finditer(text):
        if sound_ip(match.group()):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        if sound_card(match.group()):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in PHONE.finditer(text):
            if sound_phone(match.group()):
                found.append(("phone", *match.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the documents that training reads, ``windows`` its examples."""

    sample: int = 1_500
    windows: int = 3_000
    embedding: int = 10
    hidden: int = 16
    epochs: int = 6
    batch: int = 32
    rate: float = 0.01
    seed: int = 11
    reach: int = 32
    width: int = 128


#: Characters as the model sees them: digits and white space are one each, letters by case, signs by themselves.
SIGNS = "@.+-_()[]{}<>:;,/\\|%#&*=!?'\"~^$"
CHARACTERS = 7 + len(SIGNS)
TAGS = 1 + 2 * len(KINDS)


def character(c: str) -> int:
    if c.isdigit():
        return 1
    if c.isspace():
        return 2
    if c.isalpha():
        return (3 if c.islower() else 4) if c.isascii() else 5
    return 7 + SIGNS.index(c) if c in SIGNS else 6


def stretches(text: str, s: Settings) -> list[tuple[int, int]]:
    """Windows over all places within reach of a digit or an @."""
    windows, begin, end = [], None, None
    for match in re.finditer(r"[0-9@]+", text):
        if begin is None or match.start() - s.reach > end:
            if begin is not None:
                windows.append((begin, end))
            begin = max(0, match.start() - s.reach)
        end = min(len(text), match.end() + s.reach)
    if begin is not None:
        windows.append((begin, end))
    cut = []
    for begin, end in windows:
        step = s.width // 2
        starts = range(begin, max(begin + 1, end - s.width + step), step)
        cut += [(at, min(end, at + s.width)) for at in starts]
    return cut


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states of a batch, time first; states stay zero where ``mask`` is zero."""
    steps, rows, hidden = x.shape[0], x.shape[1], u.shape[0]
    h, c = np.zeros((rows, hidden), np.float32), np.zeros((rows, hidden), np.float32)
    pre, out, kept = x @ w + b, np.zeros((steps, rows, hidden), np.float32), []
    for t in range(steps):
        z = pre[t] + h @ u
        i, f, o = (sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in range(3))
        g = np.tanh(z[:, 3 * hidden :])
        before_h, before_c, m = h, c, mask[t][:, None]
        c = m * (f * c + i * g)
        wave = np.tanh(c)
        h = m * o * wave
        out[t] = h
        if keep:
            kept.append((i, f, o, g, before_h, before_c, wave, m))
    return out, kept


def lstm_back(grad: np.ndarray, kept: list, x: np.ndarray, w: np.ndarray, u: np.ndarray):
    """Gradients of the input and of the three parameters."""
    hidden = u.shape[0]
    dw, du, db, dx = np.zeros_like(w), np.zeros_like(u), np.zeros(4 * hidden, np.float32), np.zeros_like(x)
    dh_next, dc_next = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(kept) - 1, -1, -1):
        i, f, o, g, before_h, before_c, wave, m = kept[t]
        dh = (grad[t] + dh_next) * m
        dc = (dc_next + dh * o * (1 - wave * wave)) * m
        dz = np.hstack([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * wave * o * (1 - o), dc * i * (1 - g * g)])
        dw += x[t].T @ dz
        du += before_h.T @ dz
        db += dz.sum(axis=0)
        dx[t] = dz @ w.T
        dh_next, dc_next = dz @ u.T, dc * f
    return dx, dw, du, db


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """The network: embeddings, an LSTM in each direction, emissions, transitions."""

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        small = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        e, h = s.embedding, s.hidden
        self.s = s
        self.p = {"embed": small(CHARACTERS, e), "emit": small(2 * h, TAGS), "emit_b": np.zeros(TAGS, np.float32), "trans": small(TAGS, TAGS)}
        for side in "fb":
            self.p |= {f"w{side}": small(e, 4 * h), f"u{side}": small(h, 4 * h), f"b{side}": np.zeros(4 * h, np.float32)}

    def emissions(self, chars: np.ndarray, mask: np.ndarray, keep: bool = False):
        p, x = self.p, self.p["embed"][chars]
        ahead, kept_f = lstm(x, mask, p["wf"], p["uf"], p["bf"], keep)
        back, kept_b = lstm(x[::-1], mask[::-1], p["wb"], p["ub"], p["bb"], keep)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return both @ p["emit"] + p["emit_b"], (x, both, kept_f, kept_b)

    def gradients(self, chars: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch by the CRF's forward and backward sums."""
        p = self.p
        emit, (x, both, kept_f, kept_b) = self.emissions(chars, mask, keep=True)
        steps, rows = chars.shape
        trans, m = p["trans"], mask[:, :, None]
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0]
        for t in range(1, steps):
            step = log_sum(alpha[t - 1][:, :, None] + trans, 1) + emit[t]
            alpha[t] = np.where(m[t] > 0, step, alpha[t - 1])
        for t in range(steps - 2, -1, -1):
            step = log_sum(trans + (emit[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(m[t + 1] > 0, step, beta[t + 1])
        z = log_sum(alpha[-1], 1)
        hot = np.eye(TAGS, dtype=np.float32)[tags]
        d_emit = (np.exp(alpha + beta - z[None, :, None]) - hot) * m / rows
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            pair = np.exp(alpha[t - 1][:, :, None] + trans + (emit[t] + beta[t])[:, None, :] - z[:, None, None])
            d_trans += ((pair - hot[t - 1][:, :, None] * hot[t][:, None, :]) * mask[t][:, None, None]).sum(axis=0) / rows
        gold = (emit * hot * m).sum() + (trans[tags[:-1], tags[1:]] * mask[1:]).sum()
        flat = both.reshape(-1, both.shape[2])
        g = {"emit": flat.T @ d_emit.reshape(-1, TAGS), "emit_b": d_emit.sum(axis=(0, 1)), "trans": d_trans}
        d_both = d_emit @ p["emit"].T
        h = self.s.hidden
        dx, g["wf"], g["uf"], g["bf"] = lstm_back(d_both[:, :, :h], kept_f, x, p["wf"], p["uf"])
        dxb, g["wb"], g["ub"], g["bb"] = lstm_back(d_both[::-1, :, h:], kept_b, x[::-1], p["wb"], p["ub"])
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], chars, dx + dxb[::-1])
        return float((z.sum() - gold) / rows), g

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray]]) -> "Tagger":
        s, rng = self.s, np.random.default_rng(self.s.seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second, step = {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for _ in range(s.epochs):
            order = rng.permutation(len(examples))
            for begin in range(0, len(order), s.batch):
                rows = [examples[r] for r in order[begin : begin + s.batch]]
                chars, mask = batch([c for c, _ in rows])
                tags = np.zeros(chars.shape, np.int64)
                for k, (_, t) in enumerate(rows):
                    tags[: len(t), k] = t
                _, grads = self.gradients(chars, mask, tags)
                step += 1
                scale = min(1.0, 5.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads.values())) + 1e-9))
                for k, g in grads.items():
                    g = g * scale
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    fair = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                    self.p[k] = (self.p[k] - s.rate * first[k] / (1 - 0.9**step) / fair).astype(np.float32)
        return self

    def decode(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each window."""
        out: list[np.ndarray] = []
        for begin in range(0, len(windows), 256):
            rows = windows[begin : begin + 256]
            chars, mask = batch(rows)
            emit, _ = self.emissions(chars, mask)
            steps, count = chars.shape
            best, came = emit[0], np.zeros((steps, count, TAGS), np.int8)
            for t in range(1, steps):
                ways = best[:, :, None] + self.p["trans"]
                came[t] = ways.argmax(axis=1)
                best = np.where(mask[t][:, None] > 0, ways.max(axis=1) + emit[t], best)
            for k, row in enumerate(rows):
                tags = np.zeros(len(row), np.int8)
                tag = int(best[k].argmax())
                for t in range(len(row) - 1, -1, -1):
                    tags[t] = tag
                    tag = int(came[t, k, tag])
                out.append(tags)
        return out


def batch(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows side by side, time first, and where they have characters."""
    width = max(map(len, rows))
    chars, mask = np.zeros((width, len(rows)), np.int64), np.zeros((width, len(rows)), np.float32)
    for k, row in enumerate(rows):
        chars[: len(row), k] = row
        mask[: len(row), k] = 1
    return chars, mask


def coded(text: str) -> np.ndarray:
    return np.array([character(c) for c in text], np.int64)


def rewritten(kind: str, text: str, rng: np.random.Generator) -> str:
    """Another way to write a span of the kind."""
    way = int(rng.integers(4))
    if kind == "email":
        return [text, text.replace("@", " @ "), text.replace("@", " @"), text.replace("@", "(@)")][way]
    if kind == "phone":
        rest = text[1:]
        return [text, rest, "00" + rest, "(0)" + rest][way]
    if kind == "card":
        number = digits(text)
        return [text, *[sign.join(number[i : i + 4] for i in range(0, len(number), 4)) for sign in (".", "_", " - ")]][way]
    return [text, text.replace(".", " . "), text.replace(".", ". "), text.replace(".", "-")][way]


def examples(texts: list[str], s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows with their tags; every second window with spans is rewritten."""
    rng, made = np.random.default_rng(s.seed), []
    for text in texts:
        spans, free = [], 0
        for span in base_spans(text):
            if span[1] >= free:
                spans.append(span)
                free = span[2]
        for begin, end in stretches(text, s):
            inside = [x for x in spans if x[1] >= begin and x[2] <= end]
            pieces, tags, at, rewrite = [], [], begin, rng.random() < 0.5
            for kind, first, last in inside:
                form = rewritten(kind, text[first:last], rng) if rewrite else text[first:last]
                tag = 1 + 2 * KINDS.index(kind)
                pieces += [text[at:first], form]
                tags += [0] * (first - at) + [tag] + [tag + 1] * (len(form) - 1)
                at = last
            pieces.append(text[at:end])
            tags += [0] * (end - at)
            made.append((coded("".join(pieces)), np.array(tags, np.int64)))
    return [made[i] for i in rng.permutation(len(made))[: s.windows]]


def train(texts: list[str], s: Settings = Settings()) -> Tagger | None:
    found = examples(texts, s)
    if not any(tags.any() for _, tags in found):
        return None
    return Tagger(s).fit(found)


def fit(docs: DataFrame, s: Settings = Settings()) -> Tagger | None:
    able = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("doc_id", "text").alias("draw"))
    # The sample is drawn from hashes alone, then its texts are read; equal rows count once.
    chosen = able.select("draw").distinct().orderBy("draw").limit(s.sample)
    rows = able.join(F.broadcast(chosen), "draw").groupBy("draw").agg(F.min("text").alias("text")).toPandas()
    return train(sorted(rows["text"]), s)


def sound(kind: str, text: str) -> bool:
    if kind == "email":
        name, _, host = re.sub(r"[\s()\[\]]", "", text).partition("@")
        return bool(LOCAL.fullmatch(name)) and bool(re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", host))
    return {"ip": sound_ip, "card": sound_card, "phone": sound_phone}[kind](text)


def all_spans(texts: list[str], model: Tagger | None) -> list[list[tuple[str, int, int, bool]]]:
    """The spans of each text with whether the base rules found them, by start, then kind."""
    base = [base_spans(t) for t in texts]
    cut = [stretches(t, model.s) if model else [] for t in texts]
    decoded = iter(model.decode([coded(t[b:e]) for t, windows in zip(texts, cut) for b, e in windows]) if model else [])
    out = []
    for text, spans, windows in zip(texts, base, cut):
        tags: dict[int, tuple[int, int]] = {}  # place: depth in its window, tag
        for begin, end in windows:
            for k, tag in enumerate(next(decoded)):
                depth = min(k if begin else 1 << 30, end - begin - 1 - k if end < len(text) else 1 << 30)
                if begin + k not in tags or depth > tags[begin + k][0]:
                    tags[begin + k] = (depth, int(tag))
        added, open_kind, first = [], None, 0
        for at in [*sorted(tags), None]:
            tag = tags[at][1] if at is not None else 0
            goes_on = open_kind is not None and tag == 2 + 2 * open_kind and at == last + 1  # noqa: F821
            if open_kind is not None and not goes_on:
                added.append((KINDS[open_kind], first, last + 1))  # noqa: F821
                open_kind = None
            if tag and not goes_on:
                open_kind, first = (tag - 1) // 2, at
            last = at
        kept = [(*x, True) for x in spans]
        taken = sorted((b, e) for _, b, e in spans)
        at = 0
        for kind, begin, end in added:
            begin, end = to_edges(text, kind, begin, end)
            while at < len(taken) and taken[at][1] <= begin:
                at += 1
            if begin < end and not any(b < end and begin < e for b, e in taken[at : at + 4]) and sound(kind, text[begin:end]):
                kept.append((kind, begin, end, False))
        out.append(sorted(kept, key=lambda x: (x[1], KINDS.index(x[0]))))
    return out


def to_edges(text: str, kind: str, begin: int, end: int) -> tuple[int, int]:
    """A tagged span without white space at its ends, grown over the characters that its ends cut through."""
    while begin < end and text[begin].isspace():
        begin += 1
    while begin < end and text[end - 1].isspace():
        end -= 1
    inner = EMAIL_CHARACTER if kind == "email" else DIGIT
    while begin < end and begin and inner.match(text[begin]) and inner.match(text[begin - 1]):
        begin -= 1
    while begin < end < len(text) and inner.match(text[end - 1]) and inner.match(text[end]):
        end += 1
    return begin, end


FOUND = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
FOUND_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find(docs: DataFrame, model: Tagger | None, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` plus all spans of each whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ("kind", "start", "end", "base")

    def make(texts: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(texts), 500):
            part = [x or "" for x in texts.slice(at, 500).to_pylist()]
            found += [[dict(zip(names, x)) for x in spans] for spans in all_spans(part, sent.value)]
        return pa.array(found, FOUND_ARROW)

    return with_arrow_column(docs, [text], out, FOUND, make, FOUND_ARROW)


def masked(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with each stretch of spans replaced by its first kind in brackets."""
    pieces, at = [], 0
    for kind, begin, end, _ in spans:
        if begin >= at:
            pieces += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(pieces) + text[at:] if pieces else text


def mask(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text`` masked; null texts stay null."""
    order = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for at in range(0, len(texts), 500):
            part = texts.slice(at, 500).to_pylist()
            out += [masked(t, s) for t, s in zip(part, all_spans([t or "" for t in part], sent.value))]
        return pa.array(out, pa.string())

    return with_arrow_column(docs, [text], text, "string", make, pa.string()).select(*order)
