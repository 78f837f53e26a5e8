"""Toxicity: a classifier that is regularised by counterfactuals.

A word's share of the score is the sum of learned weights, one for the word (hashed) and one for each of its
character n-grams (hashed), over the root of their number. A sentence (a run of up to ``window`` words up to a mark
that ends it) sums its words. A document takes the smooth maximum of its sentences, so a few bad sentences count in a
long text as they do in a short one, and the number of harmless sentences does not matter. A sigmoid gives the score.

Counterfactuals: identity terms come in groups (religions, origins, and so on). Where a sentence of a labelled document
holds such terms, each step of training draws others of their groups, and the squared difference between the scores of
the sentence and of the swapped sentence is a penalty of weight ``penalty``. What tells groups apart is unlearned, so a
neutral mention of a group does not look toxic because toxic documents mention it more often.

Training follows the regularised leader (FTRL, whose ``sparsity`` keeps features that tell little at exactly 0, so that
long texts gather no noise) in numpy on the driver, on a bounded sample of the labelled rows: at most ``sample`` documents, the
first by a hash of their id, each of at most ``longest_text`` characters (longer ones are not in the sample); whole
texts. Scoring runs on all rows, whole texts, in the tasks; each distinct word of a batch is weighed once.

Null texts count as empty; a text without words has the score of the bias alone. Labels that are null are no labels; a
document with contradicting labels trains by each of them; null ids match no labels. Without labels of both classes the
score is the share of label 1 (0.5 if there are none). Other columns are kept; a column of the written name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import with_arrow_column
from anaquel.llm.quality import features

#: Groups of identity terms, each a list of words that can stand for each other.
IDENTITIES = (
    ("woman", "man", "girl", "boy", "wife", "husband", "mother", "father"),
    ("women", "men", "girls", "boys", "wives", "husbands", "mothers", "fathers"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    ("african", "american", "arab", "asian", "chinese", "european", "indian", "latino", "mexican", "turkish"),
    ("black", "white", "brown"),
    ("gay", "lesbian", "bisexual", "straight", "transgender", "queer"),
    ("blind", "deaf", "disabled", "autistic"),
    ("old", "elderly", "young", "teenage"),
    ("frau", "mann", "mädchen", "junge"), ("christen", "muslime", "juden", "hindus"),
    ("femme", "homme", "fille", "garçon"), ("chrétiens", "musulmans", "juifs", "hindous"),
    ("mujer", "hombre", "chica", "chico"), ("cristianos", "musulmanes", "judíos", "hindúes"),
)


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``longest_text`` bound the training documents; the rest shapes the model."""

    sample: int = 6_000
    longest_text: int = 50_000
    buckets: int = 1 << 18
    shortest: int = 3
    longest: int = 5
    window: int = 10
    sharpness: float = 2.0
    penalty: float = 1.0
    sparsity: float = 1.0
    epochs: int = 8
    updates: int = 400
    batch: int = 64
    rate: float = 0.2
    seed: int = 11


CHUNK = 20_000


def cut(texts: pa.Array, s: Settings) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the place among them of each word of all texts, where sentences begin, and each one's text."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    marked = pc.replace_substring_regex(lower, r"[.!?\n\r]+", " . ")
    split = pc.utf8_split_whitespace(pc.replace_substring_regex(marked, r"[^\p{L}\p{M}\p{N}.]+", " "))
    coded = pc.dictionary_encode(split.flatten())
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = coded.dictionary.to_pylist()
    edges = split.offsets.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    mark, empty = (names.index(w) if w in names else -1 for w in (".", ""))
    sentence = np.cumsum(at == mark)
    kept = (at != mark) & (at != empty)
    at, owner, sentence = at[kept], owner[kept], sentence[kept]
    opens = np.ones(len(at), bool)
    opens[1:] = (owner[1:] != owner[:-1]) | (sentence[1:] != sentence[:-1])
    starts = np.flatnonzero(opens)
    within = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    starts = np.flatnonzero(within % s.window == 0)
    return names, at, starts, owner[starts]


def pooled(scores: np.ndarray, first: np.ndarray, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
    """The smooth maximum of each stretch of sentences, and each sentence's share in it (their sum is 1)."""
    sizes = np.diff(np.append(first, len(scores)))
    weight = np.exp(sharpness * (scores - np.repeat(np.maximum.reduceat(scores, first), sizes)))
    weight /= np.repeat(np.add.reduceat(weight, first), sizes)
    return np.add.reduceat(scores * weight, first), weight


@dataclass(frozen=True)
class Model:
    settings: Settings
    of_feature: np.ndarray | None
    bias: float

    def of_words(self, words: list[str]) -> np.ndarray:
        places, counts = features(words, self.settings)
        return np.add.reduceat(self.of_feature[places], np.cumsum(counts) - counts) / np.sqrt(counts)

    def score(self, texts: pa.Array) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        if self.of_feature is not None and len(texts):
            names, at, starts, owner = cut(texts, self.settings)
            if len(at):
                of_word = np.concatenate([self.of_words(names[k : k + CHUNK]) for k in range(0, len(names), CHUNK)])
                sentences = np.add.reduceat(of_word[at], starts)
                first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                odds[owner[first]] += pooled(sentences, first, self.settings.sharpness)[0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def train(texts: list[str | None], labels: list[int], s: Settings = Settings(), identities=IDENTITIES) -> Model:
    """Fit the weights on log loss plus the penalty for scores that change when identity terms are swapped."""
    y = np.array(labels, np.float64)
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(s, None, float(np.log(share / (1 - share))))
    bias = float(np.log(share / (1 - share)))
    names, at, starts, owner = cut(pa.array(texts, pa.string()), s)
    number = {w: i for i, w in enumerate(names)}
    for w in (w for group in identities for w in group):
        number.setdefault(w, len(number))
    names = list(number)
    places, counts = features(names, s)
    begins, root = np.cumsum(counts, dtype=np.int64) - counts, np.sqrt(counts)
    # Other terms of each identity term's group, by word; a word of several groups belongs to the first.
    others: dict[int, np.ndarray] = {}
    for group in identities:
        for w in group:
            others.setdefault(number[w], np.array([number[o] for o in group if o != w], np.int64))
    identity = np.zeros(len(names), bool)
    identity[list(others)] = True
    ends = np.append(starts[1:], len(at))
    of_text = np.searchsorted(owner, np.arange(len(texts) + 1))
    weights, pulled, seen = np.zeros(s.buckets), np.zeros(s.buckets), np.zeros(s.buckets)
    rng = np.random.default_rng(s.seed)
    batches = -(-len(y) // s.batch)
    for _ in range(max(s.epochs, -(-s.updates // batches))):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), s.batch):
            rows = np.sort(order[begin : begin + s.batch])
            rows = rows[of_text[rows + 1] > of_text[rows]]
            if not len(rows):
                continue
            held = np.concatenate([np.arange(of_text[r], of_text[r + 1]) for r in rows])
            words = np.concatenate([at[starts[r0] : ends[r1 - 1]] for r0, r1 in zip(of_text[rows], of_text[rows + 1])])
            sizes = ends[held] - starts[held]
            swapped = np.flatnonzero(identity[words])
            drawn = np.array([rng.choice(others[w]) if len(others[w]) else w for w in words[swapped]], np.int64)
            used, which = np.unique(np.concatenate([words, drawn]), return_inverse=True)
            within = np.repeat(begins[used] - np.cumsum(counts[used]) + counts[used], counts[used]) + np.arange(counts[used].sum())
            place, bounds = places[within], np.cumsum(counts[used]) - counts[used]
            of_word = np.add.reduceat(weights[place], bounds) / root[used]
            per_word, per_drawn = which[: len(words)], which[len(words) :]
            scores = np.add.reduceat(of_word[per_word], np.cumsum(sizes) - sizes)
            first = np.flatnonzero(np.append(True, owner[held][1:] != owner[held][:-1]))
            total, part = pooled(scores, first, s.sharpness)
            error = 1 / (1 + np.exp(-np.clip(bias + total, -500, 500))) - y[rows]
            lengths = np.diff(np.append(first, len(held)))
            back = np.repeat(error, lengths) * part * (1 + s.sharpness * (scores - np.repeat(total, lengths)))
            gradient = np.bincount(per_word, np.repeat(back, sizes), len(used))
            if len(swapped):
                # The swapped sentence differs in the drawn words alone.
                sentence = np.repeat(np.arange(len(held)), sizes)[swapped]
                change = np.bincount(sentence, of_word[per_word[swapped]] - of_word[per_drawn], len(held))
                pull = 2 * s.penalty * change[sentence]
                gradient += np.bincount(per_word[swapped], pull, len(used)) - np.bincount(per_drawn, pull, len(used))
            step = np.bincount(place, np.repeat(gradient / root[used], counts[used]), s.buckets)
            moved = np.flatnonzero(step)
            more = seen[moved] + step[moved] ** 2
            pulled[moved] += step[moved] - (np.sqrt(more) - np.sqrt(seen[moved])) / s.rate * weights[moved]
            seen[moved] = more
            beyond = np.maximum(np.abs(pulled[moved]) - s.sparsity, 0)
            weights[moved] = -np.sign(pulled[moved]) * beyond * s.rate / (1 + np.sqrt(more))
            bias -= 0.05 * float(error.mean())
    return Model(s, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, s: Settings = Settings(), identities=IDENTITIES) -> Model:
    """Train on labelled documents where ``usable`` (on ``doc_id``) holds; labels in ``toxic``."""
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & usable).select("doc_id", "toxic")
    # The sample is chosen from ids alone; only its texts are read. Rows that share an id give their least text.
    chosen = marked.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(s.sample)
    short = F.coalesce(F.length("text"), F.lit(0)) <= s.longest_text
    rows = docs.where(short).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).toPandas()
    rows = rows.sort_values(["doc_id", "toxic"])
    return train(rows["text"].tolist(), rows["toxic"].astype(int).tolist(), s, identities)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the chance of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> pa.Array:
        scores = [np.zeros(0)]
        for at in range(0, len(texts), 1000):
            scores.append(sent.value.score(texts.slice(at, 1000)))
        return pa.array(np.concatenate(scores), pa.float64())

    return with_arrow_column(docs, [text], out, "double", make, pa.float64())
