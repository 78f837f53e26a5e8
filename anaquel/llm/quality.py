"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors: one for each word (hashed), for its character n-grams (hashed),
and for word pairs in which a word follows itself; those share one vector, as their hashes would tell nothing
of words that training has not seen. A softmax over that mean gives the class. Training is stochastic gradient descent in numpy on the
driver, on a bounded sample of the labelled rows: at most ``Settings.sample`` documents, the first by a hash
of their id, whole texts. Scoring runs on all rows, whole texts, in the tasks; there a word's share of the
score is one number, made once per distinct word of a batch, so a document costs one sum over its words.

Null texts count as empty. A text without words has the mean zero, so its score is the bias alone. Labels
that are null are no labels; a document with contradicting labels trains by each of them; null ids match no
labels. Without labels of both classes the score is the share of label 1 (0.5 if there are none). Other
columns are kept; a column of the written name is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.llm.common import with_arrow_column


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the training documents; the rest shapes the model. Few documents are passed over more
    often than ``epochs``, until there were ``updates`` steps."""

    sample: int = 3_000
    buckets: int = 1 << 17
    size: int = 8
    shortest: int = 2
    longest: int = 4
    epochs: int = 6
    updates: int = 600
    batch: int = 32
    rate: float = 0.5
    seed: int = 7


WORDS = 20_000
PRIME = np.uint64(0x9E3779B97F4A7C15)


def placed(hashes: np.ndarray, kind: int, s: Settings) -> np.ndarray:
    """Hashes of a kind of feature to places in the table."""
    mixed = (hashes + np.uint64(kind)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(20)).astype(np.int64) % s.buckets


def features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words' features, word by word, and how many each word has: the word itself and its character
    n-grams, edges marked. Words are hashed side by side, so many at a time."""
    parts = [_features(words[at : at + WORDS], s) for at in range(0, len(words), WORDS)]
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


def _features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(sizes) - sizes
    within = np.arange(len(chars)) - np.repeat(starts, sizes)
    room = np.repeat(sizes, sizes) - within
    power = np.cumprod(np.full(int(sizes.max(initial=1)), PRIME, np.uint64))
    owner = np.repeat(np.arange(len(words)), sizes)
    places = [placed(np.add.reduceat(chars * power[within], starts), 1, s)]
    owners = [np.arange(len(words))]
    rolling = np.zeros(len(chars), np.uint64)
    for n in range(1, s.longest + 1):
        kept = len(chars) - n + 1
        rolling = rolling[:kept] * PRIME + chars[n - 1 :]
        if n >= s.shortest:
            whole = room[:kept] >= n
            places.append(placed(rolling[whole], 1 + n, s))
            owners.append(owner[:kept][whole])
    owners_flat = np.concatenate(owners)
    order = np.argsort(owners_flat, kind="stable")
    return np.concatenate(places)[order].astype(np.int32), np.bincount(owners_flat, minlength=len(words)).astype(np.int32)


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the place of each word of all texts among them, and where the texts begin and end."""
    cut = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    coded = pc.dictionary_encode(cut.flatten())
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    edges = cut.offsets.to_numpy().astype(np.int64)
    edges -= edges[0]
    names = coded.dictionary.to_pylist()
    if "" in names:  # white space at the ends of a text
        real = at != names.index("")
        at, edges = at[real], np.concatenate([[0], np.cumsum(real)])[edges]
    return names, at, edges


def repeats(at: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The share of each text's words that repeat the word before."""
    same = np.concatenate([[0], np.cumsum(at[1:] == at[:-1])]) if len(at) else np.zeros(1)
    first, last = edges[:-1], np.maximum(edges[1:] - 1, edges[:-1])
    inside = np.where(edges[1:] > first, same[np.minimum(last, len(same) - 1)] - same[np.minimum(first, len(same) - 1)], 0)
    return inside / np.maximum(edges[1:] - first, 1)


def repeat_place(s: Settings) -> int:
    return int(placed(np.zeros(1, np.uint64), 0, s)[0])


@dataclass(frozen=True)
class Model:
    settings: Settings
    of_feature: np.ndarray | None  # each feature's share of the log odds of label 1
    bias: float

    def of_words(self, words: list[str]) -> np.ndarray:
        places, counts = features(words, self.settings)
        return np.add.reduceat(self.of_feature[places], np.cumsum(counts) - counts) / counts

    def score(self, texts: pa.Array) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        if self.of_feature is not None and len(texts):
            names, at, edges = words_of(texts)
            if len(at):
                of_word = np.concatenate([self.of_words(names[k : k + WORDS]) for k in range(0, len(names), WORDS)])
                sums = np.concatenate([[0.0], np.cumsum(of_word[at])])
                odds += (sums[edges[1:]] - sums[edges[:-1]]) / np.maximum(edges[1:] - edges[:-1], 1)
                odds += self.of_feature[repeat_place(self.settings)] * repeats(at, edges)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def train(texts: list[str | None], labels: list[int], s: Settings = Settings()) -> Model:
    """Fit word and n-gram vectors and a two-class softmax by stochastic gradient descent."""
    y = np.array(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(s, None, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(s.seed)
    names, at, edges = words_of(pa.array(texts, pa.string()))
    flat, counts = features(names, s) if names else (np.zeros(0, np.int32), np.zeros(0, np.int32))
    begins, repeated = np.cumsum(counts, dtype=np.int64) - counts, repeats(at, edges)
    places, weights = [], []
    for r in range(len(texts)):
        found, times = np.unique(at[edges[r] : edges[r + 1]], return_counts=True)
        held = counts[found].astype(np.int64)
        ends = np.cumsum(held)
        place = flat[np.repeat(begins[found] - ends + held, held) + np.arange(ends[-1] if len(ends) else 0)]
        weight = np.repeat(times / np.maximum(held, 1) / max(1, edges[r + 1] - edges[r]), held)
        kept, which = np.unique(np.append(place, repeat_place(s)), return_inverse=True)
        places.append(kept.astype(np.int32))
        weights.append(np.bincount(which, np.append(weight, repeated[r]), len(kept)).astype(np.float32))
    vectors = rng.uniform(-1 / s.size, 1 / s.size, (s.buckets, s.size)).astype(np.float32)
    outward = rng.uniform(-1, 1, (s.size, 2)).astype(np.float32)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    target = np.stack([1 - y, y], axis=1)
    batches, step = -(-len(y) // s.batch), 0
    epochs = max(s.epochs, -(-s.updates // batches))
    steps = epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), s.batch):
            rows = order[begin : begin + s.batch]
            place = np.concatenate([places[r] for r in rows])
            weight = np.concatenate([weights[r] for r in rows])[:, None]
            sizes = np.array([len(places[r]) for r in rows])
            mean = np.add.reduceat(vectors[place] * weight, np.cumsum(sizes) - sizes, axis=0)
            logits = mean @ outward + bias
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            error = chance - target[rows]
            rate = s.rate * (1 - step / steps)
            back = error @ outward.T
            outward -= rate * mean.T @ error
            bias -= 0.1 * rate * error.mean(axis=0)
            # A mean spreads its error thinly over many features, so their rate is larger.
            np.add.at(vectors, place, -20 * rate * weight * np.repeat(back, sizes, axis=0))
            step += 1
    return Model(s, (vectors @ (outward[:, 1] - outward[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, s: Settings = Settings()) -> Model:
    """Train on labelled documents where ``usable`` (on ``doc_id``) holds; labels in ``quality``."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & usable).select("doc_id", "quality")
    # The sample is chosen from ids alone; only its texts are read. Rows that share an id give their least text,
    # so the bound holds for the driver too.
    chosen = marked.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(s.sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).toPandas()
    rows = rows.sort_values(["doc_id", "quality", "text"], na_position="first")
    return train(rows["text"].tolist(), rows["quality"].astype(int).tolist(), s)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus the chance of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> pa.Array:
        scores = [np.zeros(0)]
        for at in range(0, len(texts), 2000):
            scores.append(sent.value.score(texts.slice(at, 2000)))
        return pa.array(np.concatenate(scores), pa.float64())

    return with_arrow_column(docs, [text], out, "double", make, pa.float64())
