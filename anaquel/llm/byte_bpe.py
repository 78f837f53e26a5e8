"""Byte-level BPE: texts to token ids by a table of ranks, and ids back to bytes.

Each match of the split pattern is encoded on its own. A segment tree over its byte positions holds at each
leaf the rank of the pair that starts there, and at the root the leftmost pair of the lowest rank. A merge
changes two pairs and removes one, so it costs three point updates of logarithmic depth; a match of n bytes
takes O(n log n), however long it is. The short matches of a batch that are new to the worker are merged side
by side in numpy, one tree per row.

Null texts count as empty and give no ids; an empty table gives an empty table; repeated rows are encoded
each; other columns are kept, and a column of the name that is written is replaced. Null ids decode to
empty bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from anaquel.llm.common import with_arrow_column

#: Distinct matches whose ids a Python worker remembers.
REMEMBERED = 150_000
FREE = 1 << 60


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    width = 1 << max(0, (n - 2).bit_length())
    # A key is the pair's rank, then its position: the least key is the leftmost pair of the lowest rank.
    tree = [FREE] * (2 * width)
    for at in range(n - 1):
        rank = ranks.get(piece[at : at + 2])
        if rank is not None:
            tree[width + at] = rank * n + at
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(at: int, key: int) -> None:
        node = width + at
        if tree[node] == key:
            return
        tree[node] = key
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    after = list(range(1, n + 1))  # the live neighbours of each live position
    before = list(range(-1, n - 1))
    while tree[1] != FREE:
        at = tree[1] % n
        gone = after[at]
        end = after[gone]
        after[at] = end
        if gone < n - 1:
            put(gone, FREE)
        if end < n:
            before[end] = at
            rank = ranks.get(piece[at : after[end]])
            put(at, FREE if rank is None else rank * n + at)
        else:
            put(at, FREE)
        if (prior := before[at]) >= 0:
            rank = ranks.get(piece[prior:end])
            put(prior, FREE if rank is None else rank * n + prior)
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Pairs:
    """Ranks of pairs of tokens as sorted numpy keys: every way to cut a token into two."""

    def __init__(self, ranks: dict[bytes, int]):
        cuts = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
        ]
        table = np.array(sorted(cuts) or [(-1, 0)], np.int64)
        self.keys, self.ranks = table[:, 0].copy(), table[:, 1].copy()
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pair's rank, or FREE."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], FREE)


def merge_many(pieces: list[bytes], pairs: Pairs, width: int) -> list[bytes]:
    """``merge`` for many short pieces side by side: a segment tree per row, a merge in each row per step.

    Gives the ids as bytes of int32. ``width`` is a power of two and no piece is longer.
    """
    rows = len(pieces)
    length = np.fromiter(map(len, pieces), np.int64, rows)
    chars = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
    token = pairs.bytes[chars]
    place = np.arange(width)
    live = place < length[:, None]
    tree = np.full((rows, 2 * width), FREE, np.int64)
    first = pairs.rank(token[:, :-1], token[:, 1:])
    first[place[1:] >= length[:, None]] = FREE
    tree[:, width : 2 * width - 1] = np.where(first == FREE, FREE, first * width + place[:-1])
    for level in range(width.bit_length() - 2, -1, -1):
        low = 1 << level
        tree[:, low : 2 * low] = tree[:, 2 * low : 4 * low].reshape(rows, low, 2).min(axis=2)
    after = np.tile(place + 1, (rows, 1))
    before = np.tile(place - 1, (rows, 1))

    def put(row: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
        node = width + at
        tree[row, node] = key
        for _ in range(width.bit_length() - 1):
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.nonzero(tree[:, 1] != FREE)[0]
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = after[row, at]
        end = after[row, gone]
        token[row, at] = rank
        after[row, at] = end
        live[row, gone] = False
        put(row, gone, np.full(len(row), FREE))
        inside = end < length[row]
        r, a, e = row[inside], at[inside], end[inside]
        before[r, e] = a
        key = np.full(len(row), FREE)
        found = pairs.rank(token[r, a], token[r, e])
        key[inside] = np.where(found == FREE, FREE, found * width + a)
        put(row, at, key)
        prior = before[row, at]
        inside = prior >= 0
        r, a, b = row[inside], at[inside], prior[inside]
        found = pairs.rank(token[r, b], token[r, a])
        put(r, b, np.where(found == FREE, FREE, found * width + b))
        row = row[tree[row, 1] != FREE]
    flat, ends = token[live].astype(np.int32).tobytes(), (4 * np.cumsum(live.sum(axis=1))).tolist()
    return [flat[b:e] for b, e in zip([0, *ends], ends)]


#: Matches up to this many bytes are merged side by side and remembered.
SHORT = 64


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    """A function from texts to the lists of their ids."""
    ranks, split = read_ranks(path), regex.compile(pattern)
    pairs, known, older = Pairs(ranks), {}, {}

    def as_bytes(ids: list[int]) -> bytes:
        return np.array(ids, np.int32).tobytes()

    def learn(found: set[str]) -> None:
        nonlocal known, older
        new = [m for m in found if m not in known]
        if len(known) + len(new) > REMEMBERED:
            # What is still in use moves over; the rest is forgotten with the next change.
            older, known = known, {m: known[m] for m in found if m in known}
        by_width: dict[int, list[str]] = {}
        for m in new:
            if (before := older.get(m)) is not None:
                known[m] = before
                continue
            raw = m.encode()
            if (whole := ranks.get(raw)) is not None:
                known[m] = as_bytes([whole])
            elif len(raw) <= SHORT:
                by_width.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append(m)
            else:
                known[m] = as_bytes(merge(raw, ranks))
        for width, group in by_width.items():
            for at in range(0, len(group), 8192):
                part = group[at : at + 8192]
                known.update(zip(part, merge_many([m.encode() for m in part], pairs, width)))

    def encode_texts(texts: list[str]) -> list[np.ndarray]:
        cut = [split.findall(text) for text in texts]
        learn(set().union(*cut))
        return [np.frombuffer(b"".join(map(known.__getitem__, matches)), np.int32) for matches in cut]

    return encode_texts


def in_parts(texts: pa.Array, most: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of about so many bytes, one at a time as Python's strings; null texts are empty."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at, held = 0, 0
    while at < len(texts):
        stop = min(len(texts), int(np.searchsorted(ends, held + most)) + 1)
        yield [t or "" for t in texts.slice(at, stop - at).to_pylist()]
        at, held = stop, int(ends[stop - 1])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus the token ids of each whole text."""

    def make(texts: pa.Array) -> pa.Array:
        encode_texts = encoder(path, pattern)
        sizes, runs = [], [np.zeros(0, np.int32)]
        for part in in_parts(texts):
            ids = encode_texts(part)
            sizes += map(len, ids)
            runs.append(np.concatenate(ids))
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(runs)))

    return with_arrow_column(docs, [text], out, "array<int>", make, pa.list_(pa.int32()))


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` plus the bytes that the ids stand for."""

    def make(lists: pa.Array) -> pa.Array:
        token = vocabulary(path).__getitem__
        return pa.array([b"".join(map(token, x.values.to_numpy(zero_copy_only=False).tolist())) if x.is_valid else b"" for x in lists], pa.binary())

    return with_arrow_column(docs, [ids], out, "binary", make, pa.binary())
