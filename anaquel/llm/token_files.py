"""Token ids in compact binary files.

Ids are replaced by their frequency rank, so frequent ids are small numbers. A number takes one to four
bytes; the lengths stand apart from the bytes, two bits each, four to a control byte. A reader looks the
lengths of a control byte up in a table and so decodes a whole block by numpy, without a loop over ids.

A file is a Parquet part whose rows are blocks: the documents of a stretch of the order, as
``payload`` = number of documents (uint32), document ids, null flags, ids of each document, control bytes of
each, data bytes of each. Spark's writer commits the parts, so a lost executor leaves no half-written file and any
store that Spark reaches will do. Beside the blocks lies the table of ids by rank.

Documents stand in ascending ``doc_id`` order, nulls first, equal ids by their tokens. Null texts count as
empty and hold the end id only. Repeated rows are all written. An empty table gives no files and no rows.
Columns besides ``doc_id`` and ``text`` are not stored. Names of special tokens in a text are ordinary text, or by
``names`` the tokens, as in the library's plain call.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anaquel.llm.common import lean
from anaquel.session import work_dir

END_ID = 0
#: Distinct pieces whose ids a Python worker remembers, and the ids after which a block is closed.
REMEMBERED = 500_000
BLOCK_IDS = 1 << 18
#: Bytes of text that are encoded at a time.
PART_BYTES = 16 << 20
#: Lengths of the four numbers of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # names of special tokens in a text are ordinary text
    return found


#: Texts are cut into pieces before a single space between two words, and between a letter and a sign, where the
#: tokenizer's own pattern always cuts. Texts with white space beside a space or at an end, or of another kind
#: than the line feed, and those with control characters, one of which marks the cuts, stay whole.
UNCUT = r"^\s|\s$|  | \n|\n |[\x00-\x09\x0b-\x1f\x{85}\p{Zl}\p{Zp}]|[^\P{Zs} ]"
MARK = "\x01"


def id_type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def encoder(path: str, names: bool = False):
    """A function from texts to the bytes of their ids; by ``names``, that of a special token in a text is the token."""
    t = tokenizer(path)
    contents = [re.escape(a.content) for a in t.get_added_tokens_decoder().values()] if names else []
    stays_whole = "|".join([UNCUT, *contents])
    kind = id_type(t.get_vocab_size())
    # A token of the byte-level vocabulary has a character per byte.
    lengths = np.zeros(t.get_vocab_size(), np.int64)
    for token, place in t.get_vocab().items():
        lengths[place] = len(token)
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def ids_of(text: str, whole: bool = False) -> np.ndarray:
        # One tokenizer for both ways, since each takes tens of megabytes.
        t.encode_special_tokens = not (names and whole)
        return np.array(t.encode_batch_fast([text], add_special_tokens=False)[0].ids, kind)

    def learn(pieces: list[str]) -> list[bytes]:
        """The ids of each piece; pieces new to the worker are encoded in a row and told apart by their bytes."""
        nonlocal known, older
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > REMEMBERED:
            # What is still in use moves over; the rest is forgotten with the next change.
            older, known = known, {p: known[p] for p in pieces if p in known}
        fresh: dict[bool, list[str]] = {True: [], False: []}
        for p in new:
            if (found := older.get(p)) is not None:
                known[p] = found
            else:
                fresh[p[0] == " "].append(p)
        for spaced, group in fresh.items():
            # Between pieces without a space stands a line feed, which is a token of its own there.
            between = "" if spaced else "\n"
            for at in range(0, len(group), 20_000):
                part = group[at : at + 20_000]
                ids = ids_of(between + between.join(part))
                sizes = np.fromiter((len(p.encode()) for p in part), np.int64, len(part)) + len(between)
                cuts = (np.searchsorted(np.cumsum(lengths[ids]), np.cumsum(sizes)) + 1) * ids.itemsize
                raw, skip = ids.tobytes(), len(between) * ids.itemsize
                known.update(zip(part, [raw[b + skip : e] for b, e in zip([0, *cuts.tolist()], cuts.tolist())]))
        return [known[p] for p in pieces]

    def encode_texts(texts: pa.Array) -> list[bytes]:
        """The ids of each text as bytes."""
        texts = pc.fill_null(texts, "")
        uncut = pc.or_(pc.match_substring_regex(texts, stays_whole), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for k in np.nonzero(uncut)[0].tolist():
            out[k] = ids_of(texts[k].as_py(), whole=True).tobytes()
        places = np.nonzero(~uncut)[0]
        if not len(places):
            return out
        marked = pc.replace_substring(texts.take(pa.array(places)), " ", MARK + " ")
        cut = pc.split_pattern(pc.replace_substring_regex(marked, r"(\p{L})([.,;:!?%&$*#|]+)", rf"\1{MARK}\2"), MARK)
        offsets = cut.offsets.to_numpy()
        offsets = offsets - offsets[0]
        pieces = cut.flatten().dictionary_encode()
        at = pieces.indices.to_numpy(zero_copy_only=False)
        encoded = learn(pieces.dictionary.to_pylist())
        numbers = np.frombuffer(b"".join(encoded), kind)
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // numbers.itemsize
        starts = np.cumsum(sizes) - sizes
        held = sizes[at]
        ends = np.cumsum(held)
        raw = numbers[np.repeat(starts[at] - ends + held, held) + np.arange(ends[-1])].tobytes()
        stops = (ends[offsets[1:] - 1] * numbers.itemsize).tolist()
        for k, begin, end in zip(places.tolist(), [0, *stops], stops):
            out[k] = raw[begin:end]
        return out

    return encode_texts


def forget() -> None:
    """Drop what the worker remembers for encoding; later steps run in the same workers and do not need it."""
    encoder.cache_clear()
    tokenizer.cache_clear()


def token_ids(docs: DataFrame, path: str, names: bool = False) -> DataFrame:
    """``doc_id`` and the bytes of the ids of each whole text, with the end id."""
    kind = id_type(tokenizer(path).get_vocab_size())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], kind).tobytes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            groups = np.cumsum(sizes, dtype=np.int64) // PART_BYTES
            edges = [0, *(np.nonzero(np.diff(groups))[0] + 1).tolist(), batch.num_rows]
            for begin, stop in zip(edges, edges[1:]):
                part = batch.slice(begin, stop - begin)
                ids = encoder(path, names)(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x + end for x in ids], pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, ids binary")


def id_counts(ids: DataFrame, kind: str) -> DataFrame:
    """How often each id occurs; a row per id and task goes to the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(0, np.int64)
        for batch in batches:
            n = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=len(total))
            if len(n) > len(total):
                total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
            total += n
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return ids.select("ids").mapInArrow(lean(run), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    size = 1 + (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    codes[: len(numbers)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack(size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Numbers of the given lengths in bytes."""
    at = np.cumsum(size, dtype=np.int64) - size
    numbers = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.nonzero(size > k)[0]
        numbers[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return numbers


def block(doc_ids: list[int | None], counts: list[int], controls: list[bytes], data: list[bytes]) -> bytes:
    return b"".join(
        [
            struct.pack("<I", len(doc_ids)),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], np.uint8).tobytes(),
            np.array(counts, "<u4").tobytes(),
            *controls,
            *data,
        ]
    )


def unblock(payload: bytes, id_of: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids of each, and all ids in a row."""
    (docs,) = struct.unpack_from("<I", payload)
    doc_ids = np.frombuffer(payload, "<i8", docs, 4)
    absent = np.frombuffer(payload, np.uint8, docs, 4 + 8 * docs)
    counts = np.frombuffer(payload, "<u4", docs, 4 + 9 * docs).astype(np.int64)
    width = -(-counts // 4)
    at = 4 + 13 * docs
    control = np.frombuffer(payload, np.uint8, int(width.sum()), at)
    data = np.frombuffer(payload, np.uint8, offset=at + len(control))
    # A document's last control byte may have room for more numbers than are there.
    ends = 4 * np.cumsum(width)
    slot = np.arange(4 * len(control)) - np.repeat(ends - 4 * width, 4 * width)
    there = slot < np.repeat(counts, 4 * width)
    return [None if a else int(d) for d, a in zip(doc_ids, absent)], counts, id_of[unpack(LENGTHS[control].reshape(-1)[there], data)]


def write(docs: DataFrame, path: str, folder: str, names: bool = False) -> None:
    """Write the ids of all documents to ``folder``: ``blocks`` in document order, ``ranks``."""
    spark = docs.sparkSession
    vocabulary = tokenizer(path).get_vocab_size()
    kind = id_type(vocabulary)
    encoded = work_dir(spark, "token-ids")
    token_ids(docs, path, names).withColumn("tie", F.xxhash64("ids")).write.option("compression", "zstd").parquet(encoded)
    ids = spark.read.schema("doc_id long, ids binary, tie long").parquet(encoded)
    # At most one row per entry of the vocabulary.
    counted = id_counts(ids, kind).toPandas().sort_values(["n", "id"], ascending=[False, True])
    rows = [(int(i), int(n), k) for k, (i, n) in enumerate(zip(counted["id"], counted["n"]))]
    spark.createDataFrame(rows, "id long, n long, rank int").write.parquet(f"{folder}/ranks")
    rank = np.zeros(vocabulary, np.uint32)
    rank[counted["id"].to_numpy(np.int64)] = np.arange(len(counted))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        shard, number, first, held, rows = TaskContext.get().partitionId(), 0, 0, 0, []

        def close() -> pa.RecordBatch:
            values = [[shard], [number], [first], [held], [block(*map(list, zip(*rows)))]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=columns)

        columns = ["shard", "block", "first", "n_ids", "payload"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers = rank[np.frombuffer(x.as_buffer(), kind)]
                rows.append((doc_id, len(numbers), *pack(numbers)))
                held += len(numbers)
                if held >= BLOCK_IDS:
                    yield close()
                    number, first, held, rows = number + 1, first + held, 0, []
        if rows:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    # Ids are packed behind the sort: what lies before it runs twice, once for the bounds of the ranges.
    in_order = ids.repartitionByRange(*order).sortWithinPartitions(*order, "ids").select("doc_id", "ids")
    written = in_order.mapInArrow(lean(blocks_of), "shard int, block int, first long, n_ids long, payload binary")
    written.write.option("compression", "none").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (bytes of little-endian uint32)."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").select("id").toPandas()
    id_of = ranks["id"].to_numpy(np.uint32)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per part file, that is per shuffle partition of the writing job: small enough to send to all tasks.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("held"))
    offset = F.coalesce(F.sum("held").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = blocks.join(F.broadcast(shards.select("shard", offset.alias("offset"))), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, counts, ids = unblock(payload.as_py(), id_of)
                ends = np.cumsum(counts, dtype=np.int64)
                raw = ids.astype("<u4")
                columns = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(begin + ends - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([raw[e - c : e].tobytes() for e, c in zip(ends, counts)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids"])

    at = (F.col("offset") + F.col("first")).alias("at")
    return placed.select(at, "payload").mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids binary")


def write_and_read(docs: DataFrame, path: str, names: bool = False) -> DataFrame:
    folder = work_dir(docs.sparkSession, "token-files")
    write(docs, path, folder, names)
    return read(docs.sparkSession, folder)


