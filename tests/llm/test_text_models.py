import base64
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from anaquel.llm import byte_bpe, personal, quality, token_files
from tests.llm.conftest import texts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [t or "" for _, t in texts()] + [" " * 300, "ab" * 700, "é" * 90, "!?" * 200, "\n" * 50, "a\u0301" * 40, "0" * 500, "'s" * 80]


def test_bpe_equals_the_library():
    encode = byte_bpe.encoder(RANKS, P.PATTERN)
    assert [x.tolist() for x in encode(ODD)] == [library().encode_ordinary(t) for t in ODD]


def test_bpe_scalar_and_side_by_side_agree():
    ranks = byte_bpe.read_ranks(RANKS)
    pairs = byte_bpe.Pairs(ranks)
    rng = np.random.default_rng(3)
    pieces = [bytes(rng.choice(list(b"abe tn\xc3\xa9"), rng.integers(2, 33)).tolist()) for _ in range(300)]
    pieces = [p for p in pieces if p not in ranks]
    got = [np.frombuffer(x, np.int32).tolist() for x in byte_bpe.merge_many(pieces, pairs, 32)]
    assert got == [byte_bpe.merge(p, ranks) for p in pieces]


def test_bpe_round_trip_with_extra_columns(docs, nothing):
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS)
    assert set(both.columns) == set(docs.columns) | {"decoded"}
    rows = both.collect()
    assert len(rows) == len(texts())
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    assert byte_bpe.encode(nothing, RANKS, P.PATTERN).count() == 0


def test_token_files_round_trip(spark, docs):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    want = {}
    for i, text in texts():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        want.setdefault(i, []).append(zlib.crc32(ids))
    rows = token_files.write_and_read(docs, JSON).select("*", F.crc32("ids").alias("crc")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r["crc"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows][0] is None
    ids = [r["doc_id"] for r in rows][1:]
    assert ids == sorted(ids)
    ends = np.cumsum([r["n_tokens"] for r in rows])
    assert [r["start"] for r in rows] == [0, *ends[:-1].tolist()]


def test_token_files_of_nothing(nothing):
    assert token_files.write_and_read(nothing, JSON).count() == 0


def test_token_files_encoder_equals_the_library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    got = token_files.encoder(JSON)(pa.array(ODD))
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in ODD]


def test_token_files_query_equals_the_unmodified_library(spark, tmp_path):
    from anaquel.llm import queries

    t = Tokenizer.from_file(JSON)
    rows = list(enumerate([*ODD, "<|endoftext|>", "some words <|endoftext|> and more.", "a<|endoftext|>b", "<|endoftext", "|> <|"]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in queries.op6_token_files(spark, f"file://{tmp_path}").collect()}
    for i, text in rows:
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_token_files_hold_one_tokenizer_and_only_while_they_encode():
    token_files.forget()
    special = token_files.encoder(JSON, True)(pa.array([" a<|endoftext|>", "a b"]))
    assert [len(np.frombuffer(x, "<u2")) for x in special] == [len(Tokenizer.from_file(JSON).encode(x).ids) for x in (" a<|endoftext|>", "a b")]
    assert token_files.tokenizer.cache_info().currsize == 1
    token_files.forget()
    assert token_files.tokenizer.cache_info().currsize == token_files.encoder.cache_info().currsize == 0


def test_varying_lengths_unpack():
    numbers = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 7, 300], np.uint32)
    control, data = token_files.pack(numbers)
    size = token_files.LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[: len(numbers)]
    assert token_files.unpack(size, np.frombuffer(data, np.uint8)).tolist() == numbers.tolist()


@pytest.fixture(scope="module")
def sample():
    import pandas as pd

    d = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    return d.merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")


def test_quality_on_held_out_rows(sample):
    held = sample.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    model = quality.train(sample[~held].text.tolist(), sample[~held].quality.tolist())
    predicted = model.score(pa.array(sample[held].text)) >= 0.3
    assert (predicted == sample[held].quality.to_numpy()).mean() >= 0.9


def test_quality_cases(docs, nothing, spark):
    model = quality.train(["good words here", "good text", "bad junk", "bad bad bad", None, ""], [1, 1, 0, 0, 1, 0])
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(texts()) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(nothing, model).count() == 0
    assert quality.train([], []).score(pa.array(["a", None])).tolist() == [0.5, 0.5]
    assert quality.train(["a"], [1]).score(pa.array(["b"]))[0] > 0.99
    one_by_one = [float(model.score(pa.array([t], pa.string()))[0]) for _, t in texts()]
    assert np.allclose(one_by_one, model.score(pa.array([t for _, t in texts()], pa.string())))
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (4, None), (10, 0)], "doc_id long, quality int")
    assert isinstance(quality.fit(docs, labels, F.lit(True)), quality.Model)


def test_quality_features_of_repeats_and_ends():
    names, at, edges = quality.words_of(pa.array([" a a b\n", None, "", "b  b a", "c"]))
    words = [[names[k] for k in at[b:e]] for b, e in zip(edges, edges[1:])]
    assert words == [["a", "a", "b"], [], [], ["b", "b", "a"], ["c"]]
    assert np.allclose(quality.repeats(at, edges), [1 / 3, 0, 0, 1 / 3, 0])
    places, counts = quality.features(["ab", "é", "ab"], quality.Settings())
    assert counts.tolist() == [7, 4, 7] and places[:7].tolist() == places[11:].tolist()


def test_base_spans_by_brute_force():
    import re

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    check = {"email": lambda t: True, "ip": lambda t: all(int(x) <= 255 for x in t.split(".")), "card": personal.sound_card, "phone": personal.sound_phone}
    rng = np.random.default_rng(5)
    alphabet = list("a1234567890.@+- (b") + ["4111 1111 1111 1111", "10.0.0.1", "x@y.z", "\u0661"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        want = sorted(
            ((k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if check[k](m.group())),
            key=lambda s: (s[1], personal.KINDS.index(s[0])),
        )
        assert personal.base_spans(text) == want, text


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a@" * 50_000, "+" * 100_000 + "1", "1." * 60_000):
        personal.base_spans(text)


def numbered(kind, rng):
    if kind == "email":
        return f"{rng.choice(['ann', 'bob.k', 'c_d'])}{rng.integers(99)}@mail{rng.integers(9)}.example.com"
    if kind == "ip":
        return ".".join(str(x) for x in rng.integers(0, 256, 4))
    if kind == "phone":
        return f"+{rng.integers(1, 99)} {rng.integers(100, 999)} {rng.integers(100000, 999999)}"
    body = "4" + "".join(str(x) for x in rng.integers(0, 10, 14))
    return body + next(str(d) for d in range(10) if personal.luhn(body + str(d)))


def test_model_learns_and_adds_other_forms():
    rng = np.random.default_rng(1)
    words = ["the", "house", "of", "river", "in", "12", "and", "2024", "3.5", "at"]
    made = [" ".join([*rng.choice(words, 6), numbered(str(k), rng), *rng.choice(words, 6)]) for k in rng.choice(list(personal.KINDS), 600)]
    model = personal.train(made)
    assert model is not None
    text = "the river of ann7 @ mail3.example.com and house in the 12 at"
    (found,) = personal.all_spans([text], model)
    assert ("email", text.index("ann7"), text.index(" and"), False) in found
    clean = ["the house of 12 and 2024 in 3.5 at river", "no digits at all", ""]
    assert personal.all_spans(clean, model) == [[], [], []]


def test_gradients_match_differences():
    s = personal.Settings(embedding=3, hidden=4)
    tagger = personal.Tagger(s)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    chars, mask = personal.batch([personal.coded("ab 12@x"), personal.coded("9 a")])
    tags = np.zeros(chars.shape, np.int64)
    tags[2:5, 0] = [1, 2, 2]
    _, grads = tagger.gradients(chars, mask, tags)
    for name in ("wf", "ub", "emit", "trans", "embed"):
        place = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        kept, losses = tagger.p[name][place], []
        for step in (1e-2, -1e-2):
            tagger.p[name][place] = kept + step
            losses.append(tagger.gradients(chars, mask, tags)[0])
        tagger.p[name][place] = kept
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][place]) < 0.02 * max(1, abs(grads[name][place]))


def test_personal_data_cases(docs, nothing):
    found = personal.find(docs, None)
    assert set(found.columns) == set(docs.columns)
    rows = found.collect()
    assert len(rows) == len(texts())
    kinds = [[s["kind"] for s in r["spans"]] for r in rows if r["doc_id"] == 12]
    assert kinds == [["email", "phone"]] * 2
    masked = {r["text"] for r in personal.mask(docs, None).where("doc_id = 12").collect()}
    assert masked == {"mail [EMAIL] or [PHONE] now"}
    assert personal.find(nothing, None).count() == 0
    assert personal.fit(nothing) is None
