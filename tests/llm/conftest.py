"""Small tables with the cases that every operator must stand: nulls, empty and long texts, repeats, extra columns."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, spans string"
#: Names that operators use inside, or used to.
CLASHING = "_words _size words size mix_row _mix_row row _place one t1 t2 n first digest _score _text _id shard slot next own at stretch node kept".split()

BASE = "the quick brown fox jumps over the lazy dog and runs to the house of a friend by the river with his sister"


def texts():
    near = BASE.replace("lazy", "sleepy")
    return [
        (1, BASE), (2, BASE), (3, near + " today"), (4, "La casa de mi hermano está en la calle.\n\nÜber größe 東京 😀"), (5, ""), (6, None),
        (None, "a row without an id, " + BASE), (8, "x"), (9, "  two  spaces \t and tabs \n"), (10, "word " * 3000), (10, "another text of the same id"),
        (11, "a" * 5000), (12, "mail bob@mail.example.com or +49 30 1234567 now"), (12, "mail bob@mail.example.com or +49 30 1234567 now"),
        (13, "it's we've I'll 123 4567 <|endoftext|> \x1c\x1d \u3000 x"),
    ]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", None if k % 4 == 3 else f"s{k % 3}", len(t or ""), "x", "y", "z") for k, (i, t) in enumerate(texts())]
    return spark.createDataFrame([(*r, *CLASHING) for r in rows], SCHEMA + "".join(f", `{c}` string" for c in CLASHING))


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
