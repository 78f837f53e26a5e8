"""The brand join against a plain look for whole words."""

import random
import re

from anaquel.operators.brand_index import match_brands

LETTERS = "aB é&.-1_  Ñ"


def stands(brand, text):
    return re.search(rf"(?<!\w){re.escape(brand.lower())}(?!\w)", text.lower()) is not None


def expected(text, brands):
    hits = [(p, b) for b, p in brands if text is not None and b and re.search(r"\w", b) and stands(b, text)]
    return min(hits)[1] if hits else None


def test_random_texts_and_brands(spark):
    draw = random.Random(5)
    word = lambda most: "".join(draw.choice(LETTERS) for _ in range(draw.randint(0, most)))
    brands = [(word(4), draw.randint(0, 9)) for _ in range(150)]
    texts = [word(14) for _ in range(400)] + ["a" * 5000 + " Bé", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, product string")
    got = match_brands(rows, spark.createDataFrame([*brands, (None, 0)], "brand string, priority int"))
    assert {r["id"]: r["inferred"] for r in got.collect()} == {i: expected(t, brands) for i, t in enumerate(texts)}
    assert got.where("inferred is not null").count() > 50


def test_lists_by_retailer_repeats_and_empty_tables(spark):
    rows = spark.createDataFrame(
        [("r", "Pasta COLGATE y Oral-B", "old")] * 2 + [("s", "Pasta COLGATE y Oral-B", "old"), (None, "Colgate", "old"), ("r", "Colgatex", "old")],
        "retailer string, product string, inferred string",
    )
    brands = spark.createDataFrame(
        [("r", "Oral-B", 2), ("r", "Colgate", 3), ("r", "Colgate", 1), ("s", "Oral-B", 1), ("s", "Colgate", 2)], "retailer string, brand string, priority int"
    )
    got = match_brands(rows, brands, by=("retailer",))
    assert got.columns == ["retailer", "product", "inferred"]
    assert sorted(tuple(r) for r in got.collect() if r["retailer"]) == [
        ("r", "Colgatex", None), ("r", "Pasta COLGATE y Oral-B", "Colgate"), ("r", "Pasta COLGATE y Oral-B", "Colgate"),
        ("s", "Pasta COLGATE y Oral-B", "Oral-B"),
    ]
    assert match_brands(rows, brands.limit(0), by=("retailer",)).where("inferred is null").count() == 5
    assert match_brands(rows.limit(0), brands, by=("retailer",)).count() == 0


def test_plan_has_no_nested_loop(spark):
    rows = spark.createDataFrame([("Pasta Colgate",)], "product string")
    plan = match_brands(rows, spark.createDataFrame([("Colgate", 1)], "brand string, priority int"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
