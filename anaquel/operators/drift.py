"""Payloads whose shape changes between runs: what changed, and reading them without losing a row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.text import bound, once
from anaquel.functions.variants import listed, named, occurrences, repeated_keys, unrolled
from anaquel.session import materialise

# Whole JSON strings and numbers of ordinary length. What a JSON reader might refuse does not match.
_STRING = r'"[^"\\\x00-\x1f]*+(?:(?:\\["\\/bfnrt]|\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]{0,17})(?:\.[0-9]{1,17})?(?:[eE][+-]?[0-9]{1,2})?(?![0-9A-Za-z.+_-])"
# A value with all that stands between it and the value before; names of fields are followed by a colon.
_TO_STRING = rf'\G((?:[^"]++|{_STRING}\s*+:)*+){_STRING}'
_TO_NUMBER = rf'\G((?:[^"0-9-]++|{_STRING})*+){_NUMBER}'
#: Longer payloads are their own shape: readers have limits of length.
_SHAPED = 1_000_000

BROKEN, NO_ITEMS = "broken payload", "no items"


@dataclass(frozen=True)
class PayloadRule:
    """Where a payload holds its items, and an item its fields.

    ``items`` are paths of the item list; the first that leads to a list counts. ``fields`` maps a column to the paths of
    its value in an item, older and newer names alike, the first with a value counting; ``kinds`` to its type (text if
    unnamed). An item without a value for one of ``required`` is rejected.
    """

    items: tuple[str, ...]
    fields: dict[str, tuple[str, ...]]
    kinds: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()


def _kind(v: Column) -> Column:
    """text, number, boolean, or nothing for null and for empty lists and objects."""
    schema = F.schema_of_variant(v)
    return (
        F.when(schema == "STRING", "text")
        .when(schema == "BOOLEAN", "boolean")
        .when((schema == "VOID") | F.startswith(schema, F.lit("ARRAY")) | F.startswith(schema, F.lit("OBJECT")), "nothing")
        .otherwise("number")
    )


def payload_shape(payload: Column) -> Column:
    """The payload with every text empty and every number 0: payloads of one shape hold the same paths and kinds.

    A value that is not plainly a JSON text or number stays, with all behind it, so what is no JSON stays none.
    """
    texts = F.regexp_replace(payload, _TO_STRING, '$1""')
    return F.when(F.length(payload) > _SHAPED, payload).otherwise(F.regexp_replace(texts, _TO_NUMBER, "$10"))


def _held(payload: str) -> Column:
    """Paths and kinds of a payload, each pair once; null where it is no JSON."""

    def entry(path: Column, v: Column, kind: Column | None = None) -> Column:
        found = F.lit(None).cast("string") if kind is None else kind
        return F.struct(path.alias("path"), v.alias("v"), found.alias("kind"), F.lit(kind is not None).alias("read"))

    def below(e: Column) -> Column:
        name = lambda kv: F.concat_ws(".", F.nullif(e["path"], F.lit("")), kv["key"])
        inside = F.transform(F.map_entries(named(e["v"])), lambda kv: entry(name(kv), kv["value"]))
        elements = F.transform(listed(e["v"]), lambda v: entry(F.concat(e["path"], F.lit("[]")), v))
        filled = lambda es: F.when(F.size(es) > 0, es)
        leaf = F.array(entry(e["path"], e["v"], _kind(e["v"])))
        return F.coalesce(bound(inside, filled), bound(elements, filled), leaf)

    # One more layer than brackets: the last one reads the leaves.
    layers = occurrences(F.col(payload), "[") + occurrences(F.col(payload), "{") + 1
    entries = unrolled(entry(F.lit(""), F.try_parse_json(payload)), layers, below)
    held = F.array_distinct(F.transform(entries, lambda e: F.struct(e["path"], e["kind"])))
    return F.when(F.try_parse_json(payload).isNotNull(), held)


def payload_fields(pages: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """Each path that a page's payload holds a value at, with the value's kind; once per page, path and kind.

    ``[]`` stands for the elements of a list. A payload that is no JSON has one row with null path and kind.
    """
    repeated_keys(pages.sparkSession)
    none = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("kind")))
    return pages.select(*keys, F.explode(F.coalesce(_held(payload), none)).alias("_f")).select(*keys, "_f.path", "_f.kind")


def payload_drift(pages: DataFrame, run: list[str], expected: dict[str, str], payload: str = "payload") -> DataFrame:
    """How each run's payloads differ from ``expected``, a kind for each path: path, kind, problem and number of pages.

    ``unknown`` paths are not expected at all, ``kind`` ones hold another kind (no value is no other kind), ``missing``
    ones stand in no readable page of the run, and ``broken`` pages are no JSON. Pages are counted per run and shape, and
    only shapes are parsed and judged, each once; the expected paths are a list in the plan.
    """
    repeated_keys(pages.sparkSession)
    shaped = pages.select(*run, payload_shape(F.col(payload)).alias("_shape"))
    counted = materialise(shaped.groupBy(*run, "_shape").agg(F.count(F.lit(1)).alias("_n")), "shapes-of-runs")
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])

    def judge(f: Column) -> Column:
        known = F.try_element_at(wanted, f["path"])
        other = (f["kind"] != known) & (f["kind"] != "nothing")
        return F.struct(f["path"].alias("path"), f["kind"].alias("kind"), F.when(known.isNull(), "unknown").when(other, "kind").alias("problem"))

    shapes = counted.select("_shape").distinct().select("_shape", once(_held("_shape")).alias("_held"))
    nothing = F.lit(None).cast("string")
    broken = F.array(F.struct(nothing.alias("path"), nothing.alias("kind"), F.lit("broken").alias("problem")))
    problems = F.filter(F.transform("_held", judge), lambda p: p["problem"].isNotNull())
    judged = shapes.select(
        F.col("_shape").alias("_of"), F.col("_held").isNotNull().alias("_readable"), F.coalesce(problems, broken).alias("_problems"),
        *[F.array_contains(F.transform("_held", lambda f: f["path"]), p).alias(f"_has{i}") for i, p in enumerate(expected)],
    )
    known = counted.join(materialise(judged, "shapes"), F.col("_shape").eqNullSafe(F.col("_of")))
    found = known.select(*run, "_n", F.explode("_problems").alias("_p"))
    faults = found.groupBy(*run, "_p.path", "_p.kind", "_p.problem").agg(F.sum("_n").alias("pages"))
    has = [F.bool_or(f"_has{i}").alias(f"_has{i}") for i in range(len(expected))]
    totals = known.where("_readable").groupBy(*run).agg(F.sum("_n").alias("pages"), *has)
    absent = F.filter(F.array(*[F.when(~F.col(f"_has{i}"), p) for i, p in enumerate(expected)]), lambda p: p.isNotNull())
    missing = totals.select(*run, F.explode(absent).alias("path"), nothing.alias("kind"), F.lit("missing").alias("problem"), "pages")
    return faults.select(*run, "path", "kind", "problem", "pages").unionByName(missing)


def read_payloads(pages: DataFrame, keys: list[str], rule: PayloadRule, payload: str = "payload") -> DataFrame:
    """One row per item with the rule's columns, and one per page without items; ``reject_reason`` is null where all is well.

    A value that does not fit its type, a missing one that is required, a payload that is broken or has no item list: each
    leaves its row, with the reason and the JSON text (``raw``), so that no page or item vanishes.
    """
    repeated_keys(pages.sparkSession)
    parsed = pages.select(*keys, F.col(payload).alias("_text"), once(F.try_parse_json(payload)).alias("_p"))
    lists = F.coalesce(*[listed(F.col("_p"), p) for p in rule.items])
    items = parsed.select(*keys, "_text", F.col("_p").isNull().alias("_broken"), F.posexplode_outer(lists).alias("position", "_item"))
    item, values, reasons = F.col("_item"), [], []
    for name, paths in rule.fields.items():
        kind = rule.kinds.get(name, "string")
        # A null inside JSON is no value.
        shown = [F.nullif(F.try_variant_get(item, p, "string"), F.lit("")) for p in paths]
        text = F.coalesce(*shown)
        value = text if kind == "string" else text.try_cast(kind)
        nested = F.coalesce(*[F.when(s.isNotNull(), named(item, p).isNotNull() | listed(item, p).isNotNull()) for s, p in zip(shown, paths)])
        values.append(F.when(~nested, value).alias(name))
        reasons.append(F.when(nested | (text.isNotNull() & value.isNull()), f"unfit {name}"))
        if name in rule.required:
            reasons.append(F.when(text.isNull(), f"missing {name}"))
    page = F.when(F.col("_broken"), BROKEN).when(F.col("position").isNull(), NO_ITEMS)
    raw = F.when(F.col("position").isNull(), F.col("_text")).otherwise(F.to_json(item))
    return items.select(*keys, "position", *values, F.coalesce(page, *reasons).alias("reject_reason"), raw.alias("raw"))
