"""URL filters: allow and block rules on hosts with their subdomains and path prefixes, DataFrame operations only.

A host's key is its labels reversed, each with a dot behind it: ``www.example.com`` is ``com.example.www.``. A
rule's host and its subdomains are the keys with its key as prefix, an interval that ends where the last dot
becomes the next sign. Such intervals are nested or apart. Both ends of all intervals are events that carry
the stack of rules that hold from there on. The distinct hosts of the pages and the events are sorted over
ranges of the key and swept: a host has the stack of the last event at or before it; a range starts with
the last event of the ranges before it. Pages then get their host's stack by an equi-join, which adaptive
execution splits for a hot host, and the longest rule whose path begins the page's path wins.

The longest rule is the one with the most characters in host and path, then in the host, then the first in
order. A null url or one without ``://`` has an empty host and path. No rule fits an empty host. Rules
with a null host or path fit nothing; a repeated rule counts once, and of contradicting ones the first
verdict in order wins. Without a rule the verdict is the default. Repeated pages are judged each. Without rules
or pages nothing breaks. Other columns of the pages are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit(".")))


def events(rules: DataFrame) -> DataFrame:
    """``key`` and the ``stack`` of rules that hold from there up to the next event."""
    listed = rules.where("host is not null and path is not null").select(
        lower_ascii(F.col("host")).alias("host"), "path", "verdict"
    )
    listed = listed.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    entry = F.struct("host", "path", "verdict")
    keyed = listed.withColumn("key", host_key(F.col("host"))).groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("own"))
    # A key's ancestors are its prefixes by labels.
    depth = F.size(F.split("key", r"\.")) - 1
    prefixes = keyed.select(F.col("key").alias("of"), F.explode(F.sequence(F.lit(1), depth)).alias("labels"))
    prefixes = prefixes.select("of", F.concat(F.expr("substring_index(of, '.', labels)"), F.lit(".")).alias("key"))
    above = prefixes.join(keyed, "key").groupBy("of").agg(
        F.flatten(F.collect_list("own")).alias("at_start"),
        F.flatten(F.collect_list(F.when(F.col("key") != F.col("of"), F.col("own")))).alias("at_end"),
    )
    starts = above.select(F.col("of").alias("key"), F.col("at_start").alias("stack"))
    after = F.concat(F.expr("substring(of, 1, length(of) - 1)"), F.lit("/"))
    return starts.unionByName(above.select(after.alias("key"), F.col("at_end").alias("stack")))


def stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and the ``stack`` of rules whose host it is or lies under; ``hosts`` are distinct."""
    marks = events(rules)
    kind = dict(marks.dtypes)["stack"]
    points = marks.withColumns({"host": F.lit(None).cast("string"), "is_event": F.lit(True)}).unionByName(
        hosts.select(host_key(F.col("host")).alias("key"), F.lit(None).cast(kind).alias("stack"), "host", F.lit(False).alias("is_event"))
    )
    dealt = materialise(points.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "sweep")
    # One row per shuffle partition.
    last = dealt.where("is_event").groupBy("part").agg(F.max_by("stack", "key").alias("last"))
    parts = dealt.select("part").distinct().join(last, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    sweep = Window.partitionBy("part").orderBy("key", F.col("is_event").desc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("swept", F.last("stack", ignorenulls=True).over(sweep)).where("not is_event")
    swept = swept.join(F.broadcast(carried), "part")
    return swept.select("host", F.coalesce("swept", "carried").alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none), ``verdict`` for each page; ``rules`` has
    ``host``, ``path`` and ``verdict``."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url").select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    placed = parsed.join(stacks(parsed.select("host").distinct(), rules), "host", "left")
    fitting = F.filter("stack", lambda r: F.startswith(F.col("path"), r.path))
    length = lambda r: F.length(r.host) + F.length(r.path)
    better = lambda r, best: best.isNull() | (F.struct(length(r), F.length(r.host)) > F.struct(length(best), F.length(best.host)))
    nothing = F.lit(None).cast("struct<host:string,path:string,verdict:string>")
    won = F.aggregate(fitting, nothing, lambda best, r: F.when(better(r, best), r).otherwise(best))
    rows = placed.withColumn("won", won)
    rule = F.when(F.col("won").isNotNull(), F.concat("won.host", "won.path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))
