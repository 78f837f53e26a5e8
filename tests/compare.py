"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

``python tests/compare.py [sf] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DATA = "/root/testdata/sf{}"


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA.format(sf)}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def kind(name: str) -> str:
    name = name.lower()
    for prefix, k in (("dec", "decimal"), ("string", "text"), ("varchar", "text"), ("timestamp", "timestamp")):
        if name.startswith(prefix):
            return k
    return {"long": "bigint", "int": "integer", "bool": "boolean"}.get(name, name)


def check(spark, con, name, query, sql, sf):
    start = time.time()
    df = query(spark, DATA.format(sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython") if w in plan]
    if unwanted:
        return False, f"plan holds {unwanted}", 0.0
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, f"{len(got)} rows, no SQL", seconds
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: kind(str(d[1])) for d in result.description}
    want_names, want = rows_of(names, result.fetchall())
    duck_seconds = time.time() - start
    got_names, got = rows_of(df.columns, got)
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}", seconds
    off = {f.name: (kind(f.dataType.typeName()), types[f.name]) for f in df.schema if kind(f.dataType.typeName()) != types[f.name]}
    if off:
        return False, f"types differ: {off}", seconds
    if len(got) != len(want):
        return False, f"{len(got)} rows != {len(want)}", seconds
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ\n  {got_names}\n  spark {bad[0][0]}\n  duck  {bad[0][1]}", seconds
    return True, f"{len(got)} rows (SQL {duck_seconds:.1f}s)", seconds


def main(sf: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from anaquel.session import build_session

    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = duck(sf), entry.queries(), entry.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            ok, note, seconds = check(spark, con, name, query, sql.get(name), sf)
        except Exception as e:
            ok, note, seconds = False, f"{type(e).__name__}: {str(e)[:1500]}", 0.0
        failed += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name} {seconds:.1f}s {note}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:] or ["0.001"]
    raise SystemExit(main(args[0], args[1:]))
