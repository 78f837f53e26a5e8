"""Consolidation, dimensions, deduplication and quality on small literal tables."""

import datetime as dt

import pytest

from anaquel.operators import aggregates as A
from anaquel.operators import dedup as D
from anaquel.operators import slices as J
from anaquel.operators.cases import case_grid
from anaquel.operators.shape import conform_schema, stamp_category, unknown_categories
from anaquel.plans.consolidate import consolidate
from anaquel.plans.quality_report import quality_report
from anaquel.schema import OBSERVATION, OBSERVATION_COLUMNS, TRACKED
from anaquel.sources import consolidated
from anaquel.sources.consolidated import merge_batch, scan_consolidated, write_consolidated
from anaquel.sources import known_keys
from anaquel.sources.dims import dim_category, dim_location


def observation(category_id, sku, product="Producto", price=10.0, **more):
    row = dict.fromkeys(TRACKED.fieldNames())
    row.update(
        scrape_timestamp=dt.datetime(2026, 8, 18, 18), retailer="Soriana", city="Ciudad de México", state="CDMX",
        category_id=category_id, sku=sku, brand="Marca", product=product, price_current=price, price_regular=price,
        url=f"https://example.com/{sku}",
    )
    row.update(more)
    return row


def frame(spark, *rows):
    from decimal import Decimal

    data = [
        tuple(Decimal(str(r[f.name])) if f.name.startswith("price_") and isinstance(r[f.name], float) else r[f.name] for f in TRACKED)
        for r in rows
    ]
    return spark.createDataFrame(data, TRACKED)


def seen(df):
    return {(r["category_id"], r["city"], r["store_id"], r["sku"], r["product"]) for r in df.collect()}


CDMX = "Ciudad de México"


def test_table_accumulates_categories(spark, tmp_path):
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, observation("cuidado-bucal", "100", "Producto 1")))
    merge_batch(spark, path, frame(spark, observation("detergentes", "200", "Producto 2", 20.0)))
    table = scan_consolidated(spark, path)
    assert {r["sku"] for r in table.collect()} == {"100", "200"}
    assert A.slice_summary(table).count() == 2


def test_table_replaces_slice(spark, tmp_path):
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, observation("cuidado-bucal", "100", "Producto viejo")))
    merge_batch(spark, path, frame(spark, observation("cuidado-bucal", "101", "Producto nuevo", 15.0)))
    assert seen(scan_consolidated(spark, path)) == {("cuidado-bucal", CDMX, None, "101", "Producto nuevo")}


def test_other_slices_of_a_touched_partition_stay(spark, tmp_path):
    path = str(tmp_path / "table")
    old = [observation("c", "1", store_id="7"), observation("c", "2", store_id=None), observation("c", "3", city=None)]
    merge_batch(spark, path, frame(spark, *old))
    merge_batch(spark, path, frame(spark, observation("c", "9", store_id="")))
    assert seen(scan_consolidated(spark, path)) == {
        ("c", CDMX, "7", "1", "Producto"), ("c", None, None, "3", "Producto"), ("c", CDMX, "", "9", "Producto"),
    }


def test_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = frame(spark, observation("c", "1"), observation("d", "2"))
    merge_batch(spark, path, rows)
    before = seen(scan_consolidated(spark, path))
    merge_batch(spark, path, rows.where("false"))
    assert seen(scan_consolidated(spark, path)) == before


def test_a_commit_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, observation("c", "1", store_id="7"), observation("d", "2")))
    before, batch = seen(scan_consolidated(spark, path)), frame(spark, observation("c", "3", store_id="7"), observation("e", "4"))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as crash:
        crash.setattr(consolidated, "_commit", dies)
        with pytest.raises(OSError):
            merge_batch(spark, path, batch)
    assert seen(scan_consolidated(spark, path)) == before
    assert len(list((tmp_path / "table" / "data").iterdir())) == 2
    consolidated.vacuum(spark, path)
    assert len(list((tmp_path / "table" / "data").iterdir())) == 1 and seen(scan_consolidated(spark, path)) == before
    for _ in range(2):
        merge_batch(spark, path, batch)
        assert {r[3] for r in seen(scan_consolidated(spark, path))} == {"2", "3", "4"}


def test_readers_see_one_version_whole(spark, tmp_path):
    """A frame made before a merge and read after it holds the old table; a new one the new table."""
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, *[observation(c, c + "1") for c in "abc"]))
    old = scan_consolidated(spark, path)
    merge_batch(spark, path, frame(spark, *[observation(c, c + "2") for c in "ab"]))
    assert {r["sku"] for r in old.collect()} == {"a1", "b1", "c1"}
    assert {r["sku"] for r in scan_consolidated(spark, path).collect()} == {"a2", "b2", "c1"}


def test_the_second_of_two_writers_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, observation("c", "1")))
    write = consolidated._write_version

    def slowly(*args):
        monkeypatch.setattr(consolidated, "_write_version", write)
        merge_batch(spark, path, frame(spark, observation("d", "2")))
        return write(*args)

    monkeypatch.setattr(consolidated, "_write_version", slowly)
    with pytest.raises(consolidated.CommitConflict):
        merge_batch(spark, path, frame(spark, observation("c", "9")))
    assert {r["sku"] for r in scan_consolidated(spark, path).collect()} == {"1", "2"}


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "table")
    for k in range(6):
        merge_batch(spark, path, frame(spark, observation("c", str(k)), *([observation("d", "d")] if k == 0 else [])))
    assert consolidated.commits(spark, path) == [5, 6]
    # The first version still holds category d, the last two category c.
    assert len(list((tmp_path / "table" / "data").iterdir())) == len(list((tmp_path / "table" / "summary").iterdir())) == 3
    assert {r["sku"] for r in scan_consolidated(spark, path).collect()} == {"5", "d"}


def summary_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stored_summary_follows_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert summary_of(consolidated.scan_summary(spark, path)) == []
    batches = [
        [observation("c", str(k), store_id=str(k % 5), store=f"S{k % 2}", url=None if k % 3 else "u") for k in range(20)] + [observation("", "x")],
        [observation("c", None, price=None, store_id="3"), observation("d", "1", city=None)],
        [observation("c", "n", store_id=""), observation("", "y"), observation("c", "m", store_id=None, city="")],
    ]
    for rows in batches:
        merge_batch(spark, path, frame(spark, *rows))
        assert summary_of(consolidated.scan_summary(spark, path)) == summary_of(A.slice_summary(scan_consolidated(spark, path)))
    write_consolidated(frame(spark, observation("z", "1")), path)
    assert summary_of(consolidated.scan_summary(spark, path)) == [("Soriana", "z", CDMX, None, None, 1, 1, 1, 1)]


def test_hot_category_grows_buckets(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    rows = lambda stores, sku: [observation("hot", f"{sku}-{s}", store_id=str(s)) for s in stores] + [observation("cold", sku)]
    merge_batch(spark, path, frame(spark, *rows(range(64), "a")))
    codes = lambda: {b.code for b in consolidated.current(spark, path)[1] if b.category_id == "hot"}
    assert codes() == {"0-0"}
    size = max(b.size for b in consolidated.current(spark, path)[1])
    monkeypatch.setattr(consolidated, "BUCKET_BYTES", size // 5)
    merge_batch(spark, path, frame(spark, *rows([1], "b")))
    assert len(codes()) > 4 and scan_consolidated(spark, path).count() == 65
    files = {b.code: b.version for b in consolidated.current(spark, path)[1] if b.category_id == "hot"}
    monkeypatch.setattr(consolidated, "BUCKET_BYTES", size * 9)
    merge_batch(spark, path, frame(spark, *rows([1], "c"), observation("hot", "new", store_id="999")))
    after = {b.code: b.version for b in consolidated.current(spark, path)[1] if b.category_id == "hot"}
    # At most two buckets were touched; all others keep their files.
    assert 1 <= sum(files[c] != after[c] for c in files) <= 2 and set(files) <= set(after)
    got = {r["sku"] for r in scan_consolidated(spark, path).where("category_id = 'hot'").collect()}
    assert got == {"c-1", "new", *[f"a-{s}" for s in range(64) if s != 1]}


def test_files_of_other_slices_stay(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    monkeypatch.setattr(consolidated, "BUCKET_BYTES", 1)
    slices = [observation("c", str(k), store_id=str(k)) for k in range(12)]
    for _ in range(2):
        merge_batch(spark, path, frame(spark, *slices))
    before = set(scan_consolidated(spark, path).inputFiles())
    monkeypatch.setattr(consolidated, "BUCKET_BYTES", 1 << 30)
    merge_batch(spark, path, frame(spark, observation("c", "99", store_id="3")))
    after = set(scan_consolidated(spark, path).inputFiles())
    assert len({f.rsplit("/", 1)[0] for f in before - after}) == 1 and len(before & after) >= 1
    assert scan_consolidated(spark, path).count() == 12


def test_runs_arrive_in_parts(spark, tmp_path):
    path = str(tmp_path / "table")
    for sku, run in (("a", 2), ("b", 2), ("old", 1), ("a", 2)):
        merge_batch(spark, path, frame(spark, observation("c", sku, run_id=run), observation("d" + sku, sku, run_id=run)), by_run=True)
    assert sorted(r["sku"] for r in scan_consolidated(spark, path).where("category_id = 'c'").collect()) == ["a", "b"]
    merge_batch(spark, path, frame(spark, observation("c", "n", run_id=3), observation("c", "x", run_id=2)), by_run=True)
    assert [r["sku"] for r in scan_consolidated(spark, path).where("category_id = 'c'").collect()] == ["n"]


def test_scan_absent_and_broken_table(spark, tmp_path):
    assert scan_consolidated(spark, str(tmp_path / "none")).count() == 0
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        scan_consolidated(spark, str(broken)).collect()


def test_fresh_start_discards_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_consolidated(frame(spark, observation("c", "1")), path)
    write_consolidated(frame(spark, observation("d", "2")), path)
    assert {r["sku"] for r in scan_consolidated(spark, path).collect()} == {"2"}


def test_table_types_survive(spark, tmp_path):
    path = str(tmp_path / "table")
    merge_batch(spark, path, frame(spark, observation("2024", "007", store_id="0232")))
    row = scan_consolidated(spark, path).first()
    assert (row["category_id"], row["sku"], row["store_id"]) == ("2024", "007", "0232")


def test_consolidate_keeps_last_and_treats_nulls_as_equal(spark):
    empty = frame(spark, observation("c", "1")).where("false")
    rows = [
        observation("c", None, "uno", url=None, page_number=1),
        observation("c", None, "dos", url=None, page_number=2),
        observation("c", "5", "tres", page_number=2, position=1),
        observation("c", "5", "cuatro", page_number=2, position=0),
    ]
    got = {r["product"] for r in consolidate(empty, frame(spark, *rows)).collect()}
    assert got == {"dos", "tres"}


def test_conform_schema_pads_and_drops(spark):
    out = conform_schema(spark.createDataFrame([("1", 2)], "sku string, extra int"), keep_sequence=False)
    assert out.columns == OBSERVATION_COLUMNS
    assert [f.dataType for f in out.schema] == [f.dataType for f in OBSERVATION]


def test_dimensions(spark, tmp_path):
    categories = dim_category(spark)
    by_retailer = {}
    for r in categories.collect():
        by_retailer.setdefault(r["retailer_id"], {})[r["category_id"]] = r
    assert sum(len(v) for v in by_retailer.values()) == 21
    assert set(by_retailer["soriana"]) == {"cuidado-bucal", "limpiadores", "detergentes", "afeitado-depilacion-dama"}
    assert set(by_retailer["walmart"]) == {"cuidado-bucal", "cuidado-de-la-ropa", "depilacion-y-rasurado"}
    d = by_retailer["soriana"]["detergentes"]
    assert (d["name"], d["subcategory"], d["sub_subcategory"]) == ("Cuidado del hogar", "Limpiadores", "Detergentes")
    places = {r["location_id"]: r for r in dim_location(spark).collect()}
    assert (places["sc-toreo"]["store"], places["sc-toreo"]["store_id"], places["sc-toreo"]["postal_code"]) == ("SC Toreo", "2344", "11220")
    assert (places["chedraui-polanco"]["store_id"], places["chedraui-polanco"]["postal_code"]) == ("232", "11500")
    for online in ("fg-online", "fahorro-online", "san-pablo-online"):
        assert (places[online]["postal_code"], places[online]["store"], places[online]["store_id"]) == (None, None, None)

    path = tmp_path / "dims.jsonl"
    path.write_text(
        '{"location_id":"a","city":"x","state":"y"}\n{"location_id":"b","enabled":false}\n'
        '{"location_id":"c","store_id":12,"country":"Chile"}\n'
    )
    rows = {r["location_id"]: r for r in dim_location(spark, str(path)).collect()}
    assert set(rows) == {"a", "c"} and rows["a"]["country"] == "México" and rows["c"]["store_id"] == "12"


def test_unknown_category_is_reported(spark):
    rows = spark.createDataFrame([("soriana", "detergentes"), ("soriana", "nada"), ("walmart", "detergentes")], "retailer_id string, category_id string")
    assert stamp_category(rows, dim_category(spark)).count() == 1
    assert {(r["retailer_id"], r["category_id"]) for r in unknown_categories(rows, dim_category(spark)).collect()} == {("soriana", "nada"), ("walmart", "detergentes")}


def test_quality_report(spark):
    grid = case_grid(dim_category(spark), dim_location(spark))
    log = spark.createDataFrame(
        [("soriana", "detergentes", 0, "x\nProductos únicos: 12"), ("soriana", "limpiadores", 2, "BLOCKED: no")],
        "retailer_id string, category_id string, exit_code int, log_text string",
    )
    rows = frame(
        spark,
        observation("detergentes", "1", retailer="SORIANA", store_context_verified=True),
        observation("detergentes", "1", retailer="Soriana"),
        observation("detergentes", " ", url=None, price_current=None),
        observation("limpiadores", "1", retailer="Otra"),
    )
    report = {r["category_id"]: r for r in quality_report(grid, log, rows).where("retailer_id = 'soriana'").collect()}
    d = report["detergentes"]
    assert (d["status"], d["reported_products"], d["products"], d["sku_complete"], d["price_current_complete"]) == ("SUCCESS", 12, 3, 2, 2)
    assert (d["url_complete"], d["duplicates_sku_url"], d["store_context_verified"], d["location_id"]) == (2, 1, 1, "cdmx")
    assert (report["limpiadores"]["status"], report["limpiadores"]["products"]) == ("BLOCKED", 0)
    assert report["cuidado-bucal"]["status"] == "ERROR"


def test_detail_rows_and_fallback_cards(spark):
    details = spark.createDataFrame([("a", "1")], "s string, sku string")
    cards = spark.createDataFrame([("a", "2"), ("b", "3"), ("c", "4")], "s string, sku string")
    urls = spark.createDataFrame([("a", "u"), ("c", "u")], "s string, url string")
    assert {r["sku"] for r in J.detail_or_card(details, cards, urls, ["s"]).collect()} == {"1", "3"}


def test_recover_gaps_prefers_earlier_sources(spark):
    schema = "s string, page int, sku string"
    first = spark.createDataFrame([("a", 1, "x")], schema)
    second = spark.createDataFrame([("a", 1, "y"), ("a", 2, "y")], schema)
    third = spark.createDataFrame([("a", 2, "z"), ("a", 3, "z")], schema)
    got = J.recover_gaps(first, [("two", second), ("three", third)], ["s", "page"])
    assert {(r["page"], r["sku"], r["source"]) for r in got.collect()} == {(1, "x", "primary"), (2, "y", "two"), (3, "z", "three")}


def test_attempts(spark):
    rows = spark.createDataFrame(
        [("p", 1, 0, "a", 3), ("p", 1, 1, "b", 3), ("p", 2, 0, "a", 3), ("p", 3, 0, "c", 3), ("q", 1, 0, "a", None)],
        "page string, attempt int, position int, sku string, target_rows int",
    )
    need = {r["page"]: (r["attempts_needed"], r["best_rows"]) for r in D.attempts_needed(rows, ["page"]).collect()}
    assert need == {"p": (3, 3), "q": (1, 1)}
    best = {(r["sku"], r["attempt"]) for r in D.best_attempt(rows, ["page"]).where("page = 'p'").collect()}
    assert best == {("a", 2), ("b", 1), ("c", 3)}


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = frame(spark, observation("c", "1"))
    plan = D.dedup_consolidated(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_key_comes_out_whole(spark):
    """A third of all rows share one slice, and one key; results are the same as counted by hand."""
    rows = spark.range(30_000).selectExpr(
        "'R' as retailer",
        "case when id % 3 = 0 then 'hot' else 'c' || id % 50 end as category_id",
        "'x' as city",
        "cast(null as string) as store_id",
        "case when id % 3 = 0 then 'hot' else 's' || id % 700 end as sku",
        "cast(null as string) as url",
        "cast(1 + id % 4 as int) as page_number",
        "id as run_id",
        "id as position",
    )
    first = D.first_page_rows(rows, ["category_id"])
    assert first.where("sku = 'hot'").count() == 2_500
    kept = D.dedup_consolidated(rows)
    assert kept.where("sku = 'hot'").first()["run_id"] == 29_997
    assert kept.count() == rows.select("category_id", "sku").distinct().count()
    counted = {r["category_id"]: r["duplicates_sku_url"] for r in D.count_duplicates(rows, ["category_id"]).collect()}
    assert counted["hot"] == 9_999
    gone = J.replace_slice(rows, rows.where("category_id = 'hot'"))
    assert gone.count() == 20_000
    assert J.known_sku_filter(rows, rows.where("sku = 'hot'"), ["category_id"]).count() == 20_000


def test_unseen_skus_by_filter(spark, tmp_path, monkeypatch):
    """The filters change what is read, never what is found: new, old, unfiltered and split buckets, nulls, repeats."""
    path = str(tmp_path / "table")
    stores = [None, "s1", "s2"]
    hot = [observation("hot", str(k), store_id=stores[k % 3]) for k in range(3000)]
    merge_batch(spark, path, frame(spark, *hot, observation("old", "1"), observation("old", None)))
    assert known_keys.unseen_skus(spark, str(tmp_path / "none"), frame(spark, hot[0])).count() == 1
    batch = frame(
        spark, *[observation("hot", str(k), store_id="s1") for k in range(0, 6000, 3)], observation("hot", "3", store_id=""),
        *[observation("old", sku) for sku in ("1", "2", "2", None, "")], observation("fresh", "1"), observation("none", "1"),
        observation(None, "1"),
    )

    def both():
        want = J.known_sku_filter(batch, scan_consolidated(spark, path))
        got = known_keys.unseen_skus(spark, path, batch)
        assert got.columns == batch.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        buckets = consolidated.current(spark, path)[1]
        return known_keys._marked(spark, path, batch, buckets).where("_maybe").count(), got.count()

    assert both()[0] == batch.count() - 2 - 1  # no filter yet: only categories that are not there are clear
    known_keys.refresh_known_keys(spark, path)
    maybe, new = both()
    assert maybe - (batch.count() - new) < 0.05 * batch.count()
    merge_batch(spark, path, frame(spark, observation("fresh", "1"), observation(None, "1")))
    both()
    monkeypatch.setattr(consolidated, "BUCKET_BYTES", 2000)
    merge_batch(spark, path, frame(spark, *hot[:50]))
    known_keys.refresh_known_keys(spark, path)
    maybe, new = both()
    assert maybe - (batch.count() - new) < 0.05 * batch.count()
    for _ in range(3):
        merge_batch(spark, path, frame(spark, observation("fresh", "1")))
    known_keys.refresh_known_keys(spark, path)
    kept = {b.version for b in consolidated.current(spark, path)[1]}
    assert kept <= {p.name[8:] for p in (tmp_path / "table" / "keys").iterdir()} <= {p.name[8:] for p in (tmp_path / "table" / "data").iterdir()}
    both()


def test_dedup_bounds_scans(spark, tmp_path):
    """A task that scans and sorts rows gets a bounded part of the files; a session's own bound stays."""
    key = "spark.sql.files.maxPartitionBytes"
    rows = spark.range(10).selectExpr("id % 3 as sku", "id as run_id")
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert sorted(r["run_id"] for r in D.keep_last(rows, ["sku"]).collect()) == [7, 8, 9]
        assert spark.conf.get(key) == str(16 << 20)
        spark.conf.set(key, "64m")
        D.keep_last(rows, ["sku"])
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
