"""Streams over several batches end where the batch jobs end."""

import datetime as dt


from anaquel.schema import TRACKED
from anaquel.sources.changes import add_changes, scan_changes, stretches
from anaquel.sources.consolidated import merge_batch, scan_consolidated
from anaquel.streaming import jobs as T
from tests.test_tables import frame, observation, seen
from workload import q_stream, views
from workload.q_stream import arriving


def arrive(spark, folder, *batches):
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(TRACKED).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_stream_consolidate_equals_batches(spark, tmp_path):
    batches = [
        frame(spark, observation("c", "1", "viejo", run_id=1), observation("d", "2", run_id=1)),
        frame(spark, observation("c", "3", "nuevo", run_id=2)),
        frame(spark, observation("c", "4", store_id="9", run_id=2)),
    ]
    expected, table = str(tmp_path / "expected"), str(tmp_path / "table")
    for b in batches:
        merge_batch(spark, expected, b)
        arrive(spark, tmp_path / "in", b)
        writer = T.stream_consolidate(stream(spark, tmp_path / "in"), table)
        T.run_to_end(writer, str(tmp_path / "state"))
    assert seen(scan_consolidated(spark, table)) == seen(scan_consolidated(spark, expected))
    assert len(seen(scan_consolidated(spark, table))) == 3


def test_seen_skus_come_once(spark, tmp_path):
    for b in (["1", "2", "1"], ["2", "3"]):
        arrive(spark, tmp_path / "in", frame(spark, *[observation("c", s) for s in b]))
        out = T.stream_seen_skus(stream(spark, tmp_path / "in"), "1 day")
        T.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    got = [r["sku"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == ["1", "2", "3"]


def test_latest_price_over_batches(spark, tmp_path):
    day = dt.datetime(2026, 8, 18)
    first = frame(spark, observation("c", "1", price=10.0, scrape_timestamp=day), observation("c", "2", price=5.0, scrape_timestamp=day))
    later = frame(spark, observation("c", "1", price=8.0, scrape_timestamp=day + dt.timedelta(days=1)), observation("c", "1", price=99.0, scrape_timestamp=day - dt.timedelta(days=1)))
    for b in (first, later):
        arrive(spark, tmp_path / "in", b)
        out = T.stream_latest_price(stream(spark, tmp_path / "in"))
        T.run_to_end(T.upsert_batches(out, str(tmp_path / "out")), str(tmp_path / "state"))
    rows = spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out" / "batch=*"))
    got = {(r["sku"], float(r["price_current"]), r["sightings"]) for r in rows.collect()}
    assert got == {("1", 10.0, 1), ("2", 5.0, 1), ("1", 8.0, 3)}


def test_changes_by_time_whatever_the_order_of_arrival(spark, tmp_path):
    def sighting(sku, day, price):
        return observation("c", sku, price=price, scrape_timestamp=dt.datetime(2026, 1, 1) + dt.timedelta(days=day))

    batches = [
        [sighting("1", 1, 10.0), sighting("1", 4, 12.0), sighting("1", 4, 11.0), sighting("2", 2, 5.0), sighting(None, 1, 3.0)],
        [sighting("1", 3, 9.0), sighting("1", 4, 12.0), sighting("2", 9, 5.0), sighting("3", 1, None)],
        [sighting("1", 1, 99.0), sighting("2", 30, 6.0), sighting("1", 30, 12.0), sighting(None, 28, 3.0)],
        [sighting("1", 30, 12.0), sighting("2", 90, 7.0)],
    ]
    for b in batches:
        arrive(spark, tmp_path / "in", frame(spark, *b))
        out = T.stream_price_changes(stream(spark, tmp_path / "in"), "5 days", groups=3, forget_days=20)
        T.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    price = lambda p: None if p is None else float(p)
    got = [
        (r["sku"], (r["scrape_timestamp"] - dt.datetime(2026, 1, 1)).days, price(r["previous_price"]), price(r["price_current"]))
        for r in spark.read.parquet(str(tmp_path / "out")).collect()
    ]
    # Day 1 at 99.00 is too late; after 26 and 21 days products count as new; day 90 is still open.
    assert sorted(got, key=repr) == sorted(
        [
            ("1", 1, None, 10.0), ("1", 3, 10.0, 9.0), ("1", 4, 9.0, 12.0), ("1", 30, None, 12.0),
            ("2", 2, None, 5.0), ("2", 30, None, 6.0), (None, 1, None, 3.0), (None, 28, None, 3.0),
        ],
        key=repr,
    )


def test_change_folders_stay_few(spark, tmp_path):
    path, newest = str(tmp_path / "changes"), {}
    for n in [*range(18), 15, 17]:  # two batches are repeated
        rows = [(k, f"{k}-{n}") for k in {n % 5, n % 7, None}]
        newest.update({k: v for k, v in rows if n > 15 or k not in newest or int(newest[k].partition("-")[2]) < n})
        add_changes(spark.createDataFrame(rows, "k int, v string").coalesce(1), path, n, ["k"])
        assert len(stretches(spark, path)) <= 3 * 3
    assert stretches(spark, path) == [(0, 15), (16, 16), (17, 17)]
    assert {r["k"]: r["v"] for r in scan_changes(spark, path, ["k"]).collect()} == newest


def test_unfinished_merge_is_not_read(spark, tmp_path):
    path = str(tmp_path / "changes")
    for n in range(2):
        add_changes(spark.createDataFrame([(n, "v")], "k int, v string"), path, n, ["k"])
    spark.createDataFrame([(9, "half", 1)], "k int, v string, batch long").write.parquet(f"{path}/0-1")
    (tmp_path / "changes" / "0-1" / "_SUCCESS").unlink()
    assert {r["k"] for r in scan_changes(spark, path, ["k"]).collect()} == {0, 1}


def test_response_windows_drop_late_rows(spark, tmp_path):
    def responses(*hours):
        rows = [(dt.datetime(2026, 8, 18, h), 200, "https://x/Search-UpdateGrid", "abc", None) for h in hours]
        return spark.createDataFrame(rows, "ts timestamp, status int, url string, body string, read_error string")

    for hours in ((1, 1, 2), (8,), (1, 12)):
        responses(*hours).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(responses(1).schema).parquet(str(tmp_path / "in"))
        out = T.stream_response_log(arriving)
        T.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    got = {(r["window_start"].hour, r["responses"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 2), (2, 1), (8, 1)}


def test_table_of_one_file_or_a_folder_arrives_whole(spark, tmp_path):
    spark.range(50).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(20).coalesce(1).write.parquet(str(tmp_path / "written"))
    next((tmp_path / "written").glob("part-*")).rename(tmp_path / "single.parquet")
    for name, rows in (("many", 50), ("single", 20)):
        folder = str(tmp_path / f"out-{name}")
        T.run_to_end(arriving(spark, str(tmp_path), name).writeStream.format("parquet").option("path", folder), f"{folder}-state")
        assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == list(range(rows))


def test_strewn_rows_come_in_more_files_not_in_larger_ones(spark, tmp_path, monkeypatch):
    sf = "/root/testdata/sf0.001"
    rows = views.listing(spark, sf)
    monkeypatch.setattr(q_stream, "FILE_ROWS", 500)
    stream = q_stream.strewn(spark, sf, rows, str(tmp_path), 4)
    T.run_to_end(T.upsert_batches(T.stream_latest_price(stream), str(tmp_path / "out")), str(tmp_path / "state"))
    assert len(list((tmp_path / "out").glob("batch=*"))) == 4
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "in").glob("part-*")]
    assert sum(sizes) == rows.count() and max(sizes) < 2 * 500


def test_state_is_kept_in_rocksdb(spark, tmp_path):
    arrive(spark, tmp_path / "in", frame(spark, observation("c", "1")))
    out = T.stream_seen_skus(stream(spark, tmp_path / "in"), "1 day")
    T.run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "state"))
    kinds = {f.suffix for f in (tmp_path / "state" / "state").rglob("*") if f.is_file() and f.suffix != ".crc"}
    assert kinds & {".changelog", ".zip"} and ".delta" not in kinds
