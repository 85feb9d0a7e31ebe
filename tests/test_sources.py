"""Store, feeds, watermarks, catalog."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge import session
from starforge.session import scratch_path
from starforge.sources.catalog import create_table_sql, register_tables
from starforge.sources.feeds import FeedSpec, batch_cutoff, prepare, read_landing, upsert_feed
from starforge.sources.store import COMMIT_MARK, TableStore, path_exists
from starforge.sources.watermark import MARK_SCHEMA, advance_marks, batch_mark, publish_mark, read_mark
from tests import fixtures as fx
from tests.conftest import rows

SPEC = FeedSpec(
    "raw",
    "Raw",
    T.StructType([T.StructField(c, T.StringType()) for c in ("id", "crash_date", "v", "unit_type")]),
    ("id",),
    exclude=(("unit_type", "PEDESTRIAN"),),
)


def feed(spark, data):
    return spark.createDataFrame(data, SPEC.schema)


def test_store_versions_and_commit_marker(spark):
    store = TableStore(spark, scratch_path(spark, "store"))
    assert not store.exists("t")
    store.create("t", spark.createDataFrame([(1,)], "a int"))
    store.append("t", spark.createDataFrame([(2,)], "a int"))
    assert sorted(r.a for r in store.read("t").collect()) == [1, 2]
    store.replace("t", store.read("t").withColumn("a", F.col("a") * 10))
    assert store.versions("t") == [1, 2]
    assert sorted(r.a for r in store.read("t").collect()) == [10, 20]
    # a snapshot folder without the commit marker (failed write) is never current
    spark.createDataFrame([(99,)], "a int").write.parquet(f"{store.table_dir('t')}/snap-000003")
    assert store.current_version("t") == 2
    assert path_exists(spark, f"{store.location('t')}/{COMMIT_MARK}")


def test_prepare_partitions_fill_exclusion_cutoff(spark):
    df = feed(
        spark,
        [
            ("a", "2024-01-31T10:00:00.000", None, "DRIVER"),
            ("b", "2024-01-02T00:00:00.000", "x", "PEDESTRIAN"),
            ("c", "2024-01-01T00:00:00.000", "y", None),
            ("d", "bad", "z", "DRIVER"),
        ],
    )
    out = prepare(df, SPEC)
    got = {r.id: (r.year, r.month, r.day, r.v, r.unit_type) for r in out.collect()}
    assert got["a"] == (2024, 1, 31, "N/A", "DRIVER")  # day of month, not month
    assert "b" not in got and got["c"][4] == "N/A"
    assert got["d"][:3] == (None, None, None)
    cut = prepare(df, SPEC, cutoff=dt.datetime(2024, 1, 1, 12))
    assert sorted(r.id for r in cut.collect()) == ["a", "d"]  # a row without a date is kept
    assert batch_cutoff(dt.datetime(2024, 1, 10), 2) == dt.datetime(2024, 1, 8)
    assert batch_cutoff(None, 2) is None


def test_upsert_feed_touched_partitions_and_moved_key(spark):
    store = TableStore(spark, scratch_path(spark, "raw"))
    upsert_feed(store, SPEC, prepare(feed(spark, [("a", "2024-01-01T00:00:00", "1", "D"), ("b", "2024-01-02T00:00:00", "1", "D")]), SPEC))
    # 'a' changes value, 'b' moves to another day, 'c' is new
    upsert_feed(
        store,
        SPEC,
        prepare(feed(spark, [("a", "2024-01-01T00:00:00", "2", "D"), ("b", "2024-01-05T00:00:00", "2", "D"), ("c", "2024-01-03T00:00:00", "1", "D")]), SPEC),
    )
    got = rows(store.read("raw"), "id", "v", "day")
    assert got == [("a", "2", 1), ("b", "2", 5), ("c", "1", 3)]


def test_upsert_feed_schema_growth(spark):
    spec = FeedSpec("grow", "Grow", SPEC.schema, ("id",), allow_new_columns=True)
    store = TableStore(spark, scratch_path(spark, "raw"))
    upsert_feed(store, spec, prepare(feed(spark, [("a", "2024-01-01T00:00:00", "1", "D")]), spec))
    wider = feed(spark, [("b", "2024-01-01T00:00:00", "1", "D")]).withColumn("extra", F.lit("e"))
    upsert_feed(store, spec, prepare(wider, spec))
    got = rows(store.read("grow", merge_schema=True), "id", "extra")
    assert got == [("a", None), ("b", "e")]


def test_read_landing_json(spark):
    path = scratch_path(spark, "landing")
    fx.write_json(spark, [{"id": "a", "crash_date": "2024-01-01T00:00:00", "v": "1", "unknown": 5}], path, None)
    df = read_landing(spark, SPEC, path)
    assert df.columns == ["id", "crash_date", "v", "unit_type"]
    assert df.first().id == "a"


def test_watermark_moves_forward_only(spark):
    store = TableStore(spark, scratch_path(spark, "marks"))
    b1 = spark.createDataFrame([("2024-01-05T10:00:00",), ("2024-01-06T08:00:00",), ("N/A",)], "crash_date string")
    publish_mark(store, batch_mark(b1, "crash_date", "Crashes"))
    assert read_mark(spark, store, "Crashes") == dt.datetime(2024, 1, 6, 8)
    older = spark.createDataFrame([("2024-01-01T00:00:00",)], "crash_date string")
    publish_mark(store, batch_mark(older, "crash_date", "Crashes"))
    assert read_mark(spark, store, "Crashes") == dt.datetime(2024, 1, 6, 8)
    empty = spark.createDataFrame([], "crash_date string")
    assert batch_mark(empty, "crash_date", "People").count() == 0
    publish_mark(store, batch_mark(spark.createDataFrame([("2024-02-01T00:00:00",)], "crash_date string"), "crash_date", "People"))
    assert read_mark(spark, store, "People") == dt.datetime(2024, 2, 1)
    cur = spark.createDataFrame([("Crashes", dt.datetime(2024, 1, 1))], MARK_SCHEMA)
    new = spark.createDataFrame([("Crashes", dt.datetime(2024, 1, 2))], MARK_SCHEMA)
    assert advance_marks(cur, new).first().WatermarkValue == dt.datetime(2024, 1, 2)


def test_catalog(spark):
    store = TableStore(spark, scratch_path(spark, "served"))
    store.create("dim_x", spark.createDataFrame([("k", "v")], "x_id string, x string"))
    assert "`x_id` string" in create_table_sql("db", "dim_x", store.read("dim_x").schema, store.location("dim_x"))
    register_tables(spark, store, "cat_test", ["dim_x"])
    store.append("dim_x", spark.createDataFrame([("k2", "w")], "x_id string, x string"))
    store.replace("dim_x", store.read("dim_x"))
    register_tables(spark, store, "cat_test", ["dim_x"])  # re-pointed to the new snapshot
    assert spark.sql("SELECT count(*) FROM cat_test.dim_x").first()[0] == 2


def test_replayed_batch_changes_nothing(spark):
    """foreachBatch may run a batch again after a failure: upsert + mark are idempotent."""
    from starforge.streaming.ingest import process_batch

    store = TableStore(spark, scratch_path(spark, "replay"))
    batch = feed(spark, [("a", "2024-01-01T00:00:00", "1", "D"), ("b", "2024-01-02T00:00:00", "1", "PEDESTRIAN"), (None, "2024-01-03T00:00:00", "n", "D")])
    process_batch(store, SPEC, batch)
    first = rows(store.read("raw"), "id", "v", "day")
    mark = read_mark(spark, store, "Raw")
    process_batch(store, SPEC, batch)
    assert rows(store.read("raw"), "id", "v", "day") == first
    assert read_mark(spark, store, "Raw") == mark == dt.datetime(2024, 1, 3)
    assert first == [("N/A", "n", 3), ("a", "1", 1)]


def test_key_moved_by_months_is_one_row(spark):
    store = TableStore(spark, scratch_path(spark, "raw"))
    upsert_feed(store, SPEC, prepare(feed(spark, [("a", "2024-01-01T00:00:00", "1", "D"), ("b", "2024-03-01T00:00:00", "1", "D")]), SPEC))
    upsert_feed(store, SPEC, prepare(feed(spark, [("a", "2024-05-03T00:00:00", "2", "D")]), SPEC))
    assert rows(store.read("raw"), "id", "v", "day") == [("a", "2", 3), ("b", "1", 1)]


def test_versions_of_a_record_and_rows_without_a_key(spark):
    store = TableStore(spark, scratch_path(spark, "raw"))
    first = [("a", "2024-01-01T00:00:00", "1", "D"), ("a", "2024-01-01T00:00:00", "2", "D"), (None, "2024-01-01T00:00:00", "x", "D"), (None, "2024-01-01T00:00:00", "y", "D")]
    upsert_feed(store, SPEC, prepare(feed(spark, first), SPEC))
    assert rows(store.read("raw"), "id", "v") == [("N/A", "x"), ("N/A", "y"), ("a", "2")]
    later = [("n", "2024-01-01T00:00:00", "1", "D"), ("n", "2024-01-01T00:00:00", "3", "D"), (None, "2024-01-01T00:00:00", "x", "D"), (None, "2024-01-01T00:00:00", "z", "D")]
    upsert_feed(store, SPEC, prepare(feed(spark, later), SPEC))
    assert rows(store.read("raw"), "id", "v") == [("N/A", "x"), ("N/A", "y"), ("N/A", "z"), ("a", "2"), ("n", "3")]


def test_next_application_goes_on_and_takes_the_corrected_record(spark):
    """Two sessions over the same folders: nothing is read twice, the later landing wins."""
    import json
    import os
    import tempfile

    from starforge.streaming.ingest import ingest_stream

    landing, root = tempfile.mkdtemp(), scratch_path(spark, "raw")

    def land(name, *records):
        path = os.path.join(landing, f"{name}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps(dict(zip(("id", "crash_date", "v", "unit_type"), r))) + "\n" for r in records)
        when = 1_700_000_000 + int(name)
        os.utime(path, (when, when))

    for session, landed in ((spark, (("1", "9"), ("2", "1"))), (spark.newSession(), (("3", "0"),))):
        for name, v in landed:
            land(name, ("a", "2024-01-01T00:00:00", v, "D"), (None, "2024-01-01T00:00:00", f"u{v}", "D"), ("f", "2099-01-01T00:00:00", "1", "D"))
        ingest_stream(session, SPEC, landing, TableStore(session, root))
        got = rows(TableStore(spark, root).read("raw"), "id", "v")
        assert ("a", landed[-1][1]) in got and len([r for r in got if r[0] == "a"]) == 1
    # the record of 2099 drops nothing that is landed later
    assert got == [("N/A", "u0"), ("N/A", "u1"), ("N/A", "u9"), ("a", "0"), ("f", "1")]


def test_staged_tables_kept_when_block_fails(spark):
    import pytest

    from starforge.session import stage, staging

    kept = []
    with pytest.raises(RuntimeError):
        with staging(spark) as scope:
            stage(spark.range(3), "keep-me")
            kept = list(scope)
            raise RuntimeError("write failed")
    assert kept and path_exists(spark, kept[0])
    with staging(spark) as scope:
        stage(spark.range(3), "drop-me")
        dropped = list(scope)
    assert not path_exists(spark, dropped[0])


def test_no_landed_row_is_dropped_by_the_mark(spark):
    from starforge.streaming.ingest import process_batch

    store = TableStore(spark, scratch_path(spark, "late"))
    process_batch(store, SPEC, feed(spark, [("a", "2099-01-10T00:00:00", "1", "D"), ("n", "N/A", "1", "D")]))
    process_batch(store, SPEC, feed(spark, [("b", "2024-01-05T00:00:00", "1", "D"), ("m", "N/A", "1", "D")]))
    assert sorted(r.id for r in store.read("raw").collect()) == ["a", "b", "m", "n"]
    # one record of the future does not move the next landing's start beyond the present
    assert batch_cutoff(read_mark(spark, store, "Raw"), 2, as_of=dt.datetime(2024, 1, 10)) == dt.datetime(2024, 1, 8)


def test_new_snapshot_keeps_nothing_of_a_failed_attempt(spark):
    store = TableStore(spark, scratch_path(spark, "left"))
    spark.createDataFrame([(1, "old")], "a int, p string").write.partitionBy("p").parquet(f"{store.table_dir('t')}/snap-000001")
    store.create("t", spark.createDataFrame([(2, "new")], "a int, p string"), ["p"])
    assert rows(store.read("t"), "a", "p") == [(2, "new")]


def test_vacuum_keeps_newest_snapshots(spark):
    store = TableStore(spark, scratch_path(spark, "vac"))
    for i in range(4):
        store.replace("t", spark.createDataFrame([(i,)], "a int"))
    assert store.versions("t") == [1, 2, 3, 4]
    assert store.vacuum("t", keep=2) == [1, 2]
    assert store.versions("t") == [3, 4]
    assert [r.a for r in store.read("t").collect()] == [3]


def test_files_are_sorted_after_the_rebalance(spark):
    store = TableStore(spark, scratch_path(spark, "store"))
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("a"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("p"))
    store.create("t", df.repartition(5), ["p"], sort=("a",))
    store.overwrite_partitions("t", df.withColumn("a", F.col("a") + 1).repartition(5), ["p"], sort=("a",))
    data = store.read("t").select("a", F.input_file_name().alias("f")).withColumn("i", F.monotonically_increasing_id())
    files = {}
    for r in data.orderBy("i").collect():
        files.setdefault(r.f, []).append(r.a)
    assert sum(map(len, files.values())) == 20000
    assert all(v == sorted(v) for v in files.values())


def test_sorted_rows_of_one_folder_are_dealt_to_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 500, raising=False)
    store = TableStore(spark, scratch_path(spark, "store"))
    # most rows in one folder, and most of these equal
    df = spark.range(6000).select(F.when(F.col("id") < 4000, F.lit(7)).otherwise(F.col("id")).alias("a"), F.when(F.col("id") < 10, "x").otherwise("y").alias("p"))
    store.create("t", df, ["p"], sort=("a",))
    store.overwrite_partitions("t", df, ["p"], sort=("a",))
    store.append("t", df, ["p"], sort=("a",))
    got = store.read("t")
    assert rows(got, "a", "p") == sorted(rows(df, "a", "p") * 2, key=repr)
    per_file = got.groupBy("p", F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in per_file) <= 1000
    assert len([r for r in per_file if r.p == "x"]) <= 4  # small folders are few files
