"""Publishing: pruned extract, corrected facts, cut-off runs, catalog entries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.operators import merge
from starforge.plans import star as star_plan
from starforge.plans.crash import PARTITION_COLS
from starforge.plans.star import Rule, publish_star, publish_table, read_history
from starforge.functions.calendar import window_extract
from starforge.session import scratch_path
from starforge.sources.catalog import register_tables
from starforge.sources.feeds import feed_specs, prepare
from starforge.sources.store import TableStore
from tests.conftest import rows


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "publishing"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_prunes_the_partitions_of_every_feed(spark, store):
    days = spark.range(40).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).cast("string").alias("crash_date"))
    for name, spec in feed_specs().items():
        empty = [F.lit("x").alias(f.name) for f in spec.schema if f.name != "crash_date"]
        store.create(name, prepare(days.select("crash_date", *empty), spec), PARTITION_COLS)
        out = window_extract(store.read(name), "crash_date", dt.date(2024, 2, 2), 7, day_parts=PARTITION_COLS)
        part = plan_of(out).split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "make_date(year" in part, name
        assert out.count() == 8


FACT = "id string, weather string, n int, month_key int"
FACT_RULE = Rule("upsert", ("id",), partition_by=("month_key",), else_keys=("id", "weather"))


def publish(spark, store, data):
    publish_table(store, "fact", spark.createDataFrame(data, FACT), FACT_RULE)
    return rows(store.read("fact").select("id", "weather", "n", "month_key"))


def test_a_corrected_record_is_one_fact(spark, store):
    publish(spark, store, [("a", "RAIN", 1, 202401), ("b", "DRY", 1, 202401), ("c", "DRY", 1, 202402)])
    # corrected in place, moved to another month, new; the untouched one stays
    got = publish(spark, store, [("a", "DRY", 1, 202401), ("c", "DRY", 2, 202403), ("d", "DRY", 1, 202403)])
    want = [("a", "DRY", 1, 202401), ("b", "DRY", 1, 202401), ("c", "DRY", 2, 202403), ("d", "DRY", 1, 202403)]
    assert got == want
    assert publish(spark, store, [("a", "DRY", 1, 202401), ("d", "DRY", 1, 202403)]) == want


def test_unchanged_facts_are_found_without_hashing_whole_rows(spark, store, monkeypatch):
    data = [("a", None, 1, 202401), ("b", "DRY", None, 202401), ("c", "DRY", 3, 202402)]
    publish(spark, store, data)
    files = store.read("fact").inputFiles()
    with monkeypatch.context() as m:
        m.setattr(type(store.read("fact")), "exceptAll", lambda *a: pytest.fail("a scan task would hash its whole rows"))
        assert publish(spark, store, data) == sorted(data, key=repr)
        assert sorted(store.read("fact").inputFiles()) == sorted(files)  # nulls compare as equal: nothing is written
        assert publish(spark, store, [("a", "WET", 1, 202401)]) == sorted([("a", "WET", 1, 202401), *data[1:]], key=repr)


def test_facts_without_a_record_id(spark, store):
    batch = [("N/A", "RAIN", 1, 202401), ("N/A", "RAIN", 2, 202401), ("N/A", "DRY", 1, 202401), (None, "DRY", 1, 202401)]
    first = publish(spark, store, batch)
    assert first == sorted(batch, key=repr)
    again = publish(spark, store, batch[:3])
    assert again == first  # a replay adds nothing
    assert ("N/A", "SNOW", 1, 202401) in publish(spark, store, [("N/A", "SNOW", 1, 202401)])


def test_a_record_twice_in_a_batch_fails(spark, store):
    with pytest.raises(Exception, match="several source rows"):
        publish(spark, store, [("a", "RAIN", 1, 202401), ("a", "DRY", 1, 202401)])


HIST = "loc string, cond string, start_date string, end_date string"
HIST_RULE = Rule("history", entity="loc", cond="cond", sort=("loc", "start_date"))


def history_rows(store):
    return rows(read_history(store, "hist").select("loc", "cond", "start_date", "end_date"))


def test_history_merge_cut_off_before_its_commit(spark, store, monkeypatch):
    one = spark.createDataFrame([("x", "DRY", "2024-01-01", ""), ("y", "DRY", "2024-01-02", "")], HIST)
    two = spark.createDataFrame([("x", "WET", "2024-01-05", "2024-01-06"), ("x", "DRY", "2024-01-06", "")], HIST)
    want = [
        ("x", "DRY", "2024-01-01", "2024-01-05"),
        ("x", "DRY", "2024-01-06", ""),
        ("x", "WET", "2024-01-05", "2024-01-06"),
        ("y", "DRY", "2024-01-02", ""),
    ]
    publish_table(store, "hist", one, HIST_RULE)
    before = history_rows(store)
    with monkeypatch.context() as m:
        m.setattr(TableStore, "mark", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            publish_table(store, "hist", two, HIST_RULE)
    assert history_rows(store) == before  # what was written is not seen
    with monkeypatch.context() as m:  # committed, but the old open rows are still there
        calls = []
        clean = star_plan.clean_history
        m.setattr(star_plan, "clean_history", lambda *a: calls.append(a) or (clean(*a) if len(calls) == 1 else None))
        publish_table(store, "hist", two, HIST_RULE)
    assert history_rows(store) == want
    publish_table(store, "hist", two, HIST_RULE)
    assert history_rows(store) == want
    assert rows(store.read("hist").select("loc", "cond", "start_date", "end_date")) != before


def test_history_of_another_layout_is_refused(spark, store):
    df = spark.createDataFrame([("x", "DRY", "2024-01-01", "", "open", 0)], HIST + ", row_state string, segment int")
    store.create("hist", df, ("row_state", "segment"))
    with pytest.raises(ValueError, match="layout"):
        publish_table(store, "hist", spark.createDataFrame([("x", "WET", "2024-01-05", "")], HIST), HIST_RULE)


def test_catalog_follows_each_publish(spark, store):
    rules = {"dim": Rule("upsert", ("k",)), "fact": FACT_RULE}

    def run(v):
        tables = {
            "dim": spark.createDataFrame([("a", v)], "k string, v int"),
            "fact": spark.createDataFrame([("a", "DRY", v, 202400 + v)], FACT),
        }
        publish_star(store, tables, rules, "fact")

    run(1)
    register_tables(spark, store, "pub_db", ["dim", "fact"])
    for v in (2, 3, 4):
        run(v)
        assert spark.sql("SELECT v FROM pub_db.dim").first()[0] == v
        assert [tuple(r) for r in spark.sql("SELECT n, month_key FROM pub_db.fact").collect()] == [(v, 202400 + v)]
    assert len(store.versions("dim")) == 2  # older snapshots are gone
    store.replace("dim", spark.createDataFrame([("a", 5, "new")], "k string, v int, w string"))
    register_tables(spark, store, "pub_db", ["dim"])
    assert spark.table("pub_db.dim").columns == ["k", "v", "w"]


def test_repeated_source_keys_that_match_nothing_are_inserted(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    s = spark.createDataFrame([("b", 1), ("b", 2)], "k string, v int")
    want = [("a", 1), ("b", 1), ("b", 2)]
    assert rows(merge.merge(t, s, ["k"])) == want
    assert rows(merge.upsert_all(t, s, ["k"])) == want


def test_merge_has_no_full_outer_join(spark):
    t = spark.range(10).select("id", F.lit(1).alias("v"))
    s = spark.range(5, 15).select("id", F.lit(2).alias("v"))
    out = merge.merge(t, s, ["id"])
    assert "FullOuter" not in plan_of(out) and out.count() == 15
