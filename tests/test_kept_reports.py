"""Kept reports: equal to the full report after corrections, at the cost of the rewritten months."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.plans.crash import CRASH_KEPT, build_and_publish, crash_reports, crash_reports_kept, ingest_all
from starforge.plans.kept import KeptReport, count_rows, read_kept, refresh, sum_of
from starforge.plans.published import KEPT_DAYS, kept_orders
from starforge.plans.star import Rule, publish_table
from starforge.session import scratch_path
from starforge.sources.store import TableStore
from tests import fixtures as fx
from tests.conftest import SF001, rows
from tests.test_keyindex import mend, spoil

SCHEMA = "id string, kind string, n int, month_key int"
RULE = Rule("upsert", ("id",), partition_by=("month_key",))
REPORT = KeptReport(
    "kept",
    ("fact",),
    "month_key",
    ("kind",),
    {"n_rows": count_rows(), "total": sum_of("n"), "most": ((lambda: F.max("n")), F.max)},
    lambda t: t["fact"],
)


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "kept"))


def publish(spark, store, data):
    publish_table(store, "fact", spark.createDataFrame(data, SCHEMA), RULE)


def full(store):
    return store.read("fact").groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("total"), F.max("n").alias("most"))


def first_rows(spark, store):
    # the index of ids is published with the first rows, null kinds and months are groups
    publish(spark, store, [("a", "x", 1, 202401), ("b", "y", 2, 202401), ("c", "x", 3, 202402), ("d", None, 4, 202403), ("e", "x", 5, None)])
    return refresh(store, REPORT)


def test_equal_to_the_full_report_after_each_publish(spark, store):
    assert len(first_rows(spark, store)) == 4
    assert rows(read_kept(store, REPORT)) == rows(full(store))
    publish(spark, store, [("c", "z", 30, 202403), ("f", "y", None, 202404)])  # c moves on and leaves its month empty
    assert sorted(refresh(store, REPORT)) == ["202402", "202403", "202404"]
    assert rows(read_kept(store, REPORT)) == rows(full(store))
    assert store.partition_values(REPORT.table, "month_key").count("202402") == 0
    total = read_kept(store, REPORT, by=()).first()
    assert (total.n_rows, total.most) == (6, 30)


def test_nothing_new_computes_nothing(spark, store):
    first_rows(spark, store)
    files = store.files_version(REPORT.table)
    assert refresh(store, REPORT) == []
    publish(spark, store, [("a", "x", 1, 202401)])  # a replay
    refresh(store, REPORT)
    assert rows(read_kept(store, REPORT)) == rows(full(store))
    assert store.partition_versions(REPORT.table, "month_key").keys() == {"202401", "202402", "202403", "__HIVE_DEFAULT_PARTITION__"}
    assert files == store.files_version(REPORT.table)


def test_other_months_are_not_opened(spark, store):
    first_rows(spark, store)
    publish(spark, store, [("b", "x", 20, 202401)])
    want = rows(full(store))
    # the first file stays readable: the schema is read from it
    first = sorted(store.read("fact").inputFiles())[0].rsplit("/", 1)[-1]
    spoiled = spoil(store.read("fact"), "month_key=202401/", first)
    assert refresh(store, REPORT) == ["202401"]
    assert spoiled
    mend(spoiled)
    assert rows(read_kept(store, REPORT)) == want


def test_a_refresh_cut_off_before_its_note_is_made_up(spark, store, monkeypatch):
    first_rows(spark, store)
    publish(spark, store, [("b", "x", 20, 202401)])
    with monkeypatch.context() as m:
        m.setattr(TableStore, "replace", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            refresh(store, REPORT)
    assert refresh(store, REPORT) == ["202401"]
    assert rows(read_kept(store, REPORT)) == rows(full(store))


def test_a_changed_whole_table_makes_every_month_stale(spark, store):
    names = lambda kind: spark.createDataFrame([("x", kind), ("y", "why")], "kind string, name string")
    publish(spark, store, [("a", "x", 1, 202401), ("b", "y", 2, 202402)])
    store.create("dim", names("ex"))
    named = KeptReport("named", ("fact",), "month_key", ("name",), {"n_rows": count_rows()}, lambda t: t["fact"].join(t["dim"], "kind"), whole=("dim",))
    refresh(store, named)
    store.replace("dim", names("EX"))
    assert sorted(refresh(store, named)) == ["202401", "202402"]
    assert rows(read_kept(store, named)) == [("EX", 1), ("why", 1)]


def test_orders_compute_the_corrected_months_only(spark):
    store, computed = kept_orders(spark, SF001, KEPT_DAYS)
    first, second = (set(c["kept_days"]) for c in computed)
    left = store.partition_values("fact_orders", "month_key")
    assert second < set(left) and len(second) < len(first)
    assert read_kept(store, KEPT_DAYS).agg(F.sum("n_orders")).first()[0] == store.read("fact_orders").count()


def test_crash_reports_from_partials(spark):
    root = scratch_path(spark, "kept-crash")
    raw, served = TableStore(spark, f"{root}/raw"), TableStore(spark, f"{root}/served")
    feeds = {"crashes": (fx.CRASHES_1, fx.CRASHES_2), "people": (fx.PEOPLE_1, fx.PEOPLE_2), "vehicles": (fx.VEHICLES_1, fx.VEHICLES_2)}
    for i, day in enumerate((dt.date(2024, 1, 14), dt.date(2024, 1, 16))):
        for name, batches in feeds.items():
            fx.write_json(spark, batches[i], f"{root}/landing/{name}/batch-{i}", None)
        ingest_all(spark, f"{root}/landing", raw, checkpoint_root=f"{root}/streams")
        names = build_and_publish(spark, raw, served, day)
        kept = crash_reports_kept(served)
        want = crash_reports({n: served.read(n) for n in names})
        assert set(want) - set(kept) == {"crashes_by_road_condition"}
        for name, df in kept.items():
            cols = sorted(df.columns)
            assert sorted(want[name].columns) == cols, name
            assert rows(df, *cols) == rows(want[name], *cols), name
    assert all(refresh(served, r) == [] for r in CRASH_KEPT)
