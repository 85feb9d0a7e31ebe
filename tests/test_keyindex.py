"""Batches open the partitions of their own days and keys only."""

import os
from urllib.parse import urlsplit

import pytest
from pyspark.sql import types as T

from starforge.plans.star import Rule, publish_table
from starforge.session import scratch_path
from starforge.sources import keyindex
from starforge.sources.feeds import FeedSpec, prepare, upsert_feed
from starforge.sources.store import TableStore
from tests.conftest import rows

SPEC = FeedSpec("raw", "Raw", T.StructType([T.StructField(c, T.StringType()) for c in ("id", "crash_date", "v")]), ("id",))


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "keyindex"))


def land(spark, store, data):
    upsert_feed(store, SPEC, prepare(spark.createDataFrame(data, SPEC.schema), SPEC))


def spoil(df, *but):
    """Make the files of all partitions unreadable but those named."""
    spoiled = []
    for f in df.inputFiles():
        path = urlsplit(f).path
        if not any(b in path for b in but):
            spoiled.append((path, open(path, "rb").read()))
            with open(path, "wb") as out:
                out.write(b"not parquet")
            crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    return spoiled


def mend(spoiled):
    for path, raw in spoiled:
        with open(path, "wb") as out:
            out.write(raw)


def test_a_days_batch_opens_no_other_days_files(spark, store):
    land(spark, store, [(f"r{d}{i}", f"2024-01-{d:02}T08:00:00", "a") for d in range(1, 9) for i in range(3)])
    # the first day stays readable: the schema is read from the first file
    spoiled = spoil(store.read("raw"), "day=1/", "day=5/")
    land(spark, store, [("r50", "2024-01-05T08:00:00", "b"), ("new", "2024-01-09T08:00:00", "b")])
    assert spoiled
    mend(spoiled)
    got = rows(store.read("raw").select("id", "v", "day"))
    assert len(got) == 25 and ("r50", "b", 5) in got and ("new", "b", 9) in got


def test_a_moved_record_is_found(spark, store):
    land(spark, store, [("a", "2024-01-02T08:00:00", "x"), ("b", "2024-01-03T08:00:00", "x"), ("c", "2024-01-04T08:00:00", "x")])
    land(spark, store, [("b", "2024-01-20T08:00:00", "y")])
    assert rows(store.read("raw").select("id", "v", "day")) == [("a", "x", 2), ("b", "y", 20), ("c", "x", 4)]
    land(spark, store, [("b", "2024-01-03T08:00:00", "z")])  # back: the old entry is still right
    assert rows(store.read("raw").select("id", "v", "day")) == [("a", "x", 2), ("b", "z", 3), ("c", "x", 4)]


def test_a_table_without_an_index_gets_one(spark, store):
    store.create("raw", prepare(spark.createDataFrame([("a", "2024-01-02T08:00:00", "x")], SPEC.schema), SPEC), SPEC.partition_by)
    land(spark, store, [("a", "2024-01-05T08:00:00", "y")])
    assert rows(store.read("raw").select("id", "v", "day")) == [("a", "y", 5)]


def test_the_index_is_written_before_the_data(spark, store, monkeypatch):
    land(spark, store, [("a", "2024-01-02T08:00:00", "x")])
    with monkeypatch.context() as m:
        m.setattr(TableStore, "overwrite_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            land(spark, store, [("a", "2024-01-05T08:00:00", "y")])
    assert rows(store.read("raw").select("id", "v", "day")) == [("a", "x", 2)]
    land(spark, store, [("a", "2024-01-05T08:00:00", "y")])
    assert rows(store.read("raw").select("id", "v", "day")) == [("a", "y", 5)]


def test_many_index_files_become_few(spark, store, monkeypatch):
    monkeypatch.setattr(keyindex, "MOST_FILES", 2)
    for i in range(4):
        keyindex.add(store, "t", spark.createDataFrame([(f"k{i}", i)], "k string, p int"), ["k"], ["p"])
    index = store.read(keyindex.index_name("t"))
    assert index.count() == 4 and len(index.inputFiles()) <= 3
    assert keyindex.partitions_of(store, "t", spark.createDataFrame([("k2",), ("zz",)], "k string"), ["k"], ["p"]) == [(2,)]


FACT = "id string, n int, month_key int"


def test_a_fact_batch_opens_only_its_months(spark, store):
    rule = Rule("upsert", ("id",), partition_by=("month_key",), else_keys=("id", "n"))
    publish_table(store, "fact", spark.createDataFrame([(f"f{m}", 1, m) for m in range(202401, 202409)], FACT), rule)
    publish_table(store, "fact", spark.createDataFrame([("g", 1, 202408)], FACT), rule)  # the index is there
    spoiled = spoil(store.read("fact"), "month_key=202401/", "month_key=202403/", "month_key=202405/")
    publish_table(store, "fact", spark.createDataFrame([("f202403", 2, 202405), ("h", 1, 202405)], FACT), rule)
    mend(spoiled)
    got = rows(store.read("fact"))
    assert len(got) == 10 and ("f202403", 2, 202405) in got and ("h", 1, 202405) in got


def test_a_bridge_batch_opens_only_its_groups_months(spark, store):
    rule = Rule("groups", ("c", "p"), partition_by=("month_key",))
    publish_table(store, "bridge", spark.createDataFrame([(f"c{m}", "p", m) for m in range(202401, 202407)], "c string, p string, month_key int"), rule)
    publish_table(store, "bridge", spark.createDataFrame([("c202401", "p", 202401)], "c string, p string, month_key int"), rule)
    spoiled = spoil(store.read("bridge"), "month_key=202401/", "month_key=202403/", "month_key=202404/")
    publish_table(store, "bridge", spark.createDataFrame([("c202403", "p", 202404)], "c string, p string, month_key int"), rule)
    mend(spoiled)
    got = rows(store.read("bridge"))
    assert len(got) == 6 and ("c202403", "p", 202404) in got
