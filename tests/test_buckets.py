"""Entity tables in hash folders: a batch rewrites the folders of its changes."""

import pytest

from starforge.plans.star import Rule, publish_table
from starforge.session import scratch_path
from starforge.sources.store import TableStore
from tests.conftest import rows

RULE = Rule("upsert", ("k",), buckets=8)
DIM = "k string, v int"


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "buckets"))


def publish(spark, store, data):
    publish_table(store, "dim", spark.createDataFrame(data, DIM), RULE)
    return rows(store.read("dim").select("k", "v"))


def files(store):
    return {f for f in store.read("dim").inputFiles()}


def test_a_one_row_change_rewrites_one_bucket(spark, store):
    data = [(f"k{i:03}", i) for i in range(200)]
    assert publish(spark, store, data) == data
    before, version = files(store), store.current_version("dim")
    folder = {f.split("/")[-2] for f in before}
    assert len(folder) == 8
    assert publish(spark, store, [("k007", 7), ("k008", 8)]) == data and files(store) == before  # nothing differs
    got = publish(spark, store, [("k007", 70), ("k008", 8)])
    assert got == [(k, 70 if k == "k007" else v) for k, v in data]
    gone = before - files(store)
    assert len({f.split("/")[-2] for f in gone}) == 1 and store.current_version("dim") == version
    got = publish(spark, store, [("new", 1), (None, 5)])
    assert len(got) == 202 and len(publish(spark, store, [("new", 1), (None, 5)])) == 202


def test_a_table_without_buckets_is_dealt_once(spark, store):
    store.create("dim", spark.createDataFrame([("a", 1), ("b", 2)], DIM))
    assert publish(spark, store, [("b", 3), ("c", 4)]) == [("a", 1), ("b", 3), ("c", 4)]
    assert store.partition_columns("dim") == ["bucket"]


def test_a_key_twice_in_a_batch_fails(spark, store):
    publish(spark, store, [("a", 1)])
    with pytest.raises(Exception, match="several source rows"):
        publish(spark, store, [("b", 1), ("b", 2)])
