"""Merge operators: semantics of SQL MERGE, plus properties."""

import pytest

from starforge.operators import merge
from tests.conftest import rows

SCHEMA = "k string, a string, n int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("1", "x", 1), ("2", "y", 2), (None, "z", 3)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("2", "Y", 20), ("3", "w", 30), (None, "n", 40)], SCHEMA)


def test_insert_only_never_changes_existing_rows(target, source):
    out = merge.apply_insert_only(target, source, ["k"])
    assert rows(out) == sorted([("1", "x", 1), ("2", "y", 2), (None, "z", 3), ("3", "w", 30), (None, "n", 40)], key=repr)
    assert target.exceptAll(out).count() == 0


def test_upsert_all(target, source):
    out = merge.upsert_all(target, source, ["k"])
    assert rows(out) == sorted([("1", "x", 1), ("2", "Y", 20), (None, "z", 3), ("3", "w", 30), (None, "n", 40)], key=repr)


def test_upsert_is_idempotent_on_non_null_keys(spark, target):
    src = spark.createDataFrame([("2", "Y", 20), ("3", "w", 30)], SCHEMA)
    once = merge.upsert_all(target, src, ["k"])
    twice = merge.upsert_all(once, src, ["k"])
    assert rows(once) == rows(twice)


def test_general_merge_all_equals_upsert(target, source):
    a = merge.merge(target, source, ["k"], update="all")
    b = merge.upsert_all(target, source, ["k"])
    assert rows(a) == rows(b)


def test_conditional_update(spark):
    t = spark.createDataFrame([("Crashes", 5), ("People", 9)], "TableName string, v int")
    s = spark.createDataFrame([("Crashes", 7), ("People", 3), ("Vehicles", 1)], "TableName string, v int")
    out = merge.merge(t, s, ["TableName"], update=["v"], condition="b.v > a.v")
    assert rows(out) == [("Crashes", 7), ("People", 9), ("Vehicles", 1)]


def test_partial_update_sets_only_listed_columns(target, source):
    out = merge.merge(target, source, ["k"], update=["n"])
    assert ("2", "y", 20) in rows(out)
    assert ("3", "w", 30) in rows(out)


def test_no_insert(target, source):
    out = merge.merge(target, source, ["k"], update="all", insert=False)
    assert rows(out) == sorted([("1", "x", 1), ("2", "Y", 20), (None, "z", 3)], key=repr)


def test_duplicate_source_rows_fail_by_default(spark, target):
    dup = spark.createDataFrame([("2", "a", 1), ("2", "b", 2)], SCHEMA)
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert_all(target, dup, ["k"]).collect()
    with pytest.raises(Exception, match="several source rows"):
        merge.merge(target, dup, ["k"], update="all").collect()
    with pytest.raises(Exception, match="several source rows"):
        merge.upsert_all(target, dup, ["k"], stage_source=False).collect()
    latest = merge.upsert_all(target, dup, ["k"], on_duplicate="latest", order="n")
    assert ("2", "b", 2) in rows(latest) and ("2", "a", 1) not in rows(latest)


def test_insert_only_is_idempotent(target, source):
    once = merge.apply_insert_only(target, source.where("k is not null"), ["k"])
    twice = merge.apply_insert_only(once, source.where("k is not null"), ["k"])
    assert rows(once) == rows(twice)


def test_several_source_rows_fail_in_both_plans_only_where_they_match(spark, target):
    dup = spark.createDataFrame([("2", "a", 1), ("2", "b", 2)], SCHEMA)
    new = spark.createDataFrame([("9", "a", 1), ("9", "b", 2)], SCHEMA)
    for once in (False, True):
        with pytest.raises(Exception, match="several source rows"):
            merge.merge(target, dup, ["k"], update=["n"], read_once=once).collect()
        assert rows(merge.merge(target, new, ["k"], update=["n"], read_once=once)) == sorted(rows(target) + rows(new), key=repr)


def test_repeated_null_keys_and_further_columns(spark):
    t = spark.createDataFrame([(None, 1, {"a": 1}), (None, 1, {"a": 1}), ("x", 2, {})], "k string, n int, m map<string,int>")
    s = spark.createDataFrame([(5, None, "extra"), (5, None, "extra"), (6, "x", "extra")], "n int, k string, other string")
    want = [(None, 1), (None, 1), (None, 5), (None, 5), ("x", 6)]
    assert rows(merge.merge(t, s, ["k"], read_once=True).select("k", "n")) == sorted(want, key=repr)


def test_each_side_is_read_and_exchanged_once(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(100).selectExpr("cast(id as string) k", "'a' a", "cast(id as int) n").write.parquet(f"{tmp_path}/{name}")
    t, s = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("t", "s"))
    for update, condition in (("all", None), (["n"], "b.n > a.n")):
        plan = merge.merge(t, s, ["k"], update=update, condition=condition, read_once=True)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2, plan


def test_empty_sides(spark, target):
    none = spark.createDataFrame([], SCHEMA)
    assert rows(merge.merge(target, none, ["k"], read_once=True)) == rows(target)
    assert rows(merge.merge(none, target, ["k"], read_once=True)) == rows(target)
