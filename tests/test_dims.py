import datetime as dt

from pyspark.sql import functions as F

from starforge.operators import bridge, dims, fact
from tests.conftest import rows


def test_value_dim_fill_distinct_rename(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("B", "x")], "t string, u string")
    d = dims.value_dim(df, ["t", "u"], "k", rename={"t": "kind"})
    assert d.columns == ["k", "kind", "u"]
    assert rows(d, "kind", "u") == [("A", "empty"), ("B", "x")]
    assert d.select("k").distinct().count() == 2


def test_value_dim_no_fill_keeps_nulls_key_last(spark):
    df = spark.createDataFrame([("A", None)], "t string, u string")
    d = dims.value_dim(df, ["t", "u"], "k", fill=None, key_last=True)
    assert d.columns == ["t", "u", "k"]
    r = d.first()
    assert r.u is None and r.k is not None


def test_fact_key_equals_dimension_key(spark):
    df = spark.createDataFrame([("A", None, 1), ("B", "x", 2)], "t string, u string, n int")
    d = dims.value_dim(df, ["t", "u", "n"], "k")
    f = df.select(fact.dim_key(df, ["t", "u", "n"]).alias("k"))
    assert fact.orphan_keys(f, "k", d).count() == 0


def test_time_dim(spark):
    t = dims.time_dim(spark)
    assert t.count() == 86400
    assert t.select("time_id").distinct().count() == 86400
    r = t.where("hour = 7 and minute = 5 and second = 9").first()
    probe = spark.createDataFrame([(7, 5, 9)], "h int, m int, s int")
    assert probe.select(dims.time_key(F.col("h"), F.col("m"), F.col("s"))).first()[0] == r.time_id


def test_date_dim_only_dates_present(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 1, 9),), (dt.datetime(2024, 3, 5),)], "ts timestamp"
    )
    d = dims.date_dim(df, "ts")
    assert d.count() == 2
    assert rows(d, "day", "month", "year", "quarter") == [(1, 1, 2024, 1), (5, 3, 2024, 1)]
    keyed = df.select(dims.date_key("ts").alias("date_id"))
    assert fact.orphan_keys(keyed, "date_id", d).count() == 0


def test_entity_dim_latest_wins(spark):
    df = spark.createDataFrame(
        [("p1", "F", "2024-01-01"), ("p1", "M", "2024-01-03"), ("p2", None, "2024-01-02")], "id string, sex string, d string"
    )
    e = dims.entity_dim(df, ["id", "sex"], "id", latest_by="d")
    assert rows(e) == [("p1", "M"), ("p2", None)]
    assert dims.entity_dim(df, ["id", "sex"], "id", dedupe=False).count() == 3


def test_bridge_distinct_pairs(spark):
    df = spark.createDataFrame([("c1", "v1"), ("c1", "v1"), ("c1", "v2")], "crash string, v string")
    b = bridge.bridge(df, "crash", "v", "vehicle_group_key", "vehicle_id")
    assert b.columns == ["vehicle_group_key", "vehicle_id"]
    assert b.count() == 2
    assert bridge.bridge(df, "crash", "v", "g", distinct=False).count() == 3


def test_lookup_inner_drops_unmatched(spark):
    f = spark.createDataFrame([(1, "a"), (2, "z")], "id int, code string")
    d = spark.createDataFrame([("k1", "a")], "key string, code string")
    out = fact.lookup(f, d, ["code"], ["key"])
    assert rows(out, "id", "key") == [(1, "k1")]
    left = fact.lookup(f, d, [("code", "code")], ["key"], how="left", fixed_size=True)
    assert rows(left, "id", "key") == [(1, "k1"), (2, None)]


def test_entity_dim_tie_is_deterministic(spark):
    a = spark.createDataFrame([("p1", "F", "d1"), ("p1", "M", "d1")], "id string, sex string, d string")
    b = spark.createDataFrame([("p1", "M", "d1"), ("p1", "F", "d1")], "id string, sex string, d string").repartition(3)
    got_a = dims.entity_dim(a, ["id", "sex"], "id", latest_by="d").first().sex
    got_b = dims.entity_dim(b, ["id", "sex"], "id", latest_by="d").first().sex
    assert got_a == got_b == "M"
