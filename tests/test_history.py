"""History mini-dimension: build, merge, point-in-time lookup."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.operators.history import build_history, merge_history, merge_open_rows, point_in_time
from tests.conftest import SF01, rows


def obs(spark, data):
    return spark.createDataFrame(
        [(loc, cond, dt.datetime.fromisoformat(ts), rid) for loc, cond, ts, rid in data],
        "loc string, cond string, ts timestamp, rid string",
    )


def test_build_history_intervals(spark):
    df = obs(
        spark,
        [
            ("L1", "dry", "2024-01-01T08:00:00", "c1"),
            ("L1", "dry", "2024-01-01T09:00:00", "c2"),  # same day -> zero width row before
            ("L1", "wet", "2024-01-03T10:00:00", "c3"),
            ("L2", "icy", "2024-01-02T00:00:00", "c4"),
            ("L1", "wet", "2024-01-03T10:00:00", "c3"),  # exact duplicate observation
        ],
    )
    h = build_history(df, "loc", "cond", "ts", tiebreak=["rid"])
    assert rows(h) == [
        ("L1", "dry", "2024-01-01", "2024-01-01"),
        ("L1", "dry", "2024-01-01", "2024-01-03"),
        ("L1", "wet", "2024-01-03", ""),
        ("L2", "icy", "2024-01-02", ""),
    ]


def events_history(spark, where=None):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    if where is not None:
        ev = ev.where(where)
    return build_history(ev, "user_id", "event_type", "ts", tiebreak=["event_id"])


def test_incremental_equals_full_for_day_aligned_batches(spark):
    split = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    old, new = events_history(spark, split), events_history(spark, ~split)
    merged = merge_history(old, new, "user_id", "event_type")
    full = events_history(spark)
    assert merged.count() == full.count() == 10000
    assert merged.exceptAll(full).count() == 0 and full.exceptAll(merged).count() == 0
    # one open row per entity, and contiguity: every closed row's end is the start of a later row
    assert merged.where("end_date = ''").groupBy("user_id").count().where("count <> 1").count() == 0
    per_entity = merged.groupBy("user_id").agg(
        F.sort_array(F.collect_list("start_date")).alias("starts"),
        F.sort_array(F.collect_list(F.when(F.col("end_date") != "", F.col("end_date")))).alias("ends"),
    )
    for r in per_entity.collect():
        assert r.ends == r.starts[1:], r.user_id


def test_reference_close_rule_rewrites_closed_rows(spark):
    split = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    old, new = events_history(spark, split), events_history(spark, ~split)
    ref = merge_history(old, new, "user_id", "event_type", close="reference")
    full = events_history(spark)
    assert ref.count() == full.count()
    assert ref.exceptAll(full).count() > 0  # same-day closed rows were overwritten


def test_the_reference_rule_drops_late_rows(spark):
    old = spark.createDataFrame([("L1", "dry", "2024-01-05", "")], "loc string, cond string, start_date string, end_date string")
    new = spark.createDataFrame(
        [("L1", "wet", "2024-01-04", "2024-01-06"), ("L1", "icy", "2024-01-06", ""), ("L2", "dry", "2024-01-01", "")],
        "loc string, cond string, start_date string, end_date string",
    )
    got = merge_history(old, new, "loc", "cond")
    assert rows(got) == [("L1", "dry", "2024-01-05", "2024-01-06"), ("L1", "icy", "2024-01-06", ""), ("L2", "dry", "2024-01-01", "")]


def test_point_in_time_one_row_per_fact(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    hist = events_history(spark)
    out = point_in_time(ev.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", hist, "user_id", "event_type")
    assert out.count() == 10000
    assert out.where("event_type is null").count() == 0
    assert out.select("event_id").distinct().count() == 10000


def test_point_in_time_skips_zero_width_and_uncovered(spark):
    hist = spark.createDataFrame(
        [("L1", "dry", "2024-01-01", "2024-01-01"), ("L1", "wet", "2024-01-01", "2024-01-05"), ("L1", "icy", "2024-01-05", "")],
        "loc string, cond string, start_date string, end_date string",
    )
    facts = spark.createDataFrame(
        [(1, "L1", dt.datetime(2024, 1, 1, 12)), (2, "L1", dt.datetime(2024, 1, 4)), (3, "L1", dt.datetime(2024, 2, 1)), (4, "L1", dt.datetime(2023, 12, 31)), (5, "L9", dt.datetime(2024, 1, 2))],
        "id int, loc string, ts timestamp",
    )
    out = point_in_time(facts, "loc", "ts", "id", hist, "loc", "cond")
    assert rows(out, "id", "cond") == [(1, "wet"), (2, "wet"), (3, "icy"), (4, None), (5, None)]


def test_open_rows_merge_equals_full_merge(spark):
    split = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    old, new = events_history(spark, split), events_history(spark, ~split)
    closed_now, open_after = merge_open_rows(old.where("end_date = ''"), new, "user_id", "event_type")
    incremental = old.where("end_date <> ''").unionByName(closed_now).unionByName(open_after)
    full = merge_history(old, new, "user_id", "event_type")
    assert incremental.exceptAll(full).count() == 0 and full.exceptAll(incremental).count() == 0
    assert open_after.where("end_date <> ''").count() == 0
    assert closed_now.where("end_date = ''").count() == 0


def test_compact_history_gives_same_point_in_time_answers(spark):
    from starforge.operators.history import build_compact_history

    ev = spark.read.parquet(f"{SF01}/events.parquet")
    full = events_history(spark)
    compact = build_compact_history(ev, "user_id", "event_type", "ts", tiebreak=["event_id"])
    assert compact.where("start_date = end_date").count() == 0
    assert compact.count() < full.count()
    probes = ev.select("event_id", "user_id", "ts")
    a = point_in_time(probes, "user_id", "ts", "event_id", full, "user_id", "event_type").select("event_id", "event_type")
    b = point_in_time(probes, "user_id", "ts", "event_id", compact, "user_id", "event_type").select("event_id", "event_type")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # no two adjacent rows of an entity share a condition
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("start_date")
    assert compact.withColumn("p", F.lag("event_type").over(w)).where("p = event_type").count() == 0


def test_previous_value_matches_lag(spark):
    from pyspark.sql import Window

    from starforge.operators.sequence import previous_value
    from tests.test_sequence import skewed

    df = skewed(spark)
    got = previous_value(df, ["e"], ["t", "id"], "id", "prv", chunks=5)
    want = df.withColumn("prv", F.lag("id").over(Window.partitionBy("e").orderBy("t", "id")))
    assert rows(got, "e", "t", "id", "prv") == rows(want, "e", "t", "id", "prv")
