import datetime as dt

from pyspark.sql import functions as F

from starforge.functions.calendar import date_window, parse_timestamp, week_year, window_extract, with_date_parts
from starforge.functions.clean import fill_strings, measure, not_equal
from starforge.functions.keys import key_text, surrogate_key
from starforge.operators.reports import share


def test_key_is_injective_where_plain_concat_collides(spark):
    df = spark.createDataFrame([("1", "11"), ("11", "1")], "a string, b string")
    ours = [r[0] for r in df.select(surrogate_key(["a", "b"], 256)).collect()]
    compat = [r[0] for r in df.select(surrogate_key(["a", "b"], 256, compat=True)).collect()]
    assert ours[0] != ours[1]
    assert compat[0] == compat[1]


def test_key_null_and_empty_parts(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), (None, "x")], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key(["a", "b"])).collect()]
    assert all(k is not None and len(k) == 128 for k in keys)
    assert len(set(keys)) == 3
    compat = [r[0] for r in df.select(surrogate_key(["a", "b"], compat=True)).collect()]
    assert compat[0] is None and compat[2] is None


def test_key_text_form(spark):
    df = spark.createDataFrame([("ab", 7, None)], "a string, b int, c string")
    assert df.select(key_text(["a", "b", "c"])).first()[0] == "2:ab|1:7|~"


def test_date_parts_sunday_and_iso_week(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 13, 5, 9),)], "ts timestamp")
    r = with_date_parts(df, "ts").first()
    assert (r.hour, r.minute, r.second) == (13, 5, 9)
    assert r.dayofweek == 1  # Sunday
    assert (r.week, r.year, r.quarter, r.month, r.day) == (52, 2023, 1, 1, 1)


def test_date_window_both_ends_included(spark):
    days = [dt.datetime(2024, 1, d, 23, 59) for d in range(10, 22)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    got = sorted(r.ts.day for r in df.where(date_window("ts", dt.date(2024, 1, 20), 7)).collect())
    assert got == list(range(13, 21))


def test_window_extract_parses_dirty_strings(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-20T10:00:00.000"), ("b", "N/A"), ("c", "2024-01-01T00:00:00"), ("d", "garbage")],
        "id string, crash_date string",
    )
    out = window_extract(df, "crash_date", "2024-01-20", 7, with_parts=True)
    assert [r.id for r in out.collect()] == ["a"]
    assert out.first().hour == 10
    assert df.select(parse_timestamp("crash_date").alias("t")).where("t is null").count() == 2


def test_fill_only_strings_and_not_equal_drops_nulls(spark):
    df = spark.createDataFrame([(None, None), ("PEDESTRIAN", 1), ("CAR", 2)], "u string, n int")
    filled = fill_strings(df, "N/A")
    assert filled.where("n is null").count() == 1  # int column untouched
    assert sorted(r.u for r in filled.where(not_equal("u", "PEDESTRIAN")).collect()) == ["CAR", "N/A"]
    assert [r.u for r in df.where(not_equal("u", "PEDESTRIAN")).collect()] == ["CAR"]


def test_measure_try_cast(spark):
    df = spark.createDataFrame([("3",), ("N/A",), (None,)], "m string")
    assert [r[0] for r in df.select(measure("m", "int")).collect()] == [3, None, None]
    assert df.select(F.sum(measure("m", "int"))).first()[0] == 3


def test_compat_key_is_plain_sha512_of_concatenation(spark):
    import hashlib

    df = spark.createDataFrame([("07", "05", "09"), ("MAIN ST", "30", "-87.6")], "a string, b string, c string")
    got = [r[0] for r in df.select(surrogate_key(["a", "b", "c"], 512, compat=True)).collect()]
    want = [hashlib.sha512((a + b + c).encode()).hexdigest() for a, b, c in [("07", "05", "09"), ("MAIN ST", "30", "-87.6")]]
    assert got == want
    ours = df.select(surrogate_key(["a", "b", "c"], 256)).first()[0]
    assert ours == hashlib.sha256(b"2:07|2:05|2:09").hexdigest()


def test_scale_conf():
    from starforge.session import scale_conf

    big = scale_conf(100 * (1 << 40), 8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"
    small = scale_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) == 64 << 20


def test_week_year_at_the_turn_of_the_year(spark):
    days = ["1995-01-01", "1995-12-31", "1996-01-01", "1996-12-30", "2000-01-02", "2000-12-31", "2020-12-31", "2021-01-03", "2021-01-04"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select("d", F.to_date("d").alias("t"))
    got = with_date_parts(df, "t", ("year", "month", "week")).select("d", week_year().alias("y"), "week").collect()
    for r in got:
        assert (r.y, r.week) == dt.date.fromisoformat(r.d).isocalendar()[:2]


def test_share_of_a_total_of_zero_is_null(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 0)], "k string, n long")
    assert {r.share for r in share(rows, "n").collect()} == {None}
    assert share(rows.limit(0), "n").collect() == []
    assert {r.k: r.share for r in share(rows.withColumn("n", F.when(rows.k == "a", 1).otherwise(3)), "n").collect()} == {"a": 0.25, "b": 0.75}
