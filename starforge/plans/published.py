"""Queries that write and read tables: feed ingest and star publishing.

Both work in fresh folders below the checkpoint root and return what was
published, so the result can be compared with SQL over the inputs.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import date_window, week_year, window_extract
from ..functions.keys import surrogate_key
from ..operators.bridge import bridge
from ..operators.history import observed_history
from ..operators.reports import by_grains, share
from ..session import scratch_path, stage, staging
from ..sources.catalog import register_tables
from ..sources.feeds import PARTITION_COLS, FeedSpec, batch_cutoff, prepare
from ..sources.store import TableStore
from ..sources.watermark import MARKS_TABLE, batch_mark, publish_mark, read_mark
from ..streaming.ingest import ingest_stream
from .analogues import AS_OF, BITS, EVENT_OVERLAP, EVENT_SPLIT, LOCATION_ATTRS, ORDER_OVERLAP, ORDER_SPLIT, PRICE_BUCKETS, WINDOW_DAYS, customer_locations, price_bucket
from .kept import KeptReport, count_rows, read_kept, refresh, sum_of
from .oracle import SQL as QUERY_SQL
from .oracle import grains_select, history_sql, key, part
from .observed import OBSERVED_AT, point_in_time_published, publish_observed, read_observed
from .star import MONTH_KEY, Bridge, EntityDim, History, Rule, Star, ValueDim, build_star, publish_rules, publish_star, publish_table
from .tables import table

EVENT_FEED = FeedSpec(
    name="raw_events",
    mark_name="Events",
    schema=T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.StringType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
    keys=("event_id",),
    date_col="ts",
)


def ingest_events(spark: SparkSession, sf: str) -> TableStore:
    """``events`` landed as JSON in overlapping batches, ingested by availableNow
    file streams. The first batch holds other values for the overlap; of the
    second, the overlap and all later events are landed twice, the last time
    with the values that count."""
    ev = table(spark, sf, "events")
    landing = scratch_path(spark, "landing", "events")
    store = TableStore(spark, scratch_path(spark, "raw"))
    ckpt = scratch_path(spark, "streams", "events")
    late = F.col("ts") >= F.lit(EVENT_OVERLAP).cast("timestamp_ntz")
    first = ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz"))
    landings = [
        [first.withColumn("value", F.when(late, -F.col("value") - 1).otherwise(F.col("value")))],
        [ev.where(late).withColumns({"value": F.col("value") + 1, "event_type": F.lit("draft")}), ev.where(late)],
    ]
    for i, versions in enumerate(landings):
        for j, v in enumerate(versions):
            # as text: the JSON writer would cut microseconds
            v.withColumn("ts", F.col("ts").cast("string")).write.mode("overwrite").json(f"{landing}/batch-{i}-{j}")
        ingest_stream(spark, EVENT_FEED, f"{landing}/*", store, max_files_per_trigger=4, checkpoint=ckpt)
    return store


def q_feed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after all landings: every event once, as landed last."""
    raw = ingest_events(spark, sf).read(EVENT_FEED.name)
    return raw.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*EVENT_FEED.schema.names, *PARTITION_COLS)


def q_feed_marks(spark: SparkSession, sf: str) -> DataFrame:
    """The high-water marks after all landings."""
    marks = ingest_events(spark, sf).read(MARKS_TABLE)
    return marks.withColumn("WatermarkValue", F.col("WatermarkValue").cast("timestamp_ntz"))


def q_feed_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that grows a field: the schema does not name ``props``, the first landing
    does not have it, the second (overlapping) one has."""
    ev = table(spark, sf, "events")
    fields = [f for f in EVENT_FEED.schema if f.name != "props"]
    spec = replace(EVENT_FEED, name="raw_growing", schema=T.StructType(fields), allow_new_columns=True)
    landing = scratch_path(spark, "landing", "growing")
    store = TableStore(spark, scratch_path(spark, "raw"))
    first = ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")).drop("props")
    second = ev.where(F.col("ts") >= F.lit(EVENT_OVERLAP).cast("timestamp_ntz"))
    for i, batch in enumerate((first, second)):
        batch.withColumn("ts", F.col("ts").cast("string")).write.mode("overwrite").json(f"{landing}/batch-{i}")
        ingest_stream(spark, spec, f"{landing}/*", store)
    raw = store.read(spec.name, merge_schema=True)
    return raw.withColumn("ts", F.col("ts").cast("timestamp_ntz")).select(*EVENT_FEED.schema.names, *PARTITION_COLS)


CUTOFF_DAYS = 2


def q_feed_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """What the next landing holds: events after the stored mark less a look-back."""
    ev = table(spark, sf, "events")
    store = TableStore(spark, scratch_path(spark, "raw"))
    first = ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz"))
    publish_mark(store, batch_mark(first, EVENT_FEED.date_col, EVENT_FEED.mark_name))
    cutoff = batch_cutoff(read_mark(spark, store, EVENT_FEED.mark_name), CUTOFF_DAYS)
    return prepare(ev, EVENT_FEED, cutoff).select("event_id", "ts", *PARTITION_COLS)


def orders_star() -> Star:
    return Star(
        main="orders",
        ts="o_orderdate",
        record_id="o_orderkey",
        fact_name="fact_orders",
        value_dims=(
            ValueDim("dim_location", "location_id", tuple(LOCATION_ATTRS), fill=None),
            ValueDim("dim_priority", "priority_id", ("o_orderpriority",)),
            ValueDim("dim_status", "status_id", ("o_orderstatus",)),
        ),
        entity_dims=(EntityDim("dim_part", "parts", "p_partkey", ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")),),
        bridges=(Bridge("bridge_part_group", "lineitem", "l_orderkey", "l_partkey", "part_group_key", "part_id"),),
        histories=(History("status_mini_dim", "dim_location", "dim_status"),),
        group_keys=("part_group_key",),
        measures={"o_totalprice": None},
        bits=256,
    )


# What the first batch holds of the overlap's orders, before they are corrected.
EARLY_PRIORITY = "0-UNKNOWN"
# Price rise of the parts that the second batch sells.
PRICE_RISE = 5


def orders_frames(spark: SparkSession, sf: str, lo: str | None, hi: str | None) -> dict[str, DataFrame]:
    """One batch. Batches differ: the first holds the overlap's orders with
    another priority and price (corrected by the second), the second raises
    the price of the parts it sells."""
    o = table(spark, sf, "orders")
    rise = F.lit(0)
    if lo:
        o = o.where(F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
        rise = F.lit(PRICE_RISE)
    if hi:
        o = o.where(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
        early = F.col("o_orderdate") >= F.lit(ORDER_OVERLAP).cast("timestamp_ntz")
        o = o.withColumns(
            {
                "o_orderpriority": F.when(early, F.lit(EARLY_PRIORITY)).otherwise(F.col("o_orderpriority")),
                "o_totalprice": F.when(early, F.lit(0.0)).otherwise(F.col("o_totalprice")),
            }
        )
    loc = customer_locations(spark, sf)
    orders = o.join(loc, o.o_custkey == loc.c_custkey, "left").drop("c_custkey")
    li = table(spark, sf, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    sold = li.select(F.col("l_partkey").alias("p_partkey")).distinct()
    parts = table(spark, sf, "part").join(sold, "p_partkey", "left_semi")
    parts = parts.withColumn("p_retailprice", F.col("p_retailprice") + rise)
    return {"orders": stage(orders, "extract-orders"), "lineitem": li, "parts": parts}


STAR_DB = "star_orders"


def publish_orders(spark: SparkSession, sf: str) -> tuple[TableStore, list[str]]:
    """Two overlapping batches published, the second twice."""
    star = orders_star()
    rules = publish_rules(star)
    store = TableStore(spark, scratch_path(spark, "served"))
    names: list[str] = []
    for i, (lo, hi) in enumerate([(None, ORDER_SPLIT), (ORDER_OVERLAP, None), (ORDER_OVERLAP, None)]):
        with staging(spark):
            tables = build_star(spark, star, orders_frames(spark, sf, lo, hi))
            names = publish_star(store, tables, rules, star.fact_name)
        if i == 0:
            register_tables(spark, store, STAR_DB, names)  # later publishes move the entries
    return store, names


# Columns of each published table that the content hash covers (layout columns are not content).
CONTENT = {
    "dim_location": ("location_id", "n_name", "r_name", "c_mktsegment"),
    "dim_priority": ("priority_id", "o_orderpriority"),
    "dim_status": ("status_id", "o_orderstatus"),
    "dim_date": ("date_id", "day", "dayofweek", "month", "week", "year", "quarter"),
    "dim_time": ("time_id", "hour", "minute", "second"),
    "dim_part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "status_mini_dim": ("location_id", "status_id", "start_date", "end_date"),
    "bridge_part_group": ("part_group_key", "part_id"),
    "fact_orders": ("part_group_key", "date_id", "time_id", "location_id", "priority_id", "status_id", "month_key", "o_totalprice"),
}
# Number columns, compared in hundredths.
MONEY = ("p_retailprice", "o_totalprice")


def q_publish_star(spark: SparkSession, sf: str) -> DataFrame:
    """Each published table, read through the SQL catalog: row count and a sum
    of row hashes over every column (48 bits of each row's sha-256), which
    does not depend on the rows' order."""
    _, names = publish_orders(spark, sf)
    out = None
    for n in names:
        cols = [F.round(F.col(c) * 100).cast("long") if c in MONEY else F.col(c) for c in CONTENT[n]]
        row = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cols])
        part = F.conv(F.substring(F.sha2(row, 256), 1, 12), 16, 10).cast("decimal(38,0)")
        one = spark.table(f"{STAR_DB}.{n}").agg(
            F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(part).cast("string").alias("content_sum")
        )
        out = one if out is None else out.unionByName(one)
    return out


def q_publish_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The published fact's rows: one per order, as corrected by the later batch."""
    publish_orders(spark, sf)
    return spark.table(f"{STAR_DB}.fact_orders").select("part_group_key", "priority_id", "status_id", "month_key", "o_totalprice")


def q_raw_window_extract(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a raw table partitioned by day, and its rolling window."""
    store = TableStore(spark, scratch_path(spark, "raw"))
    ev = table(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    store.create("raw_events", prepare(ev, EVENT_FEED), PARTITION_COLS)
    return window_extract(store.read("raw_events"), "ts", AS_OF, WINDOW_DAYS, drop=("props",), day_parts=PARTITION_COLS)


# A batch that ends in the middle of a day.
LATE_SPLIT = "2024-01-20 12:00:00"


def q_history_merge_late(spark: SparkSession, sf: str) -> DataFrame:
    """A published history after late, moved and withdrawn observations.

    The first batch has no purchases, and clicks a day late at another user; the
    second brings the purchases of all days, the clicks as they were and the
    rest, and withdraws the errors.
    """
    ev = table(spark, sf, "events")
    rule = Rule("observed", ("event_id",), entity="user_id", cond="cond_key", sort=("user_id", "start_date"))
    store = TableStore(spark, scratch_path(spark, "served"))
    early = F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz")
    click, purchase, error = (F.col("event_type") == t for t in ("click", "purchase", "error"))
    first = ev.where(early & ~purchase).withColumns(
        {"ts": F.when(click, F.col("ts") + F.expr("interval 1 day")).otherwise(F.col("ts")), "user_id": F.when(click, F.col("user_id") + 1).otherwise(F.col("user_id"))}
    )
    second = ev.where((~early | purchase | click) & ~error)

    def observations(df: DataFrame) -> DataFrame:
        return df.select("user_id", surrogate_key(["event_type"], BITS).alias("cond_key"), F.col("ts").alias(OBSERVED_AT), "event_id")

    with staging(spark):
        built = observed_history(observations(first), "user_id", "cond_key", OBSERVED_AT, "event_id")
        publish_table(store, "event_history", built, rule)
        publish_observed(store, "event_history", observations(second), rule, ev.where(error).select("event_id"))
    return read_observed(store, "event_history").select("user_id", "cond_key", "start_date", "end_date")


def q_point_in_time_published(spark: SparkSession, sf: str) -> DataFrame:
    """The last window's events looked up in a published history (two batches, the second late in part)."""
    ev = table(spark, sf, "events")
    rule = Rule("observed", ("event_id",), entity="user_id", cond="cond_key", sort=("user_id", "start_date"))
    store = TableStore(spark, scratch_path(spark, "served"))
    early = (F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz")) & (F.col("event_type") != "purchase")
    obs = ev.select("user_id", surrogate_key(["event_type"], BITS).alias("cond_key"), F.col("ts").alias(OBSERVED_AT), "event_id", early.alias("early"))
    with staging(spark):
        built = observed_history(obs.where("early").drop("early"), "user_id", "cond_key", OBSERVED_AT, "event_id")
        publish_table(store, "event_history", built, rule)
        publish_observed(store, "event_history", obs.where("not early").drop("early"), rule)
    probes = ev.where(date_window("ts", AS_OF, WINDOW_DAYS)).select("event_id", "user_id", "ts")
    return point_in_time_published(store, "event_history", probes, "user_id", "ts", "event_id", rule)


def q_bridge_corrected(spark: SparkSession, sf: str) -> DataFrame:
    """A published bridge whose second batch moves orders to another month and withdraws members.

    The first batch has the overlap's orders a month late, with a member that
    the second no longer holds.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    rule = Rule("groups", ("order_group_key", "part_id"), partition_by=(MONTH_KEY,))
    store = TableStore(spark, scratch_path(spark, "served"))
    overlap = F.col("o_orderdate") >= F.lit(ORDER_OVERLAP).cast("timestamp_ntz")

    def pairs(orders: DataFrame, members: DataFrame) -> DataFrame:
        rows = members.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = rows.withColumn(MONTH_KEY, (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int"))
        return bridge(rows, "l_orderkey", "l_partkey", "order_group_key", "part_id", carry=(MONTH_KEY,))

    late = o.where(F.col("o_orderdate") < F.lit(ORDER_SPLIT).cast("timestamp_ntz"))
    late = late.withColumn("o_orderdate", F.when(overlap, F.col("o_orderdate") + F.expr("interval 1 month")).otherwise(F.col("o_orderdate")))
    wrong = li.withColumn("l_partkey", -F.col("l_suppkey")).join(o.where(overlap), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    with staging(spark):
        for batch in (pairs(late, li.unionByName(wrong)), pairs(o.where(overlap), li)):
            publish_table(store, "bridge_part_group", batch, rule)
    return store.read("bridge_part_group").select("order_group_key", "part_id", MONTH_KEY)


# Corrected orders: the first batch has them a month late and without their price.
def _kept_orders_star(members: bool) -> Star:
    """A fact by month, with ``members`` the bridge to its parts too."""
    return Star(
        main="orders",
        ts="o_orderdate",
        record_id="o_orderkey",
        fact_name="fact_orders",
        value_dims=(ValueDim("dim_priority", "priority_id", ("o_orderpriority",)), ValueDim("dim_status", "status_id", ("o_orderstatus",))),
        time_dim=None,
        entity_dims=(EntityDim("dim_part", "parts", "p_partkey", ("p_partkey", "p_brand", "p_type")),) if members else (),
        bridges=(Bridge("bridge_part_group", "lineitem", "l_orderkey", "l_partkey", "part_group_key", "part_id", partition_ts="o_orderdate"),) if members else (),
        group_keys=("part_group_key",),
        measures={"o_totalprice": None},
        bits=256,
    )


def _order_categories(t) -> DataFrame:
    named = {"priority": F.col("priority_id"), "status": F.col("status_id"), "price": price_bucket("o_totalprice")}
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("asked"), c.alias("value")) for n, c in named.items()]))
    return t["fact_orders"].select(MONTH_KEY, asked.alias("a")).select(MONTH_KEY, "a.asked", "a.value")


def _economy_pairs(t) -> DataFrame:
    parts = t["dim_part"].where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("part_id"), "p_brand")
    pairs = t["fact_orders"].select(MONTH_KEY, "part_group_key").join(t["bridge_part_group"], [MONTH_KEY, "part_group_key"])
    return pairs.join(parts, "part_id").select(MONTH_KEY, "p_brand", "part_group_key").distinct()


KEPT_DAYS = KeptReport(
    "kept_days", ("fact_orders",), MONTH_KEY, ("date_id",),
    {"n_orders": count_rows(), "total_cents": sum_of("cents")},
    lambda t: t["fact_orders"].withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long")),
)
KEPT_CATEGORIES = KeptReport("kept_categories", ("fact_orders",), MONTH_KEY, ("asked", "value"), {"n_orders": count_rows()}, _order_categories)
KEPT_MEMBERS = KeptReport(
    "kept_members", ("fact_orders", "bridge_part_group"), MONTH_KEY, ("p_brand",), {"n_orders": count_rows()}, _economy_pairs, whole=("dim_part",)
)


def kept_orders(spark: SparkSession, sf: str, *kept: KeptReport) -> tuple[TableStore, list[dict[str, list[str]]]]:
    """Orders published twice, the reports refreshed after each; also which months each refresh computed."""
    star = _kept_orders_star(any("bridge_part_group" in r.tables for r in kept))
    store = TableStore(spark, scratch_path(spark, "served"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice")
    overlap = F.col("o_orderdate") >= F.lit(ORDER_OVERLAP).cast("timestamp_ntz")
    first = o.where(F.col("o_orderdate") < F.lit(ORDER_SPLIT).cast("timestamp_ntz")).withColumns(
        {
            "o_orderdate": F.when(overlap, F.col("o_orderdate") + F.expr("interval 1 month")).otherwise(F.col("o_orderdate")),
            "o_totalprice": F.when(overlap, F.lit(0.0)).otherwise(F.col("o_totalprice")),
        }
    )
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    computed = []
    for orders in (first, o.where(overlap)):
        with staging(spark):
            orders = stage(orders, "extract-orders")
            members = li.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
            tables = build_star(spark, star, {"orders": orders, "lineitem": members, "parts": parts})
            publish_star(store, tables, publish_rules(star), star.fact_name)
        computed.append({r.name: refresh(store, r) for r in kept})
    return store, computed


def q_report_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Orders and their total per calendar grain, from months' partial aggregates kept through a correction."""
    store, _ = kept_orders(spark, sf, KEPT_DAYS)
    days = read_kept(store, KEPT_DAYS).join(store.read("dim_date"), "date_id").withColumn("week_year", week_year())
    return by_grains(days, [F.sum("n_orders").alias("n_orders"), F.sum("total_cents").alias("total_cents")])


def q_report_incremental_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by priority, status and price class (count, share), from kept partial aggregates."""
    store, _ = kept_orders(spark, sf, KEPT_CATEGORIES)
    counts = read_kept(store, KEPT_CATEGORIES)
    out = None
    for asked, dim, key_col, attr in (("priority", "dim_priority", "priority_id", "o_orderpriority"), ("status", "dim_status", "status_id", "o_orderstatus"), ("price", None, None, None)):
        one = share(counts.where(F.col("asked") == asked), "n_orders")
        if dim:
            one = one.withColumnRenamed("value", key_col).join(store.read(dim), key_col).withColumnRenamed(attr, "value")
        one = one.select("asked", "value", "n_orders", "share")
        out = one if out is None else out.unionByName(one)
    return out


def q_report_incremental_members(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with an ECONOMY part by the part's brand, through the bridge, from kept partial aggregates."""
    store, _ = kept_orders(spark, sf, KEPT_MEMBERS)
    return share(read_kept(store, KEPT_MEMBERS), "n_orders")


PUBLISHED = {
    "feed_ingest": q_feed_ingest,
    "feed_marks": q_feed_marks,
    "feed_new_column": q_feed_new_column,
    "feed_cutoff": q_feed_cutoff,
    "publish_star": q_publish_star,
    "publish_fact": q_publish_fact,
    "raw_window_extract": q_raw_window_extract,
    "history_merge_late": q_history_merge_late,
    "point_in_time_published": q_point_in_time_published,
    "bridge_corrected": q_bridge_corrected,
    "report_incremental": q_report_incremental,
    "report_incremental_categories": q_report_incremental_categories,
    "report_incremental_members": q_report_incremental_members,
}

def _published_sql() -> str:
    """The published tables computed in one go from the last version of every record."""
    overlap, split = f"TIMESTAMP '{ORDER_OVERLAP}'", f"TIMESTAMP '{ORDER_SPLIT}'"
    day = ("day", "dayofweek", "month", "week", "year", "quarter")
    dates = ", ".join(f"{part(p, 'o_orderdate')} AS {p}" for p in day)
    hms = key("printf('%02d%02d%02d', hour(t), minute(t), second(t))")
    late = f"p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= {overlap}))"
    early = f"SELECT '{EARLY_PRIORITY}' AS p FROM orders WHERE o_orderdate >= {overlap} AND o_orderdate < {split}"
    location = key("n_name", "r_name", "c_mktsegment")
    rows = {
        "dim_location": f"SELECT DISTINCT {location} AS k, n_name, r_name, c_mktsegment FROM o",
        "dim_priority": f"SELECT {key('p')} AS k, p FROM (SELECT o_orderpriority AS p FROM orders UNION {early})",
        "dim_status": f"SELECT DISTINCT {key('o_orderstatus')} AS k, o_orderstatus FROM orders",
        "dim_date": f"SELECT {key(*day)} AS k, * FROM (SELECT DISTINCT {dates} FROM orders)",
        "dim_time": f"SELECT {hms} AS k, hour(t), minute(t), second(t) FROM "
        "(SELECT unnest(generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01 23:59:59', INTERVAL 1 SECOND)) AS t)",
        "dim_part": f"SELECT p_partkey, p_name, p_brand, p_type, p_size, "
        f"CAST(round((p_retailprice + CASE WHEN {late} THEN {PRICE_RISE} ELSE 0 END) * 100) AS BIGINT) FROM part "
        "WHERE p_partkey IN (SELECT l_partkey FROM lineitem)",
        "status_mini_dim": f"SELECT {location}, {key('o_orderstatus')}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), "
        f"coalesce(CAST(CAST(lead(o_orderdate) OVER (PARTITION BY n_name, r_name, c_mktsegment "
        "ORDER BY o_orderdate, o_orderkey) AS DATE) AS VARCHAR), '') FROM o",
        "bridge_part_group": "SELECT DISTINCT l_orderkey, l_partkey FROM lineitem",
        "fact_orders": f"SELECT o_orderkey, {key(*[part(p, 'o_orderdate') for p in day])}, "
        f"{key(PRINTF_HMS)}, {location}, {key('o_orderpriority')}, {key('o_orderstatus')}, "
        "year(o_orderdate) * 100 + month(o_orderdate), CAST(round(o_totalprice * 100) AS BIGINT) FROM o",
    }
    hashed = "CAST('0x' || substr(sha256({row}), 1, 12) AS BIGINT)"
    out = []
    for name, sql in rows.items():
        cols = [f"c{i}" for i in range(len(CONTENT[name]))]
        row = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols) + ")"
        out.append(
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum({hashed.format(row=row)}) AS VARCHAR) AS content_sum "
            f"FROM ({sql}) AS x({', '.join(cols)})"
        )
    locations = f"""loc AS (SELECT c.c_custkey, n.n_name, r.r_name, c.c_mktsegment
                     FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                     JOIN region r ON n.n_regionkey = r.r_regionkey),
             o AS (SELECT orders.*, loc.n_name, loc.r_name, loc.c_mktsegment
                   FROM orders LEFT JOIN loc ON o_custkey = loc.c_custkey)"""
    return f"WITH {locations}\n" + "\nUNION ALL\n".join(out)


PRINTF_HMS = "printf('%02d%02d%02d', hour(o_orderdate), minute(o_orderdate), second(o_orderdate))"

SQL = {
    "feed_ingest": """
        SELECT event_id, ts, user_id, event_type, value, props,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(dayofmonth(ts) AS INTEGER) AS day
        FROM events
    """,
    "feed_marks": """SELECT 'Events' AS "TableName", max(ts) AS "WatermarkValue" FROM events""",
    "feed_new_column": f"""
        SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts >= TIMESTAMP '{EVENT_OVERLAP}' THEN props END AS props,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(dayofmonth(ts) AS INTEGER) AS day
        FROM events
    """,
    "feed_cutoff": f"""
        SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(dayofmonth(ts) AS INTEGER) AS day
        FROM events
        WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT}') - INTERVAL {CUTOFF_DAYS} DAY
    """,
    "publish_star": _published_sql(),
    "publish_fact": f"""
        SELECT o_orderkey AS part_group_key, {key('o_orderpriority')} AS priority_id, {key('o_orderstatus')} AS status_id,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key, o_totalprice
        FROM orders
    """,
    "raw_window_extract": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(dayofmonth(ts) AS INTEGER) AS day
        FROM events WHERE ts >= DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY AND ts < DATE '{AS_OF}' + INTERVAL 1 DAY
    """,
    "history_merge_late": history_sql(where="WHERE event_type <> 'error'"),
    "point_in_time_published": f"""
        WITH h AS ({history_sql()}),
             e AS (SELECT event_id, user_id, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
                   WHERE ts >= DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY AND ts < DATE '{AS_OF}' + INTERVAL 1 DAY)
        SELECT e.event_id, e.user_id, e.ts, h.cond_key, h.start_date, h.end_date
        FROM e LEFT JOIN h
          ON h.user_id = e.user_id AND h.start_date <= e.day AND (h.end_date = '' OR e.day < h.end_date)
    """,
    "bridge_corrected": """
        SELECT DISTINCT l_orderkey AS order_group_key, l_partkey AS part_id,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "report_incremental": grains_select(
        "year quarter month week day dayofweek",
        "count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents",
        "o_orderdate",
        "orders",
    ),
    "report_incremental_categories": f"""
        WITH asked AS (
            SELECT 'priority' AS asked, o_orderpriority AS value FROM orders
            UNION ALL SELECT 'status', o_orderstatus FROM orders
            UNION ALL SELECT 'price', CASE WHEN o_totalprice <= 100000 THEN '{PRICE_BUCKETS[0]}'
                                           WHEN o_totalprice <= 250000 THEN '{PRICE_BUCKETS[1]}'
                                           ELSE '{PRICE_BUCKETS[2]}' END FROM orders),
        c AS (SELECT asked, value, count(*) AS n_orders FROM asked GROUP BY ALL)
        SELECT asked, value, n_orders, n_orders / sum(n_orders) OVER (PARTITION BY asked) AS share FROM c
    """,
    "report_incremental_members": QUERY_SQL["report_member_distribution"],
}
