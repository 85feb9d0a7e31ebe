"""Every warehouse operator run on the driver's tables.

The warehouse operators are table-agnostic; here each one runs on a table
that plays the part of the crash feeds:

* ``orders``   - the fact grain (date, status, priority, customer);
* ``lineitem`` - members of a fact row (several per order), like the people
                 and vehicles of a crash;
* ``part``     - an entity dimension reached through a bridge;
* ``customer`` + ``nation`` + ``region`` - location attributes;
* ``events``   - timestamped condition readings: ``user_id`` is the location,
                 ``event_type`` the condition, ``event_id`` the record id.

Keys use sha-256 here (the SQL oracle has no sha-512); the pipeline default is
512 bits.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_parts, date_window, week_year, with_date_parts
from ..functions.clean import DIM_NULL, fill_strings, filled, not_equal
from ..functions.keys import surrogate_key
from ..operators import bridge as bridge_ops
from ..operators import dims, fact, history, merge, reports
from .tables import table

BITS = 256
AS_OF = dt.date(2024, 1, 20)  # fixed "today" of the window and split queries
WINDOW_DAYS = 7
EVENT_SPLIT = "2024-01-20"  # old batch: ts before, new batch: from then on
EVENT_OVERLAP = "2024-01-15"  # start of the overlapping upsert batch
ORDER_SPLIT = "1999-01-01"
ORDER_OVERLAP = "1998-01-01"
SHIP_SPLIT = "1999-01-01"
SHIP_OVERLAP = "1998-07-01"

# Fixed labels of the price-bucket report (the damage-distribution analogue).
PRICE_BUCKETS = ("$100,000 OR LESS", "$100,001 - $250,000", "OVER $250,000")


# ---------------------------------------------------------------- helpers


def customer_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Location attributes per customer: nation, region, market segment."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select("c_custkey", "n_name", "r_name", "c_mktsegment")
    )


LOCATION_ATTRS = ["n_name", "r_name", "c_mktsegment"]


def orders_fact(spark: SparkSession, sf: str, with_location: bool = True) -> DataFrame:
    """The orders fact: every key computed from the row, no lookup joins.

    Only the customer location needs a join (its attributes live on
    customer, hashed once per customer); it is a left join, so no order is
    lost. Reports that do not use the location skip it
    (``with_location=False``): Catalyst cannot drop an outer join by itself.
    """
    o = table(spark, sf, "orders")
    keys = {
        "date_id": dims.date_key("o_orderdate", bits=BITS),
        "priority_id": fact.dim_key(o, ["o_orderpriority"], bits=BITS),
        "status_id": fact.dim_key(o, ["o_orderstatus"], bits=BITS),
    }
    src = o
    if with_location:
        loc = customer_locations(spark, sf)
        loc_keyed = loc.select("c_custkey", fact.dim_key(loc, LOCATION_ATTRS, fill=None, bits=BITS).alias("location_id"))
        src = o.join(loc_keyed, o.o_custkey == loc_keyed.c_custkey, "left")
        keys["location_id"] = F.col("location_id")
    return fact.build_fact(
        src,
        keys=keys,
        degenerate={"o_orderkey": "o_orderkey", "order_group_key": "o_orderkey"},
        measures={"total_price": "o_totalprice"},
    )


def orders_date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.date_dim(table(spark, sf, "orders"), "o_orderdate", bits=BITS)


def event_history(events: DataFrame, cond_col: str = "event_type") -> DataFrame:
    obs = events.select("user_id", "event_id", "ts", surrogate_key([cond_col], BITS).alias("cond_key"))
    return history.build_history(obs, "user_id", "cond_key", "ts", tiebreak=["event_id"])


def value_bucket(c: str = "value"):
    return F.floor(F.col(c) / 100).cast("int")


def one_per_user_day(events: DataFrame, pick=F.max_by) -> DataFrame:
    """One event per user and day: the last (``max_by``) or first (``min_by``)."""
    row = pick(F.struct("ts", "event_type", "value"), "ts")
    agg = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(row.alias("r"))
    return agg.select(
        "user_id",
        "day",
        F.col("r.ts").alias("at_ts"),
        F.col("r.event_type").alias("at_type"),
        F.col("r.value").alias("at_value"),
    )


def order_bridge(lineitem: DataFrame) -> DataFrame:
    return bridge_ops.bridge(lineitem, "l_orderkey", "l_partkey", "order_group_key", "part_id")


# ---------------------------------------------------------------- queries


def q_date_window_extract(spark, sf):
    ev = table(spark, sf, "events")
    return ev.filter(date_window("ts", AS_OF, WINDOW_DAYS)).drop("props")


def q_date_parts(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return with_date_parts(ev, "ts").drop("ts")


def q_null_fill_filter(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return fill_strings(ev, "N/A").filter(not_equal("event_type", "view"))


def q_surrogate_key(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", surrogate_key(["o_orderstatus", "o_orderpriority"], BITS).alias("status_priority_key"))


def q_value_dim(spark, sf):
    return dims.value_dim(table(spark, sf, "orders"), ["o_orderpriority"], "priority_id", bits=BITS)


def q_value_dim_renamed(spark, sf):
    li = table(spark, sf, "lineitem")
    return dims.value_dim(li, ["l_returnflag"], "return_flag_id", rename={"l_returnflag": "return_flag"}, bits=BITS)


def lineitem_flags(li: DataFrame) -> DataFrame:
    return li.select(
        "l_returnflag",
        "l_linestatus",
        F.when(F.col("l_discount") > 0, "Y").otherwise("N").alias("discount_i"),
        F.when(F.col("l_tax") > 0, "Y").otherwise("N").alias("tax_i"),
    )


JUNK_FLAGS = ["l_returnflag", "l_linestatus", "discount_i", "tax_i"]


def q_junk_dim(spark, sf):
    flags = lineitem_flags(table(spark, sf, "lineitem"))
    return dims.value_dim(flags, JUNK_FLAGS, "junk_id", bits=BITS, key_last=True)


def q_location_dim(spark, sf):
    return dims.value_dim(customer_locations(spark, sf), LOCATION_ATTRS, "location_id", fill=None, bits=BITS)


def q_date_dim(spark, sf):
    return orders_date_dim(spark, sf)


def q_time_lookup(spark, sf):
    ev = with_date_parts(table(spark, sf, "events").select("event_id", "ts"), "ts", parts=("hour", "minute", "second"))
    td = dims.time_dim(spark, bits=BITS)
    return fact.lookup(ev, td, ["hour", "minute", "second"], ["time_id"], fixed_size=True).select(
        "event_id", "time_id", "hour", "minute", "second"
    )


def q_entity_dim(spark, sf):
    part = table(spark, sf, "part")
    sold = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    sold_parts = part.join(sold, "p_partkey", "left_semi")
    return dims.entity_dim(sold_parts, part.columns, "p_partkey")


def q_entity_dim_latest(spark, sf):
    """Customers as their latest order describes them (many rows per key)."""
    o = table(spark, sf, "orders")
    return dims.entity_dim(o, ["o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"], "o_custkey", latest_by="o_orderdate")


def q_bridge(spark, sf):
    return order_bridge(table(spark, sf, "lineitem"))


def q_fact_lookup(spark, sf):
    return orders_fact(spark, sf)


def q_fact_lookup_join(spark, sf):
    """The same fact with every key resolved by an equi-join to its dimension
    (the lookup form); equal to ``fact_lookup`` row for row."""
    o = table(spark, sf, "orders")
    parts = date_parts("o_orderdate")
    lookup_parts = ["day", "dayofweek", "month", "week", "year"]  # quarter is implied
    loc = customer_locations(spark, sf)
    src = o.join(loc, o.o_custkey == loc.c_custkey, "left").select(
        *o.columns, *LOCATION_ATTRS, *[parts[p].alias(p) for p in lookup_parts]
    )
    f = fact.lookup(src, orders_date_dim(spark, sf), lookup_parts, ["date_id"])
    f = fact.lookup(f, dims.value_dim(o, ["o_orderpriority"], "priority_id", bits=BITS), ["o_orderpriority"], ["priority_id"])
    f = fact.lookup(f, dims.value_dim(o, ["o_orderstatus"], "status_id", bits=BITS), ["o_orderstatus"], ["status_id"])
    f = fact.lookup(f, q_location_dim(spark, sf), LOCATION_ATTRS, ["location_id"])
    return f.select(
        "date_id", "priority_id", "status_id", "location_id", "o_orderkey",
        F.col("o_orderkey").alias("order_group_key"), F.col("o_totalprice").alias("total_price"),
    )


def q_fact_lookup_nulls(spark, sf):
    """Lookups of a null attribute: kept null in one dimension, filled in the
    other, whose attribute is renamed; no order is lost."""
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
    )
    priority = dims.value_dim(o, ["o_orderpriority"], "priority_id", rename={"o_orderpriority": "priority"}, bits=BITS)
    status = dims.value_dim(o, ["o_orderstatus"], "status_id", fill=None, bits=BITS)
    src = o.withColumn("o_orderpriority", filled("o_orderpriority", DIM_NULL))
    f = fact.lookup(src, priority, [("o_orderpriority", "priority")], ["priority_id"])
    f = fact.lookup(f, status, ["o_orderstatus"], ["status_id"])
    return f.select("o_orderkey", "priority_id", "status_id", "o_orderpriority", "o_orderstatus")


def q_history_intervals(spark, sf):
    return event_history(table(spark, sf, "events"))


def q_history_intervals_second(spark, sf):
    ev = table(spark, sf, "events").withColumn("bucket", value_bucket())
    return event_history(ev, "bucket")


def q_history_compact(spark, sf):
    """Day-level history with equal neighbours merged (coalesce option)."""
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", surrogate_key(["event_type"], BITS).alias("cond_key"))
    return history.build_compact_history(ev, "user_id", "cond_key", "ts", tiebreak=["event_id"])


def _history_batches(spark, sf):
    ev = table(spark, sf, "events")
    old = event_history(ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")))
    new = event_history(ev.where(F.col("ts") >= F.lit(EVENT_SPLIT).cast("timestamp_ntz")))
    return old, new


def q_history_merge(spark, sf):
    old, new = _history_batches(spark, sf)
    return history.merge_history(old, new, "user_id", "cond_key", close="open_only")


def q_history_merge_reference(spark, sf):
    old, new = _history_batches(spark, sf)
    return history.merge_history(old, new, "user_id", "cond_key", close="reference")


def q_point_in_time_lookup(spark, sf):
    """Events before the history's first rows find none."""
    ev = table(spark, sf, "events")
    hist = event_history(ev.where(F.col("ts") >= F.lit(EVENT_OVERLAP).cast("timestamp_ntz")))
    probes = ev.select("event_id", "user_id", "ts")
    return history.point_in_time(probes, "user_id", "ts", "event_id", hist, "user_id", "cond_key")


def q_merge_insert_only(spark, sf):
    li = table(spark, sf, "lineitem")
    target = order_bridge(li.where(F.col("l_shipdate") < F.lit(SHIP_SPLIT).cast("timestamp_ntz")))
    source = order_bridge(li.where(F.col("l_shipdate") >= F.lit(SHIP_OVERLAP).cast("timestamp_ntz")))
    return merge.apply_insert_only(target, source, ["order_group_key", "part_id"])


def q_merge_upsert_all(spark, sf):
    """Days before the overlap stay, those in it change (last event -> first event), later ones are new."""
    ev = table(spark, sf, "events")
    target = one_per_user_day(ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")))
    source = one_per_user_day(ev.where(F.col("ts") >= F.lit(EVENT_OVERLAP).cast("timestamp_ntz")), F.min_by)
    return merge.upsert_all(target, source, ["user_id", "day"])


def q_merge_conditional(spark, sf):
    """Marks per user and hour of day: moved forward, left as they are, or new."""
    ev = table(spark, sf, "events").withColumn("hour", F.hour("ts"))
    target = ev.where(F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")).groupBy("user_id", "hour").agg(F.max("ts").alias("mark_ts"))
    source = ev.where(F.col("event_type") == "purchase").groupBy("user_id", "hour").agg(F.max("ts").alias("mark_ts"))
    return merge.merge(target, source, ["user_id", "hour"], update=["mark_ts"], condition="b.mark_ts > a.mark_ts", read_once=True)


def q_merge_partial_update(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    target = o.where(F.col("o_orderdate") < F.lit(ORDER_SPLIT).cast("timestamp_ntz")).drop("o_orderdate")
    li = table(spark, sf, "lineitem")
    totals = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("new_total"))
    revised = o.where(F.col("o_orderdate") >= F.lit(ORDER_OVERLAP).cast("timestamp_ntz")).join(
        totals, o.o_orderkey == totals.l_orderkey, "left"
    )
    source = revised.select(
        "o_orderkey", "o_orderstatus", F.lit("X-REVISED").alias("o_orderpriority"), F.col("new_total").alias("o_totalprice")
    )
    return merge.merge(target, source, ["o_orderkey"], update=["o_totalprice"], read_once=True)


def _star_views(spark, sf):
    f = orders_fact(spark, sf, with_location=False)
    d = orders_date_dim(spark, sf)
    f.createOrReplaceTempView("sf_fact_orders")
    d.createOrReplaceTempView("sf_dim_order_date")


def grain_sql(grains, prefix: str = "") -> tuple[str, str]:
    """GROUPING SETS clause and grain label for SQL text."""
    cols = reports.grain_columns(grains)
    sets = ", ".join("(" + ", ".join(prefix + c for c in g) + ")" for g in grains.values())
    gid = "grouping_id(" + ", ".join(prefix + c for c in cols) + ")"
    whens = []
    for name, g in grains.items():
        bits = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in g)
        whens.append(f"WHEN {bits} THEN '{name}'")
    label = f"CASE {gid} " + " ".join(whens) + " END"
    return sets, label


def q_report_counts_by_grain(spark, sf):
    """Orders per calendar grain, through fact -> date dimension, as SQL over temp views."""
    _star_views(spark, sf)
    spark.table("sf_dim_order_date").withColumn("week_year", week_year()).createOrReplaceTempView("sf_dim_order_week")
    sets, label = grain_sql(reports.DATE_GRAINS, "d.")
    cols = ", ".join("d." + c for c in reports.grain_columns(reports.DATE_GRAINS))
    return spark.sql(
        f"""
        SELECT {cols}, {label} AS grain, count(*) AS n_orders
        FROM sf_fact_orders f JOIN sf_dim_order_week d ON f.date_id = d.date_id
        GROUP BY GROUPING SETS ({sets})
        """
    )


EVENT_GRAINS = {
    "hour": ("hour",),
    "day": ("year", "month", "day"),
    "week": ("week_year", "week"),
    "dayofweek": ("dayofweek",),
}


def q_report_event_counts_by_grain(spark, sf):
    ev = with_date_parts(table(spark, sf, "events").select("ts"), "ts").withColumn("week_year", week_year())
    return reports.by_grains(ev, [F.count(F.lit(1)).alias("n_events")], EVENT_GRAINS)


def q_report_sum_by_grain(spark, sf):
    li = table(spark, sf, "lineitem").select("l_shipdate", "l_quantity")
    parts = date_parts("l_shipdate")
    parts["week_year"] = week_year(parts["year"], parts["month"], parts["week"])
    li = li.select("l_quantity", *[parts[p].alias(p) for p in reports.grain_columns(reports.DATE_GRAINS)])
    return reports.by_grains(li, [F.sum("l_quantity").alias("sum_quantity")], reports.DATE_GRAINS)


def q_report_member_distribution(spark, sf):
    """Orders with an ECONOMY part, by the part's brand: distinct orders and share."""
    f = orders_fact(spark, sf, with_location=False).select("order_group_key")
    br = order_bridge(table(spark, sf, "lineitem"))
    part = table(spark, sf, "part").where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("part_id"), "p_brand")
    pairs = f.join(br, "order_group_key").join(part, "part_id").select("p_brand", "order_group_key").distinct()
    counts = pairs.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_orders"))
    return reports.share(counts, "n_orders")


def q_report_top_category(spark, sf):
    f = orders_fact(spark, sf, with_location=False).groupBy("priority_id").agg(F.count(F.lit(1)).alias("n"))
    d = dims.value_dim(table(spark, sf, "orders"), ["o_orderpriority"], "priority_id", bits=BITS)
    named = f.join(d, "priority_id").select("o_orderpriority", "n")
    return reports.top_k(named, "o_orderpriority", 1)


def q_report_by_condition(spark, sf):
    f = orders_fact(spark, sf, with_location=False).groupBy("status_id").agg(F.count(F.lit(1)).alias("n_orders"))
    d = dims.value_dim(table(spark, sf, "orders"), ["o_orderstatus"], "status_id", bits=BITS)
    return f.join(d, "status_id").select("o_orderstatus", "n_orders")


def price_bucket(c: str = "total_price"):
    p = F.col(c)
    return (
        F.when(p <= 100000, F.lit(PRICE_BUCKETS[0]))
        .when(p <= 250000, F.lit(PRICE_BUCKETS[1]))
        .otherwise(F.lit(PRICE_BUCKETS[2]))
    )


def q_report_value_distribution(spark, sf):
    f = orders_fact(spark, sf, with_location=False).select(price_bucket().alias("price_bucket"))
    counts = f.groupBy("price_bucket").agg(F.count(F.lit(1)).alias("n_orders"))
    return reports.share(counts, "n_orders")


QUERIES = {
    "date_window_extract": q_date_window_extract,
    "date_parts": q_date_parts,
    "null_fill_filter": q_null_fill_filter,
    "surrogate_key": q_surrogate_key,
    "value_dim": q_value_dim,
    "value_dim_renamed": q_value_dim_renamed,
    "junk_dim": q_junk_dim,
    "location_dim": q_location_dim,
    "date_dim": q_date_dim,
    "time_lookup": q_time_lookup,
    "entity_dim": q_entity_dim,
    "entity_dim_latest": q_entity_dim_latest,
    "bridge": q_bridge,
    "fact_lookup": q_fact_lookup,
    "fact_lookup_join": q_fact_lookup_join,
    "fact_lookup_nulls": q_fact_lookup_nulls,
    "history_intervals": q_history_intervals,
    "history_intervals_second": q_history_intervals_second,
    "history_compact": q_history_compact,
    "history_merge": q_history_merge,
    "history_merge_reference": q_history_merge_reference,
    "point_in_time_lookup": q_point_in_time_lookup,
    "merge_insert_only": q_merge_insert_only,
    "merge_upsert_all": q_merge_upsert_all,
    "merge_conditional": q_merge_conditional,
    "merge_partial_update": q_merge_partial_update,
    "report_counts_by_grain": q_report_counts_by_grain,
    "report_event_counts_by_grain": q_report_event_counts_by_grain,
    "report_sum_by_grain": q_report_sum_by_grain,
    "report_member_distribution": q_report_member_distribution,
    "report_top_category": q_report_top_category,
    "report_by_condition": q_report_by_condition,
    "report_value_distribution": q_report_value_distribution,
}
