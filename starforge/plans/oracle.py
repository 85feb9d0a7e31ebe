"""The same queries as ANSI SQL for DuckDB (the correctness oracle).

Written independently of the DataFrame code: joins, windows and range
conditions spelled out in SQL. DuckDB differences handled here: no sha-512
(queries use sha-256), ``dayofweek`` is 0-based, date parts are BIGINT.
"""

from __future__ import annotations

from ..functions.keys import KEY_LENGTH_MARK, KEY_NULL_TOKEN, KEY_PART_SEPARATOR
from .analogues import (
    AS_OF,
    EVENT_OVERLAP,
    EVENT_SPLIT,
    ORDER_OVERLAP,
    ORDER_SPLIT,
    PRICE_BUCKETS,
    SHIP_OVERLAP,
    SHIP_SPLIT,
    WINDOW_DAYS,
)


def key(*exprs: str) -> str:
    parts = []
    for e in exprs:
        s = f"CAST({e} AS VARCHAR)"
        parts.append(f"coalesce(CAST(length({s}) AS VARCHAR) || '{KEY_LENGTH_MARK}' || {s}, '{KEY_NULL_TOKEN}')")
    return f"sha256(concat_ws('{KEY_PART_SEPARATOR}', {', '.join(parts)}))"


def part(name: str, ts: str) -> str:
    if name == "dayofweek":
        return f"CAST(dayofweek({ts}) + 1 AS INTEGER)"
    if name == "week":
        return f"CAST(weekofyear({ts}) AS INTEGER)"
    if name == "day":
        return f"CAST(dayofmonth({ts}) AS INTEGER)"
    return f"CAST({name}({ts}) AS INTEGER)"


DATE_DIM = ("day", "dayofweek", "month", "week", "year", "quarter")


def date_key(ts: str) -> str:
    return key(*[part(p, ts) for p in DATE_DIM])


LOCATIONS = """
    SELECT c.c_custkey, n.n_name, r.r_name, c.c_mktsegment
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
"""

FACT = f"""
    SELECT o.o_orderkey, o.o_orderkey AS order_group_key,
           {date_key('o.o_orderdate')} AS date_id,
           {key("coalesce(o.o_orderpriority, 'empty')")} AS priority_id,
           {key("coalesce(o.o_orderstatus, 'empty')")} AS status_id,
           {key('l.n_name', 'l.r_name', 'l.c_mktsegment')} AS location_id,
           o.o_totalprice AS total_price
    FROM orders o LEFT JOIN ({LOCATIONS}) l ON o.o_custkey = l.c_custkey
"""

DATE_DIM_SQL = f"""
    SELECT {key(*DATE_DIM)} AS date_id, {', '.join(DATE_DIM)}
    FROM (SELECT DISTINCT {', '.join(part(p, 'd') + ' AS ' + p for p in DATE_DIM)}
          FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))
"""


def history_sql(cond: str = "event_type", where: str = "") -> str:
    return f"""
    SELECT user_id, {key(cond)} AS cond_key,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS start_date,
           coalesce(CAST(CAST(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DATE) AS VARCHAR), '') AS end_date
    FROM events {where}
    """


BUCKET = "CAST(floor(value / 100) AS INTEGER)"


def one_per_user_day(where: str, pick: str) -> str:
    return f"""
    SELECT user_id, CAST(ts AS DATE) AS day, {pick}(ts, ts) AS at_ts, {pick}(event_type, ts) AS at_type,
           {pick}(value, ts) AS at_value
    FROM events {where} GROUP BY user_id, CAST(ts AS DATE)
    """


def bridge_sql(where: str) -> str:
    return f"SELECT DISTINCT l_orderkey AS order_group_key, l_partkey AS part_id FROM lineitem {where}"


def grains_select(grains: str, agg: str, day: str, src: str) -> str:
    """One plain GROUP BY per grain (``day`` is the date expression); the week grain by ISO year and ISO week."""
    columns = {
        "year": "year({d}) AS year",
        "quarter": "year({d}) AS year, quarter({d}) AS quarter",
        "month": "year({d}) AS year, month({d}) AS month",
        "week": "isoyear({d}) AS week_year, week({d}) AS week",
        "day": "year({d}) AS year, month({d}) AS month, dayofmonth({d}) AS day",
        "dayofweek": "dayofweek({d}) + 1 AS dayofweek",
        "hour": "hour({d}) AS hour",
    }
    one = "SELECT '{g}' AS grain, {c}, {agg} FROM {src} GROUP BY ALL"
    every = "\nUNION ALL BY NAME\n".join(one.format(g=g, c=columns[g].format(d=day), agg=agg, src=src) for g in grains.split())
    names = dict.fromkeys(c.split(" AS ")[1] for g in grains.split() for c in columns[g].split(", "))
    return f"SELECT * REPLACE ({', '.join(f'CAST({n} AS INTEGER) AS {n}' for n in names)}) FROM ({every})"


def _parts_cols(ts: str, names) -> str:
    return ", ".join(f"{part(p, ts)} AS {p}" for p in names)


SQL: dict[str, str] = {
    "date_window_extract": f"""
        SELECT event_id, ts, user_id, event_type, value FROM events
        WHERE CAST(ts AS DATE) BETWEEN DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY AND DATE '{AS_OF}'
    """,
    "date_parts": f"""
        SELECT event_id, {_parts_cols('ts', ('hour', 'minute', 'second', 'day', 'dayofweek', 'month', 'week', 'year', 'quarter'))}
        FROM events
    """,
    "null_fill_filter": """
        SELECT event_id, user_id, coalesce(nullif(event_type, 'error'), 'N/A') AS event_type FROM events
        WHERE coalesce(nullif(event_type, 'error'), 'N/A') <> 'view'
    """,
    "surrogate_key": f"""
        SELECT o_orderkey, {key('o_orderstatus', 'o_orderpriority')} AS status_priority_key FROM orders
    """,
    "value_dim": f"""
        SELECT {key('o_orderpriority')} AS priority_id, o_orderpriority
        FROM (SELECT DISTINCT coalesce(o_orderpriority, 'empty') AS o_orderpriority FROM orders)
    """,
    "value_dim_renamed": f"""
        SELECT {key('return_flag')} AS return_flag_id, return_flag
        FROM (SELECT DISTINCT coalesce(l_returnflag, 'empty') AS return_flag FROM lineitem)
    """,
    "junk_dim": f"""
        SELECT l_returnflag, l_linestatus, discount_i, tax_i,
               {key('l_returnflag', 'l_linestatus', 'discount_i', 'tax_i')} AS junk_id
        FROM (SELECT DISTINCT coalesce(l_returnflag, 'empty') AS l_returnflag,
                     coalesce(l_linestatus, 'empty') AS l_linestatus,
                     CASE WHEN l_discount > 0 THEN 'Y' ELSE 'N' END AS discount_i,
                     CASE WHEN l_tax > 0 THEN 'Y' ELSE 'N' END AS tax_i
              FROM lineitem)
    """,
    "location_dim": f"""
        SELECT {key('n_name', 'r_name', 'c_mktsegment')} AS location_id, n_name, r_name, c_mktsegment
        FROM (SELECT DISTINCT n_name, r_name, c_mktsegment FROM ({LOCATIONS}))
    """,
    "date_dim": DATE_DIM_SQL,
    "time_lookup": f"""
        SELECT event_id,
               {key("printf('%02d%02d%02d', hour(ts), minute(ts), second(ts))")} AS time_id,
               {_parts_cols('ts', ('hour', 'minute', 'second'))}
        FROM events
    """,
    "entity_dim": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
        WHERE p_partkey IN (SELECT l_partkey FROM lineitem)
    """,
    "entity_dim_latest": """
        SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC, o_totalprice DESC) = 1
    """,
    "bridge": bridge_sql(""),
    "fact_lookup": FACT,
    "fact_lookup_join": FACT,
    "fact_lookup_nulls": f"""
        SELECT o_orderkey, coalesce(p, 'empty') AS o_orderpriority, s AS o_orderstatus,
               {key("coalesce(p, 'empty')")} AS priority_id, {key('s')} AS status_id
        FROM (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p, nullif(o_orderstatus, 'P') AS s FROM orders)
    """,
    "history_intervals": history_sql(),
    "history_intervals_second": history_sql(BUCKET),
    "history_compact": f"""
        WITH daily AS (
            SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS start_date,
                   arg_max({key('event_type')}, ts) AS cond_key
            FROM events GROUP BY user_id, CAST(CAST(ts AS DATE) AS VARCHAR)),
        p AS (SELECT *, lag(cond_key) OVER (PARTITION BY user_id ORDER BY start_date) AS prev FROM daily),
        c AS (SELECT user_id, cond_key, start_date FROM p WHERE prev IS NULL OR prev <> cond_key)
        SELECT user_id, cond_key, start_date,
               coalesce(lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date), '') AS end_date
        FROM c
    """,
    # Incremental merge with the open-row close equals the full recompute.
    "history_merge": history_sql(),
    "history_merge_reference": f"""
        WITH old AS ({history_sql(where=f"WHERE ts < TIMESTAMP '{EVENT_SPLIT}'")}),
             new AS ({history_sql(where=f"WHERE ts >= TIMESTAMP '{EVENT_SPLIT}'")}),
             mx AS (SELECT user_id, max(start_date) AS m FROM old GROUP BY user_id),
             kept AS (SELECT n.* FROM new n LEFT JOIN mx ON n.user_id = mx.user_id
                      WHERE n.start_date > mx.m OR mx.m IS NULL),
             mn AS (SELECT user_id, min(start_date) AS s FROM kept GROUP BY user_id),
             closing AS (SELECT DISTINCT o.user_id, o.cond_key, o.start_date, mn.s
                         FROM old o JOIN mn ON o.user_id = mn.user_id WHERE o.end_date = '')
        SELECT o.user_id, o.cond_key, o.start_date, coalesce(c.s, o.end_date) AS end_date
        FROM old o LEFT JOIN closing c
          ON o.user_id = c.user_id AND o.cond_key = c.cond_key AND o.start_date = c.start_date
        UNION ALL
        SELECT user_id, cond_key, start_date, end_date FROM kept
    """,
    "point_in_time_lookup": f"""
        WITH h AS ({history_sql(where=f"WHERE ts >= TIMESTAMP '{EVENT_OVERLAP}'")})
        SELECT e.event_id, e.user_id, e.ts, h.cond_key, h.start_date, h.end_date
        FROM events e LEFT JOIN h
          ON h.user_id = e.user_id
         AND h.start_date <= CAST(CAST(e.ts AS DATE) AS VARCHAR)
         AND (h.end_date = '' OR CAST(CAST(e.ts AS DATE) AS VARCHAR) < h.end_date)
    """,
    "merge_insert_only": f"""
        {bridge_sql(f"WHERE l_shipdate < TIMESTAMP '{SHIP_SPLIT}'")}
        UNION
        {bridge_sql(f"WHERE l_shipdate >= TIMESTAMP '{SHIP_OVERLAP}'")}
    """,
    "merge_upsert_all": f"""
        WITH t AS ({one_per_user_day(f"WHERE ts < TIMESTAMP '{EVENT_SPLIT}'", 'arg_max')}),
             s AS ({one_per_user_day(f"WHERE ts >= TIMESTAMP '{EVENT_OVERLAP}'", 'arg_min')})
        SELECT * FROM t WHERE (user_id, day) NOT IN (SELECT user_id, day FROM s)
        UNION ALL SELECT * FROM s
    """,
    "merge_conditional": f"""
        WITH t AS (SELECT user_id, hour(ts) AS h, max(ts) AS mark_ts FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT}' GROUP BY ALL),
             s AS (SELECT user_id, hour(ts) AS h, max(ts) AS mark_ts FROM events WHERE event_type = 'purchase' GROUP BY ALL)
        SELECT coalesce(t.user_id, s.user_id) AS user_id, CAST(coalesce(t.h, s.h) AS INTEGER) AS hour,
               CASE WHEN t.user_id IS NULL THEN s.mark_ts
                    WHEN s.user_id IS NOT NULL AND s.mark_ts > t.mark_ts THEN s.mark_ts
                    ELSE t.mark_ts END AS mark_ts
        FROM t FULL OUTER JOIN s ON t.user_id = s.user_id AND t.h = s.h
    """,
    "merge_partial_update": f"""
        WITH t AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
                   WHERE o_orderdate < TIMESTAMP '{ORDER_SPLIT}'),
             tot AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS new_total
                     FROM lineitem GROUP BY l_orderkey),
             s AS (SELECT o.o_orderkey, o.o_orderstatus, 'X-REVISED' AS o_orderpriority, tot.new_total AS o_totalprice
                   FROM orders o LEFT JOIN tot ON o.o_orderkey = tot.l_orderkey
                   WHERE o.o_orderdate >= TIMESTAMP '{ORDER_OVERLAP}')
        SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
               CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
               CASE WHEN t.o_orderkey IS NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
               CASE WHEN t.o_orderkey IS NULL OR s.o_orderkey IS NOT NULL THEN s.o_totalprice
                    ELSE t.o_totalprice END AS o_totalprice
        FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
    """,
    "report_counts_by_grain": grains_select("year quarter month week day dayofweek", "count(*) AS n_orders", "o_orderdate", "orders"),
    "report_event_counts_by_grain": grains_select("hour day week dayofweek", "count(*) AS n_events", "ts", "events"),
    "report_sum_by_grain": grains_select("year quarter month week day dayofweek", "sum(l_quantity) AS sum_quantity", "l_shipdate", "lineitem"),
    "report_member_distribution": """
        WITH pairs AS (
            SELECT DISTINCT p.p_brand, o.o_orderkey
            FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
            JOIN part p ON p.p_partkey = l.l_partkey
            WHERE p.p_type = 'ECONOMY'),
        c AS (SELECT p_brand, count(*) AS n_orders FROM pairs GROUP BY p_brand)
        SELECT p_brand, n_orders, n_orders / sum(n_orders) OVER () AS share FROM c
    """,
    "report_top_category": """
        SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority
        ORDER BY n DESC, o_orderpriority ASC LIMIT 1
    """,
    "report_by_condition": """
        SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus
    """,
    "report_value_distribution": f"""
        WITH c AS (
            SELECT CASE WHEN o_totalprice <= 100000 THEN '{PRICE_BUCKETS[0]}'
                        WHEN o_totalprice <= 250000 THEN '{PRICE_BUCKETS[1]}'
                        ELSE '{PRICE_BUCKETS[2]}' END AS price_bucket, count(*) AS n_orders
            FROM orders GROUP BY 1)
        SELECT price_bucket, n_orders, n_orders / sum(n_orders) OVER () AS share FROM c
    """,
}
