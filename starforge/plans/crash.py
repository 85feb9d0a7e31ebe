"""The crash warehouse: three feeds -> 18-table star schema, as configuration.

Tables: location, weather, junk, cause, crash type, report type, collision,
road condition and control-device condition dimensions; date and time of day;
vehicle and person entity dimensions with their bridges; road-condition and
device-condition history mini-dimensions; the crash fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import week_year, window_extract
from ..functions.clean import RAW_NULL
from ..operators import reports
from ..operators.dims import date_key
from ..operators.history import point_in_time
from ..session import stage, staging
from ..sources import keyindex
from ..sources.feeds import PARTITION_COLS, feed_specs, partition_filter, without_key
from ..sources.store import TableStore
from .kept import KeptReport, count_rows, read_kept, refresh, sum_of
from .star import MONTH_KEY, Bridge, EntityDim, History, Star, ValueDim, build_star, publish_rules, publish_star

# Fixed column lists of the crash star (dimension attributes in table order).
LOCATION_ATTRS = (
    "street_no", "street_direction", "street_name", "alignment",
    "posted_speed_limit", "trafficway_type", "longitude", "latitude",
)
JUNK_FLAGS = (
    "intersection_related_i", "hit_and_run_i", "photos_taken_i", "statements_taken_i",
    "dooring_i", "work_zone_i", "workers_present_i",
)
VEHICLE_COLS = (
    "vehicle_id", "num_passengers", "make", "model", "lic_plate_state", "vehicle_year",
    "vehicle_defect", "vehicle_type", "vehicle_use", "travel_direction", "maneuver", "towed_i",
    "fire_i", "occupant_cnt", "towed_by", "towed_to", "first_contact_point", "commercial_src",
    "carrier_name", "carrier_state", "carrier_city", "total_vehicle_length", "axle_cnt",
    "vehicle_config", "cargo_body_type", "load_type",
)
PERSON_COLS = (
    "person_id", "person_type", "seat_no", "city", "state", "zipcode", "sex", "age",
    "drivers_license_state", "drivers_license_class", "safety_equipment", "airbag_deployed",
    "ejection", "injury_classification", "hospital", "driver_action", "driver_vision",
    "physical_condition", "pedpedal_action", "pedpedal_visibility", "pedpedal_location", "bac_result",
)
MEASURES = (
    "damage", "num_units", "injuries_total", "injuries_fatal", "injuries_incapacitating",
    "injuries_non_incapacitating", "injuries_reported_not_evident", "injuries_no_indication",
    "injuries_unknown",
)


def crash_star(bits: int = 512, compat: bool = False, typed_measures: bool = True) -> Star:
    """The crash star. ``typed_measures`` casts counts to int (``damage``
    stays a category string); ``False`` keeps every measure as landed."""
    return Star(
        main="crashes",
        ts="crash_date",
        record_id="crash_record_id",
        fact_name="fact_crash",
        value_dims=(
            ValueDim("dim_location", "location_id", LOCATION_ATTRS, fill=None),
            ValueDim("dim_weather", "weather_id", ("weather_condition", "lighting_condition")),
            ValueDim("dim_junk", "junk_id", JUNK_FLAGS, key_last=True),
            ValueDim("dim_cause", "cause_id", ("prim_contributory_cause", "sec_contributory_cause")),
            ValueDim("dim_crash_type", "crash_type_id", ("crash_type",)),
            ValueDim("dim_report_type", "report_type_id", ("report_type",)),
            ValueDim("dim_collision", "collision_type_id", ("first_crash_type",), rename={"first_crash_type": "collision_type"}),
            ValueDim("dim_road_cond", "road_cond_key", ("roadway_surface_cond", "road_defect"), in_fact=False),
            ValueDim("dim_control_device_cond", "device_cond_key", ("traffic_control_device", "device_condition"), in_fact=False),
        ),
        entity_dims=(
            EntityDim("dim_vehicle", "vehicles", "vehicle_id", VEHICLE_COLS, latest_by="crash_date"),
            EntityDim("dim_person", "people", "person_id", PERSON_COLS, latest_by="crash_date"),
        ),
        bridges=(
            Bridge("bridge_vehicle_group", "vehicles", "crash_record_id", "vehicle_id", "vehicle_group_key", partition_ts="crash_date"),
            Bridge("bridge_person_group", "people", "crash_record_id", "person_id", "person_group_key", partition_ts="crash_date"),
        ),
        histories=(
            History("road_cond_mini_dim", "dim_location", "dim_road_cond", observed=True),
            History("control_device_cond_mini_dim", "dim_location", "dim_control_device_cond", observed=True),
        ),
        group_keys=("person_group_key", "vehicle_group_key"),
        measures={m: (None if m == "damage" or not typed_measures else "int") for m in MEASURES},
        bits=bits,
        compat=compat,
    )


def extract(raw: TableStore, as_of: dt.date, days_back: int = 7) -> dict[str, DataFrame]:
    """The rolling window of each raw table, staged once per run.

    The raw tables are partitioned by year, month and day, so only the
    window's days are read. Every table of the star reads the crash extract;
    staging it in the checkpoint folder computes the window once and cuts the
    lineage.
    """

    def window(name: str, drop=()) -> DataFrame:
        return window_extract(raw.read(name), "crash_date", as_of, days_back, drop=drop, day_parts=PARTITION_COLS)

    crashes = window("crashes", drop=("location",))
    people = window("people")
    vehicles = window("vehicles").where("vehicle_id <> 'N/A'")
    return {
        "crashes": stage(crashes, "extract-crashes"),
        "people": stage(people, "extract-people"),
        "vehicles": stage(vehicles, "extract-vehicles"),
    }


def moved_records(
    raw: TableStore, served: TableStore, frames: Mapping[str, DataFrame], as_of: dt.date, days_back: int, star: Star
) -> dict[str, DataFrame]:
    """Published records of the window's days that are dated on other days now.

    The window extract no longer holds them, so their facts, pairs and observations
    would stay where they were. They are the facts of the window's days (by date
    key, in the window's months) without a record in the extract; raw rows are found
    through the raw tables' key indexes, so only the days they lie on or have
    lain on are opened. A record whose date can't be read any more keeps its last fact.
    """
    if not served.exists(star.fact_name):
        return {}
    spark = raw.spark
    days = [as_of - dt.timedelta(days=i) for i in range(days_back + 1)]
    in_months = F.col(MONTH_KEY).isin(sorted({d.year * 100 + d.month for d in days}))
    dates = spark.createDataFrame([(d,) for d in days], "day date").select(date_key("day", star.bits, star.compat).alias("date_id"))
    facts = served.read(star.fact_name).where(in_months).join(dates, "date_id", "left_semi")
    known = facts.select(F.col(star.group_keys[0]).alias(star.record_id)).where(~without_key([star.record_id]))
    gone = stage(known.join(frames[star.main].select(star.record_id), star.record_id, "left_anti").distinct(), "moved-ids")
    if not gone.take(1):
        return {}
    specs = feed_specs()

    def now(name: str, ids: DataFrame, known: DataFrame, also: Sequence[tuple] = ()) -> DataFrame:
        keys, parts = list(specs[name].keys), list(specs[name].partition_by)
        keyindex.ensure(raw, name, keys, parts)
        vals = {v for v in [*keyindex.partitions_of(raw, name, known, keys, parts), *also] if None not in v}
        held = raw.read(name).where(partition_filter(parts, sorted(vals)))
        return held.join(ids, star.record_id, "left_semi").select(*frames[name].columns)

    out = {star.main: stage(now(star.main, gone, gone), f"moved-{star.main}")}
    found = out[star.main].select(star.record_id)
    new_days = [tuple(r) for r in out[star.main].select(*PARTITION_COLS).distinct().collect()]  # days, not rows
    for br in star.bridges:
        pairs = served.read(br.name).where(in_months).withColumnRenamed(br.group_key, br.group_col).join(found, br.group_col, "left_semi")
        out[br.source] = stage(now(br.source, found, pairs, new_days).where(F.col(br.member_col) != RAW_NULL), f"moved-{br.source}")
    return out


def transform(
    spark: SparkSession, frames: dict[str, DataFrame], star: Star | None = None, moved: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    return build_star(spark, star or crash_star(), frames, moved)


def build_and_publish(spark: SparkSession, raw: TableStore, served: TableStore, as_of: dt.date, days_back: int = 7, star: Star | None = None) -> list[str]:
    """One warehouse run: extract the window and what has left it, build the star, publish it.
    Staged intermediates are removed when the run ends."""
    star = star or crash_star()
    with staging(spark):
        frames = extract(raw, as_of, days_back)
        tables = transform(spark, frames, star, moved_records(raw, served, frames, as_of, days_back, star))
        return publish_star(served, tables, publish_rules(star), star.fact_name)


# ---------------------------------------------------------------- reports (Q1-Q7)

CRASH_GRAINS = {
    "hour": ("hour",),
    "day": ("year", "month", "day"),
    "month": ("year", "month"),
    "week": ("week_year", "week"),
    "year": ("year",),
    "dayofweek": ("dayofweek",),
}


def crash_reports(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The questions the star answers, over published (or freshly built) tables.

    ``t`` maps table names to DataFrames. Every report is a grouped aggregate
    on the fact joined to small dimensions (the planner broadcasts them when
    their size allows, AQE at runtime otherwise).
    """
    f = t["fact_crash"]
    cal = (
        f.join(t["dim_date"], "date_id")
        .join(t["dim_time"].select("time_id", "hour"), "time_id")
        .withColumn("week_year", week_year())
    )
    fatal = F.col("injuries_fatal").try_cast("int") if dict(f.dtypes)["injuries_fatal"] == "string" else F.col("injuries_fatal")
    out = {
        "crashes_by_grain": reports.by_grains(cal, [F.count(F.lit(1)).alias("n_crashes")], CRASH_GRAINS),
        "fatal_by_grain": reports.by_grains(cal, [F.sum(fatal).alias("fatal_injuries")], CRASH_GRAINS),
    }
    drivers = (
        f.select("person_group_key")
        .join(t["bridge_person_group"], "person_group_key")
        .join(t["dim_person"].where(F.col("person_type") == "DRIVER").select("person_id", "sex"), "person_id")
        .select("person_group_key", "person_id", "sex")
        .distinct()
        .groupBy("sex")
        .agg(F.count(F.lit(1)).alias("n_drivers"))
    )
    out["drivers_by_sex"] = reports.share(drivers, "n_drivers")
    causes = f.groupBy("cause_id").agg(F.count(F.lit(1)).alias("n")).join(t["dim_cause"], "cause_id")
    out["top_primary_cause"] = reports.top_k(
        causes.groupBy("prim_contributory_cause").agg(F.sum("n").alias("n")), "prim_contributory_cause", 1
    )
    out["crashes_by_weather"] = (
        f.groupBy("weather_id").agg(F.count(F.lit(1)).alias("n_crashes")).join(t["dim_weather"], "weather_id")
        .select("weather_condition", "lighting_condition", "n_crashes")
    )
    out["damage_distribution"] = reports.share(f.groupBy("damage").agg(F.count(F.lit(1)).alias("n_crashes")), "n_crashes")
    coll = f.groupBy("collision_type_id").agg(F.count(F.lit(1)).alias("n")).join(t["dim_collision"], "collision_type_id")
    out["top_collision_type"] = reports.top_k(coll.select("collision_type", "n"), "collision_type", 1)
    # Road condition at each crash's place as it stood on the crash's date
    # (the purpose of the history mini-dimension): a point-in-time lookup.
    dated = f.join(t["dim_date"].select("date_id", "year", "month", "day"), "date_id").select(
        "person_group_key", "location_id", F.make_date("year", "month", "day").alias("crash_day")
    )
    road_hist = t["road_cond_mini_dim"].select("location_id", "road_cond_key", "start_date", "end_date")
    at_time = point_in_time(dated, "location_id", "crash_day", "person_group_key", road_hist, "location_id", "road_cond_key")
    out["crashes_by_road_condition"] = (
        at_time.groupBy("road_cond_key").agg(F.count(F.lit(1)).alias("n_crashes"))
        .join(t["dim_road_cond"], "road_cond_key", "left")
        .select("roadway_surface_cond", "road_defect", "n_crashes")
    )
    return out


# The same reports from kept partial aggregates (``plans.kept``), by month. The road
# condition at crash time is not among them: late observations change it in any month.

def _calendar_rows(t: Mapping[str, DataFrame]) -> DataFrame:
    fatal = F.col("injuries_fatal").try_cast("int")
    return t["fact_crash"].join(t["dim_time"].select("time_id", "hour"), "time_id").withColumn("fatal", fatal)


def _category_rows(t: Mapping[str, DataFrame]) -> DataFrame:
    """A row per crash and question, so that one pass serves all of them."""
    cols = ("cause_id", "weather_id", "collision_type_id", "damage")
    asked = F.explode(F.array(*[F.struct(F.lit(c).alias("asked"), F.col(c).cast("string").alias("value")) for c in cols]))
    return t["fact_crash"].select(MONTH_KEY, asked.alias("a")).select(MONTH_KEY, "a.asked", "a.value")


def _driver_rows(t: Mapping[str, DataFrame]) -> DataFrame:
    drivers = t["dim_person"].where(F.col("person_type") == "DRIVER").select("person_id", "sex")
    pairs = t["fact_crash"].select(MONTH_KEY, "person_group_key").join(t["bridge_person_group"], [MONTH_KEY, "person_group_key"])
    return pairs.join(drivers, "person_id").select(MONTH_KEY, "person_group_key", "person_id", "sex").distinct()


KEPT_CALENDAR = KeptReport(
    "kept_calendar", ("fact_crash",), MONTH_KEY, ("date_id", "hour"),
    {"n_crashes": count_rows(), "fatal_injuries": sum_of("fatal")}, _calendar_rows, whole=("dim_time",),
)
KEPT_CATEGORIES = KeptReport("kept_categories", ("fact_crash",), MONTH_KEY, ("asked", "value"), {"n": count_rows()}, _category_rows)
KEPT_DRIVERS = KeptReport(
    "kept_drivers", ("fact_crash", "bridge_person_group"), MONTH_KEY, ("sex",), {"n_drivers": count_rows()}, _driver_rows, whole=("dim_person",)
)
CRASH_KEPT = (KEPT_CALENDAR, KEPT_CATEGORIES, KEPT_DRIVERS)


def crash_reports_kept(served: TableStore) -> dict[str, DataFrame]:
    """``crash_reports`` (but the road condition at crash time) from partial
    aggregates that are brought up to date first: the fact's rows are read only
    in months that were rewritten since the last call."""
    for report in CRASH_KEPT:
        refresh(served, report)
    cal = read_kept(served, KEPT_CALENDAR).join(served.read("dim_date"), "date_id").withColumn("week_year", week_year())
    counts = read_kept(served, KEPT_CATEGORIES)

    def asked(col: str, n: str = "n") -> DataFrame:
        return counts.where(F.col("asked") == col).select(F.col("value").alias(col), F.col("n").alias(n))

    causes = asked("cause_id").join(served.read("dim_cause"), "cause_id").groupBy("prim_contributory_cause").agg(F.sum("n").alias("n"))
    weather = asked("weather_id", "n_crashes").join(served.read("dim_weather"), "weather_id")
    collisions = asked("collision_type_id").join(served.read("dim_collision"), "collision_type_id").select("collision_type", "n")
    return {
        "crashes_by_grain": reports.by_grains(cal, [F.sum("n_crashes").alias("n_crashes")], CRASH_GRAINS),
        "fatal_by_grain": reports.by_grains(cal, [F.sum("fatal_injuries").alias("fatal_injuries")], CRASH_GRAINS),
        "drivers_by_sex": reports.share(read_kept(served, KEPT_DRIVERS), "n_drivers"),
        "top_primary_cause": reports.top_k(causes, "prim_contributory_cause", 1),
        "crashes_by_weather": weather.select("weather_condition", "lighting_condition", "n_crashes"),
        "damage_distribution": reports.share(asked("damage", "n_crashes"), "n_crashes"),
        "top_collision_type": reports.top_k(collisions, "collision_type", 1),
    }


def ingest_all(
    spark: SparkSession,
    landing_root: str,
    raw: TableStore,
    checkpoint_root: str | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Ingest every landed file of the three feeds (``<landing_root>/<feed>/...``).

    One availableNow file stream per feed; each micro-batch upserts the raw
    table and then advances the feed's mark. The streams' checkpoints lie
    beside the raw tables (or below ``checkpoint_root``), so a daily
    application reads only what was landed since the last one.
    """
    from ..streaming.ingest import STREAMS, ingest_stream

    ckpt = checkpoint_root or f"{raw.root}/{STREAMS}"
    for name, spec in feed_specs().items():
        ingest_stream(
            spark,
            spec,
            f"{landing_root}/{name}/*",
            raw,
            max_files_per_trigger=max_files_per_trigger,
            checkpoint=f"{ckpt}/{name}",
        )


# ---------------------------------------------------------------- job entry

def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files starforge.zip crash_job.py <ingest|build|ddl> ...``

    * ``ingest --landing L --raw R [--stream-checkpoint C]``: the three feeds
      into the raw tables (run daily);
    * ``build --raw R --served S --as-of YYYY-MM-DD [--days-back 7]``: extract
      the window, build and publish the star (run weekly);
    * ``ddl --served S --database D``: register the published tables in the
      SQL catalog and print the DDL.
    """
    import argparse

    from ..session import build_session
    from ..sources.catalog import ddl_script, register_tables

    ap = argparse.ArgumentParser(prog="crash")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--raw", required=True)
    ing.add_argument("--stream-checkpoint", default=None)
    ing.add_argument("--max-files-per-trigger", type=int, default=None)
    bld = sub.add_parser("build")
    bld.add_argument("--raw", required=True)
    bld.add_argument("--served", required=True)
    bld.add_argument("--as-of", required=True)
    bld.add_argument("--days-back", type=int, default=7)
    ddl = sub.add_parser("ddl")
    ddl.add_argument("--served", required=True)
    ddl.add_argument("--database", default="crash_dw")
    args = ap.parse_args(argv)

    spark = build_session(app=f"crash-{args.cmd}")
    if args.cmd == "ingest":
        ingest_all(spark, args.landing, TableStore(spark, args.raw), args.stream_checkpoint, max_files_per_trigger=args.max_files_per_trigger)
    elif args.cmd == "build":
        names = build_and_publish(
            spark, TableStore(spark, args.raw), TableStore(spark, args.served), dt.date.fromisoformat(args.as_of), args.days_back
        )
        print("published:", ", ".join(names))
    else:
        served = TableStore(spark, args.served)
        names = [n for n in publish_rules(crash_star()) if served.exists(n)]
        register_tables(spark, served, args.database, names)
        print(ddl_script(served, args.database, names))


if __name__ == "__main__":
    main()
