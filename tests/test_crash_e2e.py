"""Crash feeds end to end: land -> ingest (file stream) -> build -> publish, twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.operators.fact import orphan_keys
from starforge.plans.crash import build_and_publish, crash_reports, crash_star, ingest_all
from starforge.plans.star import publish_rules
from starforge.session import scratch_path
from starforge.sources.catalog import ddl_script, register_tables
from starforge.sources.store import TableStore
from starforge.sources.watermark import read_mark
from tests import fixtures as fx

FEEDS = {"crashes": (fx.CRASHES_1, fx.CRASHES_2), "people": (fx.PEOPLE_1, fx.PEOPLE_2), "vehicles": (fx.VEHICLES_1, fx.VEHICLES_2)}


@pytest.fixture(scope="module")
def env(spark):
    root = scratch_path(spark, "e2e")
    return {
        "landing": f"{root}/landing",
        "raw": TableStore(spark, f"{root}/raw"),
        "served": TableStore(spark, f"{root}/served"),
        "ckpt": f"{root}/streams",
    }


def land_and_ingest(spark, env, batch):
    for name, batches in FEEDS.items():
        fx.write_json(spark, batches[batch], f"{env['landing']}/{name}/batch-{batch}", None)
    ingest_all(spark, env["landing"], env["raw"], checkpoint_root=env["ckpt"])


def snapshot(store, names):
    return {n: sorted(map(tuple, store.read(n).collect()), key=repr) for n in names}


def test_batch_one(spark, env):
    land_and_ingest(spark, env, 0)
    raw = env["raw"]
    crashes = raw.read("crashes")
    assert crashes.count() == 8
    c6 = crashes.where("crash_record_id = 'c6'").first()
    assert c6.year is None and c6.crash_date == "N/A"
    c1 = crashes.where("crash_record_id = 'c1'").first()
    assert (c1.year, c1.month, c1.day) == (2024, 1, 10) and c1.weather_condition == "N/A"
    vehicles = raw.read("vehicles")
    assert vehicles.where("unit_type = 'PEDESTRIAN'").count() == 0
    assert vehicles.where("unit_type = 'N/A'").count() == 1  # null unit type kept
    assert read_mark(spark, raw, "Crashes") == dt.datetime(2024, 1, 14, 6, 0)

    names = build_and_publish(spark, raw, env["served"], dt.date(2024, 1, 14))
    served = env["served"]
    assert len(names) == 18 and names[-1] == "fact_crash"
    fact = served.read("fact_crash")
    assert fact.count() == 7  # every crash of the window, c6 has no date
    assert fact.select("person_group_key").distinct().count() == 7
    star = crash_star()
    for d in star.value_dims:
        if d.in_fact:
            assert orphan_keys(fact, d.key, served.read(d.name)).count() == 0, d.name
    assert orphan_keys(fact, "date_id", served.read("dim_date")).count() == 0
    assert orphan_keys(fact, "time_id", served.read("dim_time")).count() == 0
    assert served.read("dim_time").count() == 86400
    assert dict(fact.dtypes)["injuries_fatal"] == "int"
    assert fact.where("person_group_key = 'c7'").first().injuries_fatal is None  # 'N/A'

    vehicles_dim = {r.vehicle_id: r for r in served.read("dim_vehicle").collect()}
    assert set(vehicles_dim) == {"v1", "v4"} and vehicles_dim["v1"].make == "TOYOTA"
    assert {r.person_id: r.age for r in served.read("dim_person").collect()}["p5"] == "31"
    assert served.read("bridge_vehicle_group").count() == 3

    road = served.read("road_cond_mini_dim").join(served.read("dim_road_cond"), "road_cond_key")
    main = road.join(served.read("dim_location").where("street_name = 'MAIN ST'"), "location_id")
    got = sorted((r.roadway_surface_cond, r.start_date, r.end_date) for r in main.collect())
    assert got == [
        ("DRY", "2024-01-10", "2024-01-10"),
        ("DRY", "2024-01-10", "2024-01-11"),
        ("DRY", "2024-01-12", ""),
        ("WET", "2024-01-11", "2024-01-12"),
    ]

    # same batch again: nothing changes, and unchanged entity dimensions are not rewritten
    before = snapshot(served, names)
    versions = {n: served.current_version(n) for n in ("dim_vehicle", "dim_person")}
    build_and_publish(spark, raw, served, dt.date(2024, 1, 14))
    assert snapshot(served, names) == before
    assert {n: served.current_version(n) for n in versions} == versions


def test_batch_two(spark, env):
    land_and_ingest(spark, env, 1)
    raw, served = env["raw"], env["served"]
    crashes = raw.read("crashes")
    assert crashes.count() == 11
    assert crashes.where("crash_record_id = 'c7'").first().injuries_fatal == "1"
    assert read_mark(spark, raw, "Crashes") == dt.datetime(2024, 1, 16, 12, 0)

    names = build_and_publish(spark, raw, served, dt.date(2024, 1, 16))
    fact = served.read("fact_crash")
    assert fact.count() == 9  # c9, c10 added; c7 corrected
    assert fact.where("person_group_key = 'c7'").first().injuries_fatal == 1
    road = served.read("road_cond_mini_dim").join(served.read("dim_road_cond"), "road_cond_key")
    main = road.join(served.read("dim_location").where("street_name = 'MAIN ST'"), "location_id")
    got = sorted((r.roadway_surface_cond, r.start_date, r.end_date) for r in main.collect())
    assert ("DRY", "2024-01-12", "2024-01-16") in got and ("SNOW", "2024-01-16", "") in got
    assert main.where("end_date = ''").count() == 1
    pine = road.join(served.read("dim_location").where("street_name = 'PINE ST'"), "location_id")
    # c10 is late: it starts on the day of the latest known start and stands beside it
    assert pine.count() == 2 and pine.where("end_date = ''").count() == 1

    before = snapshot(served, names)
    build_and_publish(spark, raw, served, dt.date(2024, 1, 16))
    assert snapshot(served, names) == before

    # SQL catalog over the served tables
    register_tables(spark, served, "crash_dw", names)
    assert spark.sql("SELECT count(*) FROM crash_dw.fact_crash").first()[0] == 9
    assert "CREATE TABLE IF NOT EXISTS `crash_dw`.`dim_junk`" in ddl_script(served, "crash_dw", ["dim_junk"])

    reports = crash_reports({n: served.read(n) for n in names})
    by_grain = reports["crashes_by_grain"]
    assert by_grain.where("grain = 'year'").first().n_crashes == 9
    assert by_grain.where("grain = 'hour'").agg(F.sum("n_crashes")).first()[0] == 9
    drivers = {r.sex: r.n_drivers for r in reports["drivers_by_sex"].collect()}
    # distinct (crash, driver) pairs: M = p1@c1, p5@c4, p5@c7; F = p4@c3, p6@c9
    assert drivers == {"M": 3, "F": 2}
    assert reports["top_collision_type"].first().collision_type == "REAR END"
    assert abs(sum(r.share for r in reports["damage_distribution"].collect()) - 1.0) < 1e-9
    assert reports["top_primary_cause"].count() == 1
    assert reports["crashes_by_weather"].agg(F.sum("n_crashes")).first()[0] == 9
    assert reports["fatal_by_grain"].where("grain = 'year'").first().fatal_injuries == 1  # c7 as corrected
    # road condition on each crash's day: main street was DRY on 01-10 (c1, c2),
    # WET on 01-11 (c3), DRY on 01-12 (c4), SNOW on 01-16 (c9)
    road = {r.roadway_surface_cond: r.n_crashes for r in reports["crashes_by_road_condition"].collect()}
    assert sum(road.values()) == 9
    assert road["WET"] == 1 and road["SNOW"] == 1


def test_publish_rules_cover_all_tables():
    rules = publish_rules(crash_star())
    assert len(rules) == 18
    assert rules["dim_vehicle"].mode == "upsert" and rules["road_cond_mini_dim"].mode == "observed"
    assert rules["fact_crash"].mode == "upsert" and rules["fact_crash"].keys == ("person_group_key",)
    assert len(rules["fact_crash"].else_keys) == 11


def test_job_entry(spark, capsys):
    from starforge.plans.crash import main

    root = scratch_path(spark, "job")
    for name, batches in FEEDS.items():
        fx.write_json(spark, batches[0], f"{root}/landing/{name}/batch-0", None)
    main(["ingest", "--landing", f"{root}/landing", "--raw", f"{root}/raw"])
    main(["build", "--raw", f"{root}/raw", "--served", f"{root}/served", "--as-of", "2024-01-14"])
    main(["ddl", "--served", f"{root}/served", "--database", "crash_job_db"])
    out = capsys.readouterr().out
    assert "published:" in out and "CREATE TABLE IF NOT EXISTS `crash_job_db`.`fact_crash`" in out
    assert spark.sql("SELECT count(*) FROM crash_job_db.fact_crash").first()[0] == 7
