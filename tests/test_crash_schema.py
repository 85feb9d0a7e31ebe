"""The crash star's tables carry the served columns (names, in table order)."""

import datetime as dt

from starforge.functions.calendar import window_extract
from starforge.plans.crash import LOCATION_ATTRS, JUNK_FLAGS, MEASURES, PERSON_COLS, VEHICLE_COLS, transform
from starforge.sources.feeds import feed_specs, prepare
from tests import fixtures as fx

# Served column lists of the crash warehouse (fixed values).
EXPECTED = {
    "dim_time": ["time_id", "hour", "minute", "second"],
    "dim_date": ["date_id", "day", "dayofweek", "month", "week", "year", "quarter"],
    "dim_location": ["location_id", *LOCATION_ATTRS],
    "road_cond_mini_dim": ["location_id", "road_cond_key", "start_date", "end_date", "observed_at", "crash_record_id"],
    "control_device_cond_mini_dim": ["location_id", "device_cond_key", "start_date", "end_date", "observed_at", "crash_record_id"],
    "dim_road_cond": ["road_cond_key", "roadway_surface_cond", "road_defect"],
    "dim_control_device_cond": ["device_cond_key", "traffic_control_device", "device_condition"],
    "bridge_vehicle_group": ["vehicle_group_key", "vehicle_id", "month_key"],
    "dim_vehicle": list(VEHICLE_COLS),
    "dim_collision": ["collision_type_id", "collision_type"],
    "dim_report_type": ["report_type_id", "report_type"],
    "bridge_person_group": ["person_group_key", "person_id", "month_key"],
    "dim_person": list(PERSON_COLS),
    "dim_weather": ["weather_id", "weather_condition", "lighting_condition"],
    "dim_junk": [*JUNK_FLAGS, "junk_id"],
    "dim_cause": ["cause_id", "prim_contributory_cause", "sec_contributory_cause"],
    "dim_crash_type": ["crash_type_id", "crash_type"],
    "fact_crash": [
        "location_id", "time_id", "date_id", "person_group_key", "vehicle_group_key", "weather_id", "junk_id",
        "cause_id", "collision_type_id", "report_type_id", "crash_type_id", *MEASURES, "month_key",
    ],
}


def test_crash_star_columns(spark):
    specs = feed_specs()
    frames = {}
    for name, recs in (("crashes", fx.CRASHES_1), ("people", fx.PEOPLE_1), ("vehicles", fx.VEHICLES_1)):
        df = prepare(spark.createDataFrame([{c: r.get(c) for c in specs[name].schema.names} for r in recs], specs[name].schema), specs[name])
        frames[name] = window_extract(df, "crash_date", dt.date(2024, 1, 14), 7, drop=("location",) if name == "crashes" else ())
    tables = transform(spark, frames)
    assert set(tables) == set(EXPECTED)
    for name, cols in EXPECTED.items():
        got = tables[name].columns
        assert sorted(got) == sorted(cols), name
        if name != "fact_crash":
            assert got == cols, name
