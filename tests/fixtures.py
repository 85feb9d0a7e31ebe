"""Hand-made crash feed records (all strings, as landed)."""

from __future__ import annotations

from starforge.sources.schemas import CRASH_COLUMNS, PEOPLE_COLUMNS, VEHICLE_COLUMNS


def crash(rid, date, street="MAIN ST", no="100", road="DRY", defect="NO DEFECTS", device="SIGNAL", dev_cond="FUNCTIONING", **kw):
    r = {c: None for c in CRASH_COLUMNS}
    r.update(
        crash_record_id=rid,
        crash_date=date,
        street_no=no,
        street_direction="N",
        street_name=street,
        alignment="STRAIGHT AND LEVEL",
        posted_speed_limit="30",
        trafficway_type="DIVIDED",
        longitude="-87.6",
        latitude="41.8",
        weather_condition="CLEAR",
        lighting_condition="DAYLIGHT",
        intersection_related_i="Y",
        hit_and_run_i="N",
        photos_taken_i="N",
        statements_taken_i="N",
        dooring_i="N",
        work_zone_i="N",
        workers_present_i="N",
        prim_contributory_cause="UNABLE TO DETERMINE",
        sec_contributory_cause="NOT APPLICABLE",
        crash_type="NO INJURY / DRIVE AWAY",
        report_type="ON SCENE",
        first_crash_type="REAR END",
        roadway_surface_cond=road,
        road_defect=defect,
        traffic_control_device=device,
        device_condition=dev_cond,
        damage="OVER $1,500",
        num_units="2",
        injuries_total="0",
        injuries_fatal="0",
        injuries_incapacitating="0",
        injuries_non_incapacitating="0",
        injuries_reported_not_evident="0",
        injuries_no_indication="2",
        injuries_unknown="0",
    )
    r.update(kw)
    return r


# batch one: 8 crashes (2024-01-10 .. 2024-01-14)
CRASHES_1 = [
    crash("c1", "2024-01-10T08:00:00.000", weather_condition=None),  # null in a value dimension
    crash("c2", "2024-01-10T17:30:00.000", hit_and_run_i=None),  # same place, same day
    crash("c3", "2024-01-11T09:00:00.000", road="WET"),  # same place, changed road condition
    crash("c4", "2024-01-12T10:15:00.000"),  # same place, later day, same condition
    crash("c5", "2024-01-12T11:00:00.000", street="OAK AVE", prim_contributory_cause=None, device="NO CONTROLS"),
    crash("c6", "N/A", street="ELM ST"),  # dirty date: outside every window
    crash("c7", "2024-01-13T23:59:59.000", street="OAK AVE", injuries_fatal="N/A", first_crash_type=None),
    crash("c8", "2024-01-14T06:00:00.000", street="PINE ST", crash_type=None, report_type=None, extra_col="x"),
]

# batch two: unchanged, changed, new, late (last day of batch one), older than batch one
CRASHES_2 = [
    crash("c4", "2024-01-12T10:15:00.000"),  # unchanged
    crash("c7", "2024-01-13T23:59:59.000", street="OAK AVE", injuries_fatal="1", first_crash_type=None),  # changed
    crash("c9", "2024-01-16T12:00:00.000", road="SNOW"),  # new, main street
    crash("c10", "2024-01-14T20:00:00.000", street="PINE ST", road="ICE"),  # late: same day as c8
    crash("c11", "2024-01-05T07:00:00.000", street="BIRCH RD"),  # older than batch one
]


def person(rid, date, pid, ptype="DRIVER", sex="M", **kw):
    r = {c: None for c in PEOPLE_COLUMNS}
    r.update(crash_record_id=rid, crash_date=date, person_id=pid, person_type=ptype, sex=sex, age="30", city="CHICAGO", state="IL")
    r.update(kw)
    return r


PEOPLE_1 = [
    person("c1", "2024-01-10T08:00:00.000", "p1"),
    person("c1", "2024-01-10T08:00:00.000", "p2", ptype="PASSENGER", sex="F"),
    person("c1", "2024-01-10T08:00:00.000", "p3", ptype="PASSENGER", sex=None),  # null sex
    person("c3", "2024-01-11T09:00:00.000", "p4", sex="F"),
    person("c4", "2024-01-12T10:15:00.000", "p5"),
    person("c7", "2024-01-13T23:59:59.000", "p5", age="31"),  # same person again, other attributes
]
PEOPLE_2 = [person("c9", "2024-01-16T12:00:00.000", "p6", sex="F")]


def vehicle(rid, date, vid, unit_type="DRIVER", **kw):
    r = {c: None for c in VEHICLE_COLUMNS}
    r.update(crash_record_id=rid, crash_date=date, vehicle_id=vid, unit_type=unit_type, make="FORD", model="F150", vehicle_year="2019")
    r.update(kw)
    return r


VEHICLES_1 = [
    vehicle("c1", "2024-01-10T08:00:00.000", "v1"),
    vehicle("c1", "2024-01-10T08:00:00.000", None),  # null vehicle id
    vehicle("c2", "2024-01-10T17:30:00.000", "N/A"),  # 'N/A' vehicle id
    vehicle("c3", "2024-01-11T09:00:00.000", "v3", unit_type="PEDESTRIAN"),
    vehicle("c3", "2024-01-11T09:00:00.000", "v4", unit_type=None),
    vehicle("c4", "2024-01-12T10:15:00.000", "v1", make="TOYOTA"),  # one vehicle in two crashes
]
VEHICLES_2 = [vehicle("c9", "2024-01-16T12:00:00.000", "v9")]


def write_json(spark, records, path, columns):
    """Land records as JSON lines (extra keys kept, like a raw feed page)."""
    import json

    lines = [json.dumps(r) for r in records]
    spark.sparkContext.parallelize(lines, 1).saveAsTextFile(path)
