"""Feed schemas of the crash configuration.

Every feed column is a nullable string (as landed); dates and measures are
parsed on the way in. Columns are listed in feed order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed column lists of the three feeds.
CRASH_COLUMNS = (
    "crash_record_id", "crash_date", "location",
    "street_no", "street_direction", "street_name", "alignment", "posted_speed_limit",
    "trafficway_type", "longitude", "latitude",
    "weather_condition", "lighting_condition",
    "intersection_related_i", "hit_and_run_i", "photos_taken_i", "statements_taken_i",
    "dooring_i", "work_zone_i", "workers_present_i",
    "prim_contributory_cause", "sec_contributory_cause",
    "crash_type", "report_type", "first_crash_type",
    "roadway_surface_cond", "road_defect", "traffic_control_device", "device_condition",
    "damage", "num_units", "injuries_total", "injuries_fatal", "injuries_incapacitating",
    "injuries_non_incapacitating", "injuries_reported_not_evident", "injuries_no_indication",
    "injuries_unknown",
)

PEOPLE_COLUMNS = (
    "crash_record_id", "crash_date", "person_id", "person_type", "seat_no", "city", "state",
    "zipcode", "sex", "age", "drivers_license_state", "drivers_license_class", "safety_equipment",
    "airbag_deployed", "ejection", "injury_classification", "hospital", "driver_action",
    "driver_vision", "physical_condition", "pedpedal_action", "pedpedal_visibility",
    "pedpedal_location", "bac_result",
)

VEHICLE_COLUMNS = (
    "crash_record_id", "crash_date", "unit_type", "vehicle_id", "num_passengers", "make", "model",
    "lic_plate_state", "vehicle_year", "vehicle_defect", "vehicle_type", "vehicle_use",
    "travel_direction", "maneuver", "towed_i", "fire_i", "occupant_cnt", "towed_by", "towed_to",
    "first_contact_point", "commercial_src", "carrier_name", "carrier_state", "carrier_city",
    "total_vehicle_length", "axle_cnt", "vehicle_config", "cargo_body_type", "load_type",
)


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


CRASH_SCHEMA = string_schema(CRASH_COLUMNS)
PEOPLE_SCHEMA = string_schema(PEOPLE_COLUMNS)
VEHICLE_SCHEMA = string_schema(VEHICLE_COLUMNS)
