"""Records corrected to a day outside the window: fact, bridges and histories follow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starforge.plans.crash import build_and_publish, crash_star, extract, ingest_all, moved_records
from starforge.plans.observed import read_observed
from starforge.session import scratch_path
from starforge.sources.store import TableStore
from tests import fixtures as fx
from tests.conftest import rows
from tests.test_keyindex import mend, spoil

AS_OF = dt.date(2024, 1, 16)
# c4 and its members move to another month, c2 (without members) within the month, c9 keeps its
# day but gets another road condition, c7 loses its date.
CORRECTED = {
    "crashes": [
        fx.crash("c4", "2023-12-20T10:15:00.000", road="WET"),
        fx.crash("c2", "2024-01-02T17:30:00.000", hit_and_run_i=None),
        fx.crash("c9", "2024-01-16T12:00:00.000", road="DRY"),
        fx.crash("c7", "not known", street="OAK AVE"),
    ],
    # p9 was not known before
    "people": [fx.person("c4", "2023-12-20T10:15:00.000", "p5", age="20"), fx.person("c4", "2023-12-20T10:15:00.000", "p9", age="50")],
    "vehicles": [fx.vehicle("c4", "2023-12-20T10:15:00.000", "v1", make="TOYOTA"), fx.vehicle("c4", "2023-12-20T10:15:00.000", None)],
}
TABLES = {
    "fact_crash": "person_group_key",
    "bridge_person_group": "person_group_key",
    "bridge_vehicle_group": "vehicle_group_key",
    "road_cond_mini_dim": "crash_record_id",
    "control_device_cond_mini_dim": "crash_record_id",
}


@pytest.fixture(scope="module")
def env(spark):
    root = scratch_path(spark, "moved")
    raw, served = TableStore(spark, f"{root}/raw"), TableStore(spark, f"{root}/served")
    batches = [
        {"crashes": fx.CRASHES_1 + fx.CRASHES_2, "people": fx.PEOPLE_1 + fx.PEOPLE_2, "vehicles": fx.VEHICLES_1 + fx.VEHICLES_2},
        CORRECTED,
    ]
    for i, feeds in enumerate(batches):
        for name, records in feeds.items():
            fx.write_json(spark, records, f"{root}/landing/{name}/batch-{i}", None)
        ingest_all(spark, f"{root}/landing", raw, checkpoint_root=f"{root}/streams")
        if i == 0:
            build_and_publish(spark, raw, served, AS_OF)
    return raw, served, f"{root}/fresh"


def content(store, name):
    t = read_observed(store, name) if name.endswith("mini_dim") else store.read(name)
    cols = sorted(set(t.columns) - {"segment", "row_state"} - ({"month_key"} if name.endswith("mini_dim") else set()))
    # c11 lies before the first window; c7 keeps what it had, and c5 at its place ends there
    return rows(t.where(~F.col(TABLES[name]).isin("c11", "c7", "c5")).select(*cols))


def test_moved_records_are_found_without_opening_other_days(spark, env):
    raw, served, _ = env
    frames = extract(raw, AS_OF)
    # their days now and before; 16 January too, of which the schema is read
    spoiled = spoil(raw.read("crashes"), "month=12/", *[f"/month=1/day={d}/" for d in (2, 10, 12, 13, 16)])
    if not any("day=11" in p for p, _ in spoiled):
        mend(spoiled)
        pytest.fail("nothing was made unreadable")
    try:
        moved = moved_records(raw, served, frames, AS_OF, 7, crash_star())
        ids = sorted(r[0] for r in moved["crashes"].select("crash_record_id").collect())
    finally:
        mend(spoiled)
    assert ids == ["c2", "c4"]
    assert rows(moved["people"], "crash_record_id", "person_id") == [("c4", "p5"), ("c4", "p9")]
    assert rows(moved["vehicles"], "crash_record_id", "vehicle_id") == [("c4", "v1")]


def test_published_tables_equal_a_build_of_everything(spark, env):
    raw, served, fresh_root = env
    before = {r.person_id: r.age for r in served.read("dim_person").collect()}
    build_and_publish(spark, raw, served, AS_OF)
    fresh = TableStore(spark, fresh_root)
    build_and_publish(spark, raw, fresh, AS_OF, days_back=60)
    for name in TABLES:
        assert content(served, name) == content(fresh, name), name
    fact = {r.person_group_key: r.month_key for r in served.read("fact_crash").collect()}
    assert fact["c4"] == 202312 and fact["c2"] == 202401 and fact["c7"] == 202401
    assert {r.person_id: r.age for r in served.read("dim_person").collect()} == before  # an older version does not replace the latest


def test_nothing_moves_twice(spark, env):
    raw, served, _ = env
    assert "c7" not in [r[0] for f in moved_records(raw, served, extract(raw, AS_OF), AS_OF, 7, crash_star()).values() for r in f.select("crash_record_id").collect()]
    versions = {n: served.files_version(n) for n in TABLES}
    build_and_publish(spark, raw, served, AS_OF)
    assert {n: served.files_version(n) for n in TABLES} == versions
