"""Lookups in published histories open the folders of the facts' days only."""

import datetime as dt

import pytest

from starforge.operators.history import observed_history, point_in_time
from starforge.plans import observed
from starforge.plans.observed import SPAN, _spans, compact_observed, point_in_time_published, publish_observed, read_observed
from starforge.plans.star import publish_table
from starforge.session import scratch_path
from starforge.sources.store import TableStore
from tests.conftest import rows
from tests.test_keyindex import mend, spoil
from tests.test_observed_history import ARGS, OBS, RULE


def frame(spark, data):
    return spark.createDataFrame([(e, c, dt.datetime.fromisoformat(t), r) for e, c, t, r in data], OBS)


# "long" holds one condition from January to May; "gone" only appears in May
DATA = [
    ("a", "x", "2024-01-03 08:00:00", "r1"), ("a", "y", "2024-01-20 08:00:00", "r2"), ("a", "x", "2024-02-05 08:00:00", "r3"),
    ("a", "z", "2024-03-05 08:00:00", "r4"), ("a", "x", "2024-04-05 08:00:00", "r5"), ("a", "y", "2024-04-20 08:00:00", "r6"),
    ("long", "x", "2024-02-10 08:00:00", "r7"), ("long", "y", "2024-05-02 08:00:00", "r8"), ("gone", "x", "2024-05-03 08:00:00", "r9"),
    ("gone", "y", "2024-05-09 08:00:00", "r10"),
]
PROBES = [("a", "2024-04-06 00:00:00", 1), ("a", "2024-04-19 23:00:00", 2), ("long", "2024-04-10 00:00:00", 3), ("gone", "2024-04-10 00:00:00", 4), ("no", "2024-04-10 00:00:00", 5)]


@pytest.fixture
def store(spark):
    store = TableStore(spark, scratch_path(spark, "lookup"))
    publish_table(store, "h", observed_history(frame(spark, DATA), *ARGS), RULE)
    return store


def probes(spark, data=PROBES):
    typed = [(e, t and dt.datetime.fromisoformat(t), i) for e, t, i in data]
    return spark.createDataFrame(typed, "place string, at timestamp, id int")


def look_up(spark, store, p):
    return rows(point_in_time_published(store, "h", p, "place", "at", "id", RULE))


def plain(spark, store, p):
    return rows(point_in_time(p, "place", "at", "id", read_observed(store, "h"), "loc", "cond"))


def test_equal_to_the_lookup_in_everything(spark, store):
    p = probes(spark, [*PROBES, ("a", None, 6)])
    got = look_up(spark, store, p)
    assert got == plain(spark, store, p) and len(got) == 6
    by_id = {r[2]: r[3] for r in got}
    assert by_id == {1: "x", 2: "x", 3: "x", 4: None, 5: None, 6: None}


def test_other_folders_are_not_opened(spark, store):
    want = plain(spark, store, probes(spark))
    # February holds the long interval, April the days asked for; the schema is read from January's file
    spoiled = spoil(store.read("h"), "row_state=open", "month_key=202401", "month_key=202402", "month_key=202404")
    assert {p.split("month_key=")[1][:6] for p, _ in spoiled} == {"202403", "202405"}
    # March's only interval ends on 5 April, a day before the first fact
    assert _spans(store, "h")[(1, 202403)] == "2024-04-05"
    try:
        assert look_up(spark, store, probes(spark)) == want
    finally:
        mend(spoiled)


def test_spans_follow_late_rows_and_folding(spark, store, monkeypatch):
    # r3 is withdrawn: January's last interval now reaches to March; a late row splits April
    publish_observed(store, "h", frame(spark, [("a", "q", "2024-04-10 08:00:00", "r11")]), RULE, frame(spark, DATA[2:3]).select("rid"))
    p = probes(spark, [*PROBES, ("a", "2024-02-20 00:00:00", 7)])
    assert look_up(spark, store, p) == plain(spark, store, p)
    assert ("a", dt.datetime(2024, 2, 20), 7, "y", "2024-01-20", "2024-03-05") in look_up(spark, store, p)
    assert compact_observed(store, "h", RULE, most=1)
    assert {s for s, _ in _spans(store, "h")} == {observed.committed(store, "h")}
    assert look_up(spark, store, p) == plain(spark, store, p)


def test_a_cut_off_merge_leaves_no_note_behind(spark, store, monkeypatch):
    late = frame(spark, [("a", "q", "2024-04-10 08:00:00", "r11")])
    with monkeypatch.context() as m:
        m.setattr(observed, "_generation", lambda n: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            publish_observed(store, "h", late, RULE)
    assert any(s == 2 for s, _ in _spans(store, "h"))
    assert look_up(spark, store, probes(spark)) == plain(spark, store, probes(spark))
    publish_observed(store, "h", frame(spark, [("a", "w", "2024-06-10 08:00:00", "r12")]), RULE)
    for s, m in _spans(store, "h"):
        assert str(m) in store.partition_values("h", "month_key", under=f"row_state=closed/segment={s}")
    assert look_up(spark, store, probes(spark)) == plain(spark, store, probes(spark))


def test_folders_without_a_note_are_read_and_no_facts_find_nothing(spark, store):
    for m in store.marks("h", SPAN):
        store.unmark("h", m)
    assert look_up(spark, store, probes(spark)) == plain(spark, store, probes(spark))
    assert look_up(spark, store, probes(spark, [("a", None, 1)])) == [("a", None, 1, None, None, None)]
    assert look_up(spark, store, probes(spark).limit(0)) == []
