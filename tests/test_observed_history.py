"""Late, moved and withdrawn observations; bridges that follow corrections; published forms and cut-off runs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.operators.history import observed_history, splice_history
from starforge.plans import observed
from starforge.plans.observed import clean_observed, compact_observed, publish_observed, read_observed
from starforge.plans.star import Rule, publish_table
from starforge.session import scratch_path
from starforge.sources.store import TableStore
from tests.conftest import rows

OBS = "loc string, cond string, observed_at timestamp, rid string"
RULE = Rule("observed", ("rid",), entity="loc", cond="cond", sort=("loc", "start_date"))
ARGS = ("loc", "cond", "observed_at", "rid")


def frame(spark, data):
    return spark.createDataFrame([(e, c, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), r) for e, c, h, r in data], OBS)


def plain(data):
    """Intervals of (entity, condition, hour, record) in order."""
    day = lambda h: str((dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).date())
    out = []
    for e in {x[0] for x in data}:
        own = sorted((h, r, c) for x, c, h, r in data if x == e)
        out += [(e, c, day(h), day(n[0]) if n else "", r) for (h, r, c), n in zip(own, [*own[1:], None])]
    return sorted(out)


def intervals(df):
    return rows(df.select("loc", "cond", "start_date", "end_date", "rid"))


def spliced(log, batch, withdrawn=None):
    s = splice_history(log, batch, *ARGS, withdrawn=withdrawn)
    return log.join(s.removed.select("rid"), "rid", "left_anti").select(*log.columns).unionByName(s.added)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 12), st.tuples(st.sampled_from("xy"), st.sampled_from("DW"), st.integers(0, 100)), min_size=1),
    st.dictionaries(st.integers(0, 16), st.tuples(st.sampled_from("xyz"), st.sampled_from("DW"), st.integers(0, 100))),
    st.sets(st.integers(0, 16)),
)
def test_a_splice_is_the_full_recompute(spark, first, second, gone):
    data = lambda d: [(e, c, h, f"r{i:02}") for i, (e, c, h) in d.items()]
    log = observed_history(frame(spark, data(first)), *ARGS)
    out = spliced(log, frame(spark, data(second)), spark.createDataFrame([(f"r{i:02}",) for i in gone], "rid string"))
    left = {**{i: v for i, v in first.items() if i not in gone}, **second}
    assert intervals(out) == plain(data(left))


def test_a_late_observation_splits_its_interval(spark):
    log = observed_history(frame(spark, [("x", "DRY", 0, "a"), ("x", "WET", 240, "b"), ("x", "DRY", 480, "c"), ("y", "DRY", 5, "d")]), *ARGS)
    s = splice_history(log, frame(spark, [("x", "ICY", 100, "e")]), *ARGS)
    assert rows(s.removed.select("rid")) == [("a",)]  # only its neighbour changes
    assert rows(s.added.select("rid", "start_date", "end_date")) == [("a", "2024-01-01", "2024-01-05"), ("e", "2024-01-05", "2024-01-11")]


def test_nothing_new_changes_nothing(spark):
    data = [("x", "DRY", 0, "a"), ("x", "WET", 240, "b")]
    log = observed_history(frame(spark, data), *ARGS)
    s = splice_history(log, frame(spark, data[:1]), *ARGS)
    assert s.removed.count() == s.added.count() == 0
    s = splice_history(log, frame(spark, []), *ARGS)
    assert s.removed.count() == s.added.count() == 0


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "observed"))


FIRST = [("x", "DRY", 0, "a"), ("x", "WET", 1000, "b"), ("y", "DRY", 24, "c"), ("y", "ICY", 900, "d")]
LATE = [("x", "ICY", 500, "e"), ("y", "WET", 24, "c"), ("x", "DRY", 2000, "f")]
AFTER = [x for x in FIRST if x[3] != "c"] + LATE


def publish(spark, store, data, withdrawn=None):
    if not store.exists("hist"):
        publish_table(store, "hist", observed_history(frame(spark, data), *ARGS), RULE)
    else:
        publish_observed(store, "hist", frame(spark, data), RULE, withdrawn)
    return intervals(read_observed(store, "hist"))


def test_publishing_late_moved_and_withdrawn_observations(spark, store):
    assert publish(spark, store, FIRST) == plain(FIRST)
    assert publish(spark, store, LATE) == plain(AFTER)
    files = store.read("hist").inputFiles()
    assert publish(spark, store, LATE) == plain(AFTER) and sorted(store.read("hist").inputFiles()) == sorted(files)  # a replay writes nothing
    gone = spark.createDataFrame([("a",), ("zzz",)], "rid string")
    assert publish(spark, store, [], gone) == plain([x for x in AFTER if x[3] != "a"])
    # what lies in the folders is the history: SQL readers need no filter
    assert intervals(store.read("hist")) == intervals(read_observed(store, "hist"))
    assert store.read("hist").where("row_state = 'open'").count() == 2


def test_new_rows_alone_rewrite_open_rows_only(spark, store):
    publish(spark, store, FIRST)
    closed = lambda: {f for f in store.read("hist").inputFiles() if "row_state=closed" in f}
    before = closed()
    publish(spark, store, [("x", "DRY", 2000, "f"), ("y", "DRY", 2100, "g")])
    assert before < closed()


@pytest.mark.parametrize("cut", ["before", "after"])
def test_a_merge_cut_off_around_its_commit(spark, store, monkeypatch, cut):
    publish(spark, store, FIRST)
    with monkeypatch.context() as m:
        if cut == "before":
            mark = TableStore.mark
            m.setattr(TableStore, "mark", lambda s, n, x: mark(s, n, x) if x.startswith(observed.REPLACED) else (_ for _ in ()).throw(RuntimeError("cut off")))
        else:
            calls = []
            m.setattr(observed, "clean_observed", lambda *a: calls.append(a) or (clean_observed(*a) if len(calls) == 1 else (_ for _ in ()).throw(RuntimeError("cut off"))))
        with pytest.raises(RuntimeError):
            publish(spark, store, LATE)
    assert intervals(read_observed(store, "hist")) == plain(FIRST if cut == "before" else AFTER)
    assert publish(spark, store, LATE) == plain(AFTER)
    assert intervals(store.read("hist")) == plain(AFTER)


def test_many_segments_are_folded(spark, store, monkeypatch):
    data = list(FIRST)
    publish(spark, store, data)
    for i in range(5):
        new = [("x", "DRY" if i % 2 else "WET", 2000 + 24 * i, f"n{i}")]
        data += new
        publish(spark, store, new)
    segments = lambda: store.partition_values("hist", "segment", under="row_state=closed")
    assert len(segments()) == 6
    with monkeypatch.context() as m:
        m.setattr(TableStore, "mark", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(RuntimeError):
            compact_observed(store, "hist", RULE, most=3)
    assert intervals(read_observed(store, "hist")) == plain(data)
    assert compact_observed(store, "hist", RULE, most=3) and not compact_observed(store, "hist", RULE, most=3)
    assert len(segments()) == 1 and intervals(store.read("hist")) == plain(data)
    late = [("x", "ICY", 10, "late")]
    assert publish(spark, store, late) == plain(data + late)


BRIDGE = "crash string, person string, month_key int"


@pytest.mark.parametrize("parts", [("month_key",), ()])
def test_bridge_pairs_follow_their_group(spark, store, parts):
    rule = Rule("groups", ("crash", "person"), partition_by=parts)

    def run(data):
        publish_table(store, "bridge", spark.createDataFrame(data, BRIDGE), rule)
        return rows(store.read("bridge").select("crash", "person", "month_key"))

    first = [("c1", "p1", 202401), ("c1", "p2", 202401), ("c2", "p1", 202401), ("c3", "p3", 202402), (None, "p9", 202402)]
    assert run(first) == rows(spark.createDataFrame(first, BRIDGE))
    # c1's date moved to another month and p2 was withdrawn; c4 is new; c2 and c3 are not in the batch
    batch = [("c1", "p1", 202402), ("c4", "p1", 202403), (None, "p9", 202402)]
    want = rows(spark.createDataFrame([("c1", "p1", 202402), ("c2", "p1", 202401), ("c3", "p3", 202402), ("c4", "p1", 202403), (None, "p9", 202402)], BRIDGE))
    assert run(batch) == want
    assert run(batch) == want


def test_a_bridge_batch_without_changes_writes_no_file_twice(spark, store):
    rule = Rule("groups", ("crash", "person"), partition_by=("month_key",))
    publish_table(store, "bridge", spark.createDataFrame([("c1", "p1", 202401), ("c2", "p1", 202402)], BRIDGE), rule)
    files = store.read("bridge").inputFiles()
    publish_table(store, "bridge", spark.createDataFrame([("c3", "p1", 202402)], BRIDGE), rule)
    assert set(files) < set(store.read("bridge").inputFiles())
    assert store.read("bridge").agg(F.count("*")).first()[0] == 3
