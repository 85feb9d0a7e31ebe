"""Merge operators against a plain-Python model of SQL MERGE (random frames)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starforge.operators import merge

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
ROW = st.tuples(KEYS, st.integers(0, 9), st.integers(0, 9))
SCHEMA = "k string, x int, y int"


def unique_keys(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is None or r[0] not in seen:
            out.append(r)
            if r[0] is not None:
                seen.add(r[0])
    return out


def model(target, source, update, condition, insert):
    """SQL MERGE: keys compare with '=', so a null key never matches."""
    src = {r[0]: r for r in source if r[0] is not None}
    out = []
    for t in target:
        s = src.get(t[0]) if t[0] is not None else None
        if s is None or not condition(t, s):
            out.append(t)
        elif update == "all":
            out.append(s)
        else:
            out.append((t[0], s[1] if "x" in update else t[1], s[2] if "y" in update else t[2]))
    if insert:
        tkeys = {t[0] for t in target if t[0] is not None}
        out += [s for s in source if s[0] is None or s[0] not in tkeys]
    return sorted(out, key=repr)


def run(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


settings_ = settings(max_examples=16, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings_
@given(st.lists(ROW, max_size=6), st.lists(ROW, max_size=6), st.sampled_from(["all", ("x",), ("y",)]), st.booleans(), st.booleans(), st.booleans())
def test_merge_matches_model(spark, target, source, update, conditional, insert, read_once):
    target, source = unique_keys(target), unique_keys(source)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    cond = "b.x > a.x" if conditional else None
    got = run(merge.merge(t, s, ["k"], update=update if update == "all" else list(update), condition=cond, insert=insert, read_once=read_once))
    want = model(target, source, update, (lambda a, b: b[1] > a[1]) if conditional else (lambda a, b: True), insert)
    assert got == want


@settings_
@given(st.lists(ROW, max_size=6), st.lists(ROW, max_size=6))
def test_upsert_and_insert_only_match_model(spark, target, source):
    target, source = unique_keys(target), unique_keys(source)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    assert run(merge.upsert_all(t, s, ["k"])) == model(target, source, "all", lambda a, b: True, True)
    got = run(merge.apply_insert_only(t, s, ["k"]))
    assert got == model(target, source, None, lambda a, b: False, True)
