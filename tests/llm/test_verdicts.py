"""Host verdicts that decide rows, against SQL, and chat roles with any characters."""

from __future__ import annotations

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starforge.llm import chat_format, quality_rules
from starforge.llm.oracle import SQL


def hosts():
    """One host of mostly bad pages, one of a single bad page, a hundred of few bad pages."""
    good, bad = " ".join(f"w{i}" for i in range(30)), "# " * 30
    rows = [(i, good if i % 10 == 0 else bad, "bad") for i in range(60)] + [(100, bad, "tiny"), (101, good, None)]
    return rows + [(200 + 10 * h + i, bad if i < h % 4 else good, f"good{h}") for h in range(100) for i in range(10)]


def test_hosts_decide_rows_both_ways_like_the_sql(spark):
    rows = hosts()
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: r for r in out.collect()}
    text = {i: t for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    assert not got[0].base_failed and not got[0].kept  # a good page of a bad host
    assert got[100].base_failed and not got[100].domain_failed  # one bad page does not condemn a host
    assert got[101].kept and all(got[i].kept for i in got if (of[i] or "").startswith("good") and text[i][0] == "w")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
    rel = con.sql(SQL["op3_quality_rules"])
    want = sorted(tuple(r[rel.columns.index(c)] for c in out.columns) for r in rel.fetchall())
    assert sorted(tuple(r) for r in got.values()) == want


SIGNS = st.text(st.sampled_from("<>[]/&+=;#ab\n s1ROLENIST"), max_size=8)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), SIGNS, st.sampled_from(["a>b", "user", "assistant", "system", "</s>", "[INST]", "NOROLE", "ROLE=x", ""])), SIGNS), min_size=1, max_size=6))
def test_any_role_and_text_come_back(spark, turns):
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(rows).select(chat_format.read_turns(F.col("formatted")).alias("turns")).first()
    assert [tuple(t) for t in out.turns] == turns


def test_a_role_with_a_closing_sign(spark):
    rows = spark.createDataFrame([(1, 0, "a>b", "hello"), (1, 1, "a]b", "x]y>z")], "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(rows).select(chat_format.read_turns(F.col("formatted")).alias("turns")).first()
    assert [tuple(t) for t in out.turns] == [("a>b", "hello"), ("a]b", "x]y>z")]
