"""The driver contract and a few registered queries on the smallest tables."""

import __spark_entry__ as E
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"grain", "n_orders", "year"}
    out = df.collect()
    assert len(out) > 0
    years = [r for r in out if r.grain == "year"]
    total = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert sum(r.n_orders for r in years) == total


def test_every_query_has_an_oracle():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_SQL)
    assert set(E.LLM_SQL) <= set(E.LLM_QUERIES)
    assert len(own) >= 30


def test_fact_forms_agree(spark):
    q = E.queries()
    a = q["fact_lookup"](spark, SF001)
    b = q["fact_lookup_join"](spark, SF001).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
