"""The pipeline's stages: columns kept, decisions taken, odd rows survive."""

from __future__ import annotations

import corpus_pipeline
from starforge.llm import quality_classifier
from tests.conftest import SF001


def test_stage_order_and_columns(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns
        assert stage(spark, docs.limit(0), SF001).count() == 0


def test_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    good = {r.doc_id for r in quality_classifier.quality_report(docs, labels).where("predicted = 1").collect()}
    kept = corpus_pipeline.quality(spark, docs, SF001)
    assert {r.doc_id for r in kept.collect()} == good
    assert corpus_pipeline.near_duplicates(spark, docs.unionByName(docs), SF001).count() <= docs.count()


def test_run_packs_what_was_mixed(spark):
    out = corpus_pipeline.run(spark, SF001)
    per = out.groupBy("sequence_id").agg({"length": "sum", "offset": "max"}).collect()
    assert per and all(r["sum(length)"] <= 2048 for r in per)
