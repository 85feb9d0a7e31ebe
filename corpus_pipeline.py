"""From raw documents to packed training sequences, as Spark stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread before the next one. Stages 1 to 4 return the columns of
``docs``; the last one returns the packed pieces. Empty tables, null texts,
repeated rows and further columns pass through each stage as its operator's
docstring says; a stage's own column never hides one of the documents'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starforge.llm import language_id, quality_classifier
from starforge.llm.common import table
from starforge.llm.mixing import mixed_documents
from starforge.llm.packing import pack_documents
from starforge.llm.simhash_near_dup import keep_one
from starforge.session import scratch_path

# A text is of a known language if this share of its n-grams is (corrected).
LANGUAGE_SHARE = 0.25


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold."""
    net = quality_classifier.learn(docs, quality_classifier.training_labels(table(spark, sf_dir, "labels")))
    score = _fresh(docs, "_quality")
    scored = quality_classifier.with_quality(docs, net, out=score)
    return scored.where(scored[score] >= quality_classifier.THRESHOLD).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without a letter or in no known language go."""
    model = language_id.learn(language_id.training_rows(docs))
    found = _fresh(docs, "_language")
    named = language_id.with_language(docs, model, out=found)
    known = (named[found]["lang"] != language_id.UNDETERMINED) & (named[found]["score"] >= LANGUAGE_SHARE)
    return named.where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates (3-word shingles, 3 bits)."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights: a row per span of the mix."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's pieces packed into sequences."""
    return pack_documents(docs, special=True)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

# Learned models, fingerprints and tokens have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, "corpus", f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
