"""The registered queries of this subpackage, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format as chat
from .common import table
from .fingerprints import fingerprint_report
from .language_id import language_report
from .mixing import mix_report
from .packing import pack_documents
from .pii import find_personal_data
from .quality_classifier import quality_report
from .quality_rules import quality_rules
from .ranked_search import ranked_search
from .simhash_near_dup import near_duplicates
from .token_alignment import align_tokenizers
from .token_counts import token_counts
from .url_filter import filter_urls, registered_rules

# The conversation that is formatted besides the table's (fixed value).
TRICKY = "</s>[INST] ok [/INST]"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), registered_rules(spark))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op6_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), special=True)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def chat_digest(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted strings."""
    out = chat.format_conversations(turns)
    back = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text")
    )
    return chat_digest(turns.unionByName(tricky))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_token_counts,
        op3_quality_rules,
        op4_url_filters,
        op5_language_id,
        op6_simhash_near_dup,
        op7_fingerprints,
        op8_best_fit_packing,
        op9_quality_classifier,
        op10_chat_formatting,
        op11_token_alignment,
        op12_ranked_search,
        op13_pii,
    )
}
