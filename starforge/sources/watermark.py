"""Stored high-water marks per feed (not event-time watermarks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import parse_timestamp
from ..operators.merge import merge
from .store import TableStore

MARKS_TABLE = "watermark"
MARK_SCHEMA = T.StructType(
    [T.StructField("TableName", T.StringType(), False), T.StructField("WatermarkValue", T.TimestampType(), True)]
)


def batch_mark(df: DataFrame, ts_col: str, name: str) -> DataFrame:
    """One row: the feed name and the batch's latest parsable timestamp.

    A global aggregate (partial max per task); it stays a DataFrame, nothing
    is collected. An empty or unparsable batch yields no row.
    """
    agg = df.agg(F.max(parse_timestamp(ts_col)).alias("WatermarkValue"))
    return agg.where(F.col("WatermarkValue").isNotNull()).select(
        F.lit(name).alias("TableName"), F.col("WatermarkValue").cast("timestamp")
    )


def advance_marks(current: DataFrame, new: DataFrame) -> DataFrame:
    """Conditional upsert: a mark only moves forward; unknown feeds are added."""
    return merge(current, new, ["TableName"], update=["WatermarkValue"], condition="b.WatermarkValue > a.WatermarkValue")


def publish_mark(store: TableStore, new: DataFrame) -> None:
    spark = new.sparkSession
    current = store.read(MARKS_TABLE) if store.exists(MARKS_TABLE) else spark.createDataFrame([], MARK_SCHEMA)
    store.replace(MARKS_TABLE, advance_marks(current, new).coalesce(1))
    store.vacuum(MARKS_TABLE, keep=2)


def read_mark(spark: SparkSession, store: TableStore, name: str):
    """The stored mark of one feed (a single value), or None."""
    if not store.exists(MARKS_TABLE):
        return None
    row = store.read(MARKS_TABLE).where(F.col("TableName") == name).select("WatermarkValue").first()
    return row[0] if row else None
