"""Incremental feed ingest with Structured Streaming.

Landed record files are a file stream. ``trigger(availableNow=True)`` runs
every file not yet seen (tracked in the stream checkpoint) in bounded
micro-batches (``maxFilesPerTrigger``) and stops; each micro-batch is merged
into the raw table by ``foreachBatch``:

1. prepare (date partitions, ``'N/A'`` fill, exclusions; no landed row is
   dropped for its date);
2. upsert into the raw table, touched partitions only (M2);
3. advance the feed's high-water mark, only forward (M3).

The mark moves after the data is written, so a crash between 2 and 3 replays
the batch, and both steps are idempotent (upsert by key, max of marks). Then the
batch's number is put on record: a replay after that is skipped without reading.

The stream's checkpoint lies beside the raw tables unless told otherwise, so
the next application goes on where the last one ended.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, staging
from ..sources.feeds import LANDED, FeedSpec, parse_records, prepare, promote_new_fields, upsert_feed
from ..sources.store import TableStore, list_files, path_exists, touch
from ..sources.watermark import batch_mark, publish_mark

STREAMS = "_streams"
COMMITS = "_commits"  # names of merged micro-batches, by feed


def process_batch(store: TableStore, spec: FeedSpec, batch: DataFrame, commit: str | None = None) -> None:
    """Merge one micro-batch. ``commit`` names it (stream id and batch number): a batch whose
    name is on record has been merged as a whole and is skipped unread."""
    spark = batch.sparkSession
    done = f"{store.root}/{COMMITS}/{spec.name}/{commit}" if commit else None
    if done and path_exists(spark, done):
        return
    prepared = prepare(batch, spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = store.read(spec.name, merge_schema=True).columns if spec.allow_new_columns and store.exists(spec.name) else []
        with staging(spark):
            upsert_feed(store, spec, promote_new_fields(prepared, known))
            publish_mark(store, batch_mark(prepared, spec.date_col, spec.mark_name))
        if done:
            touch(spark, done)
            _forget(store, spec, commit)
    finally:
        prepared.unpersist()


def _forget(store: TableStore, spec: FeedSpec, commit: str) -> None:
    """Keep the names of a stream's last two batches: a stream repeats its last one at most."""
    stream, number = commit.rsplit("-", 1)
    folder = f"{store.root}/{COMMITS}/{spec.name}"
    for f in list_files(store.spark, folder):
        s, n = f.rsplit("-", 1)
        if s == stream and int(n) < int(number) - 1:
            remove_path(store.spark, f"{folder}/{f}")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id in its checkpoint (a new checkpoint is a new stream, numbered from 0 again)."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(
    spark: SparkSession,
    spec: FeedSpec,
    landing: str,
    store: TableStore,
    max_files_per_trigger: int | None = None,
    checkpoint: str | None = None,
    fmt: str = "json",
) -> None:
    """Process every landed file not yet ingested, then return.

    With ``spec.allow_new_columns`` landed JSON lines are read as text and parsed
    by the schema, so that fields it does not name are kept.
    """
    grows = spec.allow_new_columns and fmt == "json"
    reader = spark.readStream.format("text") if grows else spark.readStream.schema(spec.schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    stream = reader.load(landing).select("*", landed.alias(LANDED))
    if grows:
        stream = parse_records(stream, spec.schema)
    ckpt = checkpoint or f"{store.root}/{STREAMS}/{spec.name}"
    query = (
        stream.writeStream.foreachBatch(lambda df, number: process_batch(store, spec, df, f"{stream_id(df.sparkSession, ckpt)}-{number}"))
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced by awaitTermination
        raise RuntimeError(str(query.exception()))
