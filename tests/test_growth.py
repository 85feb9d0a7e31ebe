"""Feeds that grow fields, and micro-batches that are repeated."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.session import scratch_path
from starforge.sources import feeds
from starforge.sources.feeds import RESCUED, FeedSpec, parse_records, prepare, promote_new_fields
from starforge.sources.store import TableStore, list_files
from starforge.streaming import ingest
from starforge.streaming.ingest import COMMITS, ingest_stream, process_batch
from tests.conftest import rows

SPEC = FeedSpec("raw", "Raw", T.StructType([T.StructField(c, T.StringType()) for c in ("id", "crash_date", "v")]), ("id",), allow_new_columns=True)
DAY = "2024-01-0{}T08:00:00"


def land(spark, folder, name, records, junk=()):
    lines = [json.dumps(r) for r in records] + list(junk)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}")


@pytest.fixture
def env(spark):
    return scratch_path(spark, "growing"), TableStore(spark, scratch_path(spark, "raw"))


def test_new_fields_become_columns(spark, env):
    folder, store = env
    land(spark, folder, "b0", [{"id": "a", "crash_date": DAY.format(1), "v": 1}, {"id": "b", "crash_date": DAY.format(1), "v": "x"}], ["", "   "])
    ingest_stream(spark, SPEC, f"{folder}/*", store)
    assert "lane" not in store.read("raw", merge_schema=True).columns
    land(spark, folder, "b1", [{"id": "b", "crash_date": DAY.format(1), "v": "y", "lane": 3, "geo": {"lat": 1}}, {"id": "c", "crash_date": DAY.format(2), "v": None}])
    ingest_stream(spark, SPEC, f"{folder}/*", store)
    land(spark, folder, "b2", [{"id": "d", "crash_date": DAY.format(3), "lane": "4"}])  # without geo
    ingest_stream(spark, SPEC, f"{folder}/*", store)
    got = rows(store.read("raw", merge_schema=True).select("id", "v", "lane", "geo"))
    assert got == [("a", "1", None, None), ("b", "y", "3", '{"lat":1}'), ("c", "N/A", None, None), ("d", "N/A", "4", None)]


def test_fields_that_cannot_be_columns_stay_rescued(spark, env, monkeypatch):
    lines = spark.createDataFrame([('{"id": "a", "V": "clash", "a b": "odd", "new": "1"}', 1), ('{"id": "b"}', 2)], "value string, n int")
    out = promote_new_fields(prepare(parse_records(lines, SPEC.schema), SPEC), [])
    assert rows(out.select("id", "new", RESCUED)) == [("a", "1", '{"V":"clash","a b":"odd"}'), ("b", None, None)]
    monkeypatch.setattr(feeds, "MOST_COLUMNS", 0)
    out = promote_new_fields(prepare(parse_records(lines, SPEC.schema), SPEC), ["new"])  # known already: no new column
    assert rows(out.select("id", "new")) == [("a", "1"), ("b", None)]
    assert RESCUED not in promote_new_fields(prepare(parse_records(lines.where("n = 2"), SPEC.schema), SPEC), []).columns


def test_a_merged_batch_is_not_read_again(spark, env):
    folder, store = env
    batch = spark.createDataFrame([("a", DAY.format(1), "x")], SPEC.schema)
    process_batch(store, SPEC, batch, "stream-7")
    files = store.read("raw").inputFiles()
    unreadable = batch.withColumn("v", F.raise_error(F.lit("read")).cast("string"))
    process_batch(store, SPEC, unreadable, "stream-7")
    assert store.read("raw").inputFiles() == files
    with pytest.raises(Exception, match="read"):
        process_batch(store, SPEC, unreadable, "stream-8")
    for i in range(8, 12):
        process_batch(store, SPEC, batch, f"stream-{i}")
    assert sorted(list_files(spark, f"{store.root}/{COMMITS}/raw")) == ["stream-10", "stream-11"]


def test_a_batch_cut_off_before_its_record_is_merged_again(spark, env, monkeypatch):
    folder, store = env
    land(spark, folder, "b0", [{"id": "a", "crash_date": DAY.format(1), "v": "x"}])
    with monkeypatch.context() as m:
        m.setattr(ingest, "touch", lambda *a: (_ for _ in ()).throw(RuntimeError("cut off")))
        with pytest.raises(Exception, match="cut off"):
            ingest_stream(spark, SPEC, f"{folder}/*", store)
    ingest_stream(spark, SPEC, f"{folder}/*", store)
    assert rows(store.read("raw").select("id", "v")) == [("a", "x")]


def test_a_new_checkpoint_is_a_new_stream(spark, env):
    folder, store = env
    land(spark, folder, "b0", [{"id": "a", "crash_date": DAY.format(1), "v": "x"}])
    ingest_stream(spark, SPEC, f"{folder}/*", store, checkpoint=scratch_path(spark, "ckpt"))
    land(spark, folder, "b0", [{"id": "a", "crash_date": DAY.format(1), "v": "y"}])
    ingest_stream(spark, SPEC, f"{folder}/*", store, checkpoint=scratch_path(spark, "ckpt"))  # batch 0 again, of another stream
    assert rows(store.read("raw").select("id", "v")) == [("a", "y")]
