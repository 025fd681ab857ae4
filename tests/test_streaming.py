"""Streaming runs agree with batch; restarts resume exactly once."""
import os
from datetime import datetime

from pyspark.sql import functions as F

from topiclake.operators import analytics, sink
from topiclake.sources.topiclog import LOG_SCHEMA, TopicLog
from topiclake.streaming import feeds


def test_tail_restart_resumes(spark, fx, scratch):
    log = TopicLog(f"{scratch}/log")
    recs = fx.log.records(spark).where(F.col("topic") == "events")
    sink.write_records(recs.where(F.col("offset") < 100), log, mode="overwrite")
    fx.log.catalog(spark).write.mode("overwrite").parquet(log.catalog_path)
    out, ck = f"{scratch}/sink", f"{scratch}/ck"
    first = feeds.tail(spark, log, "events", out, ck).count()
    sink.write_records(recs.where(F.col("offset") >= 100), log, mode="append")
    total = feeds.tail(spark, log, "events", out, ck)
    assert first == recs.where(F.col("offset") < 100).count()
    assert total.count() == recs.count()
    assert total.groupBy("partition", "offset").count().where(F.col("count") > 1).count() == 0


def _batch_counts(spark, fx):
    batch_recs = fx.log.records(spark).where(F.col("topic") == "events")
    typed = batch_recs.select("timestamp", F.get_json_object(
        F.decode(F.substring("message", 6, 1 << 30), "UTF-8"), "$.event_type").alias("event_type"))
    return analytics.tumbling_counts(typed, "timestamp", "1 hour", ["event_type"])


def _ntz(df):
    return df.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n")


def test_window_counts_closed_windows_equal_batch(spark, fx, scratch):
    """All records in one micro-batch: every window the watermark closed is emitted once,
    with the batch count; only windows newer than the watermark stay open."""
    recs = feeds.stream_records(spark, fx.log, ["events"])
    feeds.run_available_now(feeds.event_type_counts(recs), f"{scratch}/sink", f"{scratch}/ck")
    got = _ntz(spark.read.parquet(f"{scratch}/sink"))
    want = _batch_counts(spark, fx)
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0
    max_ts = fx.log.records(spark).where(F.col("topic") == "events").agg(F.max("timestamp")).first()[0]
    closed = want.where(F.col("window_end") <= F.lit(max_ts).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR"))
    assert closed.exceptAll(got).count() == 0


def test_window_counts_over_many_batches_lose_nothing(spark, fx, scratch):
    """One file per trigger, out of event-time order: all windows equal the batch counts, and
    the closed ones are those that every partition has passed."""
    recs = feeds.stream_records(spark, fx.log, ["events"], max_files_per_trigger=1)
    feeds.window_counts_into(recs, f"{scratch}/table", f"{scratch}/ck")
    assert len([d for d in os.listdir(f"{scratch}/table/counts") if d.startswith("batch=")]) > 2
    got = _ntz(feeds.closed_windows(spark, f"{scratch}/table", "-100000 days"))
    want = _batch_counts(spark, fx)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    closed = _ntz(feeds.closed_windows(spark, f"{scratch}/table"))
    assert 0 < closed.count() < want.count() and closed.exceptAll(want).count() == 0


def test_dedup_over_many_batches_loses_nothing(spark, scratch):
    """Unique records of five partitions, one file per trigger, far apart in time, then all again."""
    rows = [("t", p, o, None, None, datetime(2024, 1, 1 + 5 * ((p * 3) % 5), 0, o)) for p in range(5) for o in range(30)]
    df = spark.createDataFrame(rows, LOG_SCHEMA).repartition(5, "partition")
    for _ in range(2):
        df.write.mode("append").parquet(f"{scratch}/landing")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/landing")
    out = feeds.dedup_into(src, f"{scratch}/table", f"{scratch}/ck")
    assert out.count() == 150 and out.dropDuplicates(["topic", "partition", "offset"]).count() == 150
    again = feeds.dedup_into(src, f"{scratch}/table", f"{scratch}/ck")  # nothing new
    assert again.count() == 150


def test_tail_from_latest_and_from_offsets(spark, fx, scratch):
    log = TopicLog(f"{scratch}/log")
    recs = fx.log.records(spark).where(F.col("topic") == "events")
    sink.write_records(recs.where(F.col("offset") < 100), log, mode="overwrite")
    assert feeds.tail(spark, log, "events", f"{scratch}/a", f"{scratch}/cka", start="latest").count() == 0
    sink.write_records(recs.where(F.col("offset") >= 100), log, mode="append")
    new = feeds.tail(spark, log, "events", f"{scratch}/a", f"{scratch}/cka", start="latest")
    assert new.count() == recs.where(F.col("offset") >= 100).count() > 0
    some = feeds.tail(spark, log, "events", f"{scratch}/b", f"{scratch}/ckb", start={1: 50})
    assert some.count() == recs.where((F.col("partition") != 1) | (F.col("offset") >= 50)).count()


def test_dedup_keeps_one_copy(spark, fx, scratch):
    recs = fx.log.records(spark).where(F.col("topic") == "copy")
    for _ in range(2):
        recs.write.mode("append").parquet(f"{scratch}/landing")
    from topiclake.sources.topiclog import LOG_SCHEMA
    src = spark.readStream.schema(LOG_SCHEMA).parquet(f"{scratch}/landing")
    feeds.run_available_now(feeds.dedup_records(src), f"{scratch}/sink", f"{scratch}/ck")
    assert spark.read.parquet(f"{scratch}/sink").count() == recs.count()


def test_ingest_stream_restart_is_exactly_once(spark, fx, scratch):
    log = TopicLog(f"{scratch}/log")
    recs = fx.log.records(spark).where(F.col("topic") == "orders")
    sink.write_records(recs.where(F.col("offset") < 60), log, mode="overwrite")
    table, ck = f"{scratch}/table", f"{scratch}/ck"
    feeds.ingest_stream(spark, log, table, ck)
    feeds.ingest_stream(spark, log, table, ck)          # nothing new: nothing appended
    sink.write_records(recs.where(F.col("offset") >= 60), log, mode="append")
    out = feeds.ingest_stream(spark, log, table, ck)     # resumes after the first files
    assert out.count() == recs.count()
    assert out.groupBy("partition", "offset").count().where(F.col("count") > 1).count() == 0
