"""Continuous consumption of a topic log with Structured Streaming.

The topic log is a partitioned Parquet folder, so the file stream source reads new
record files as they land; progress (which files are consumed) lives in the query's
checkpoint folder, which must be in the shared folder so a restarted driver resumes
where the last one stopped. Every sink here is exactly-once: Spark's file sink commits
through its own metadata log, the ``foreachBatch`` sinks write a folder named by the batch
id (a replayed batch overwrites its own folder), and the compaction sink writes new versions
of the buckets that a batch changes and then a pointer to them.

A backlog read file by file arrives out of event-time order, so nothing here that must be
exact depends on one global watermark: copies are found by offset, window counts are kept as
sums that late records still reach, and sessions as segments that later ones may join.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import codec
from ..operators import analytics
from ..operators.islands import outside, union_intervals
from ..plans.sizing import broadcast_if_small
from ..session import workspace
from ..sources.topiclog import LOG_SCHEMA, SCAN_COLUMNS, TopicLog, footer_watermarks, is_missing_path


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run (sink + checkpoint) in the shared folder."""
    return workspace(spark, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def stream_records(spark: SparkSession, log: TopicLog, topics: list[str] | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of log records (all topics, or ``topics``)."""
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.parquet(log.records_path).select(*LOG_SCHEMA.fieldNames())
    return df if topics is None else df.where(F.col("topic").isin(topics))


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append",
                      partition_by: list[str] | None = None) -> None:
    """Process everything available now into a Parquet sink, then stop."""
    w = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
         .option("path", sink_path).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.start().awaitTermination()


def tail(spark: SparkSession, log: TopicLog, topic: str, sink_path: str, checkpoint: str,
         start: str | dict[int, int] = "earliest", max_files_per_trigger: int | None = None) -> DataFrame:
    """Consume ``topic`` from where the checkpoint left off into ``sink_path``; returns the
    sink as a batch DataFrame. The first run begins at ``start``: ``"earliest"``,
    ``"latest"`` (only records appended after it) or an offset per partition (partitions
    not named: from their first record). The start is fixed beside the checkpoint, so later
    runs keep it."""
    recs = stream_records(spark, log, [topic], max_files_per_trigger)
    if start != "earliest":
        recs = _from_start(recs, _start_offsets(spark, log, topic, start, f"{checkpoint}-start"))
    run_available_now(recs.select(*SCAN_COLUMNS), sink_path, checkpoint)
    return spark.read.schema(StructType(LOG_SCHEMA.fields[:5])).parquet(sink_path).select(*SCAN_COLUMNS)


def _start_offsets(spark: SparkSession, log: TopicLog, topic: str, start, path: str) -> DataFrame:
    """``partition, _start`` of a feed's first run, written once."""
    schema = "partition int, _start long"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
    if start == "latest":
        rows = footer_watermarks(spark, log, [topic]).select("partition", F.col("high").alias("_start"))
    elif isinstance(start, dict):
        rows = spark.createDataFrame([(int(p), int(o)) for p, o in start.items()], schema)
    else:
        raise ValueError(f"unknown start {start!r}")
    rows.coalesce(1).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _from_start(records: DataFrame, starts: DataFrame) -> DataFrame:
    j = records.join(broadcast_if_small(starts), "partition", "left")
    return j.where(F.col("offset") >= F.coalesce(F.col("_start"), F.lit(0))).drop("_start")


def _batch_table(spark: SparkSession, path: str, schema: str, only: int | None = None) -> DataFrame:
    """The rows of a table kept as one folder per batch (of batch ``only``)."""
    try:
        df = spark.read.schema(f"{schema}, batch long").parquet(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], schema)
    if only is not None:
        df = df.where(F.col("batch") == F.lit(only))
    return df.drop("batch")


def _run_batches(df: DataFrame, write, checkpoint: str) -> None:
    (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def dedup_into(records: DataFrame, table_path: str, checkpoint: str) -> DataFrame:
    """Keep one copy of every record (topic, partition, offset), in any arrival order and over
    any number of batches. Each batch drops the copies inside it, then records whose offset lies in
    the merged offset intervals of the batches before, and writes the intervals with its own
    added. No batch reads the table or what came before the last intervals, whose number is that
    of the gaps in the offsets seen. No state store."""
    spark, keys = records.sparkSession, ["topic", "partition", "offset"]

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = _batch_table(batch.sparkSession, f"{table_path}-offsets", _INTERVALS, only=batch_id - 1)
        new = outside(batch.dropDuplicates(keys), seen).checkpoint(eager=True)
        new.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")
        own = new.select("topic", "partition", F.col("offset").alias("lo"), (F.col("offset") + 1).alias("hi"))
        union_intervals(seen.unionByName(own)).write.mode("overwrite").parquet(f"{table_path}-offsets/batch={batch_id}")

    _run_batches(records, write, checkpoint)
    return _batch_table(spark, table_path, _LOG).select(*LOG_SCHEMA.fieldNames())


_INTERVALS = "topic string, partition int, lo long, hi long"
_LOG = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields)


def window_counts_into(records: DataFrame, table_path: str, checkpoint: str, width: str = "1 hour",
                       slide: str | None = None) -> None:
    """Tumbling (or, with ``slide``, sliding) window counts per event type that lose no late
    record: every batch adds its own counts, and how far each partition's event time has come; a
    window's count is their sum."""
    def write(batch: DataFrame, batch_id: int) -> None:
        typed = _typed(batch).select("topic", "partition", "timestamp", "event_type")
        counts = (typed.groupBy(F.window("timestamp", width, slide).alias("w"), "event_type")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n"))
        counts.write.mode("overwrite").parquet(f"{table_path}/counts/batch={batch_id}")
        (typed.groupBy("topic", "partition").agg(F.max("timestamp").alias("reached"))
         .write.mode("overwrite").parquet(f"{table_path}/reached/batch={batch_id}"))

    _run_batches(records, write, checkpoint)


def _typed(records: DataFrame) -> DataFrame:
    return records.withColumn("event_type", F.get_json_object(codec.wire_payload_text(F.col("message")), "$.event_type"))


_COUNTS = "window_start timestamp, window_end timestamp, event_type string, n long"
_REACHED = "topic string, partition int, reached timestamp"


def closed_windows(spark: SparkSession, table_path: str, delay: str = "1 hour") -> DataFrame:
    """Counts of the windows that every partition has passed by ``delay``."""
    reached = (_batch_table(spark, f"{table_path}/reached", _REACHED)
               .groupBy("topic", "partition").agg(F.max("reached").alias("r")).agg(F.min("r").alias("r")).first().r)
    counts = _batch_table(spark, f"{table_path}/counts", _COUNTS)
    counts = counts.groupBy("window_start", "window_end", "event_type").agg(F.sum("n").alias("n"))
    return counts.where(F.col("window_end") <= F.lit(reached).cast("timestamp") - F.expr(f"INTERVAL {delay}"))


def sessions_into(records: DataFrame, table_path: str, checkpoint: str, gap: str) -> None:
    """Session windows per topic and key over a feed that lose no late record. Every batch adds up
    its records by key and stretch of time as long as the gap (records inside one are never further
    apart, so they are of one session) and writes these as segments. Segments of any batches, in any
    order, merge to the same sessions (:func:`sessions`), so a late record may join two of them."""
    width = analytics.interval_seconds(gap) * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        own = analytics.session_segments(batch, "timestamp", _SESSION_KEYS)
        (own.groupBy(*_SESSION_KEYS, F.floor(F.unix_micros("_first") / width).alias("_stretch"))
         .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("n").alias("n")).drop("_stretch")
         .write.mode("overwrite").parquet(f"{table_path}/segments/batch={batch_id}"))

    _run_batches(records, write, checkpoint)


_SESSION_KEYS = ["topic", "key"]
_SEGMENTS = "topic string, key binary, _first timestamp, _last timestamp, n long"


def sessions(spark: SparkSession, table_path: str, gap: str) -> DataFrame:
    """The sessions of all records so far: ``topic, key, session_start, last_event, n``. The last
    sessions of a key are open: later records may go on with them."""
    merged = analytics.merge_sessions(_batch_table(spark, f"{table_path}/segments", _SEGMENTS), gap, _SESSION_KEYS)
    return merged.select(*_SESSION_KEYS, F.col("_first").alias("session_start"), F.col("_last").alias("last_event"), "n")


def ingest_stream(spark: SparkSession, log: TopicLog, table_path: str, checkpoint: str,
                  topics: list[str] | None = None) -> DataFrame:
    """Exactly-once ingestion of the log into a table partitioned like it."""
    run_available_now(stream_records(spark, log, topics), table_path, checkpoint,
                      partition_by=["topic", "partition"])
    return spark.read.schema(LOG_SCHEMA).parquet(table_path).select(*LOG_SCHEMA.fieldNames())


def event_type_counts(records: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Tumbling-window counts per event type with a watermark, for live feeds whose records
    come in event-time order within ``delay``: in append mode a window is emitted once the
    watermark passes its end, and later records are dropped. For a backlog, or where every
    record must count, use :func:`window_counts_into`."""
    typed = records.select(F.col("timestamp"),
                           F.get_json_object(codec.wire_payload_text(F.col("message")),
                                             "$.event_type").alias("event_type"))
    return (typed.withWatermark("timestamp", delay)
            .groupBy(F.window("timestamp", width).alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "event_type", "n"))


def dedup_records(records: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop redelivered copies of a record (same topic, partition, offset) of a live feed whose
    records arrive within the watermark delay; state for a record is dropped once the
    watermark passes, and records later than that are lost. :func:`dedup_into` loses none."""
    return (records.withWatermark("timestamp", delay)
            .dropDuplicatesWithinWatermark(["topic", "partition", "offset"]))


def _last_of_keys(records: DataFrame) -> DataFrame:
    """The last record of every key, tombstones among them."""
    return (records.where(F.col("key").isNotNull()).groupBy("topic", "key")
            .agg(F.max_by(F.struct("partition", "offset", "message"),
                          F.struct("partition", "offset")).alias("_l"))
            .select("topic", "key", "_l.partition", "_l.offset", "_l.message"))


LATEST_BUCKETS = 64
_LATEST = "topic string, key binary, partition int, offset long, message binary, bucket int"


def latest_into(records: DataFrame, table_path: str, checkpoint: str, buckets: int = LATEST_BUCKETS) -> None:
    """Running compaction of a feed into a table of ``buckets`` (by a hash of topic and key).

    A batch finds its own last record of every key, merges it with the buckets that hold such keys,
    and writes those buckets only, as a new version; then it writes a pointer: which version of
    every bucket is the current one. Readers (:func:`latest_table`) follow the newest complete
    pointer, so they see a whole table at any moment, also in the middle of a batch or after one that
    broke off. A batch that is run again after its pointer was written changes nothing. Tombstones
    stay in the buckets, so an older record that arrives late does not come back.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        newest, version = _pointer(s, table_path)
        if newest is not None and newest >= batch_id:
            return
        bucket = F.pmod(F.xxhash64("topic", "key"), F.lit(buckets)).cast("int")
        own = _last_of_keys(batch).withColumn("bucket", bucket).checkpoint(eager=True)
        changed = sorted(r.bucket for r in own.select("bucket").distinct().collect())  # at most ``buckets``
        held = [f"{table_path}/data/version={version[b]}/bucket={b}" for b in changed if b in version]
        both = own
        if held:
            old = s.read.schema(_LATEST).option("basePath", f"{table_path}/data").parquet(*held)
            both = own.unionByName(old.select(*own.columns))
        (_last_of_keys(both).withColumn("bucket", bucket).repartition(max(len(changed), 1), "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{table_path}/data/version={batch_id}"))
        now = {**version, **dict.fromkeys(changed, batch_id)}
        (s.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1)
         .write.mode("overwrite").parquet(f"{table_path}/pointers/{batch_id}"))

    _run_batches(records, write, checkpoint)


def _pointer(spark: SparkSession, table_path: str) -> tuple[int | None, dict[int, int]]:
    """The newest complete pointer: its batch, and the version of every bucket."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/pointers")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None, {}
    done = [int(f.getPath().getName()) for f in fs.listStatus(path) if f.getPath().getName().isdigit()
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    if not done:
        return None, {}
    rows = spark.read.schema("bucket int, version long").parquet(f"{table_path}/pointers/{max(done)}").collect()
    return max(done), {r.bucket: r.version for r in rows}


def latest_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The compacted table as its newest complete pointer names it: ``topic, key, partition,
    offset, message`` of the keys that no tombstone deletes."""
    _, version = _pointer(spark, table_path)
    if not version:
        return spark.createDataFrame([], _LATEST).drop("bucket")
    paths = [f"{table_path}/data/version={v}/bucket={b}" for b, v in sorted(version.items())]
    df = spark.read.schema(_LATEST).option("basePath", f"{table_path}/data").parquet(*paths)
    return df.where(F.col("message").isNotNull()).select("topic", "key", "partition", "offset", "message")
