"""Writing records to a topic log, and incremental ingestion out of it.

Layout written: ``records/topic=…/partition=…/``. Records are range-partitioned on
``(topic, partition, offset)`` before the write, so a large topic partition is spread
over several tasks and every file holds one contiguous, sorted offset range: offset
predicates then skip whole files and row groups through Parquet statistics.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small
from ..sources.topiclog import (
    LOG_SCHEMA,
    SCAN_COLUMNS,
    TopicLog,
    footer_aggregates,
    footer_watermarks,
    is_missing_path,
    require_topics,
)
from .islands import offset_intervals, outside, union_intervals
from .offsets import assign_dense


def write_records(records: DataFrame, log: TopicLog, mode: str = "append",
                  max_records_per_file: int = 5_000_000, ranged: bool = False) -> None:
    """Write log records. ``ranged=True`` states that every task of ``records`` already
    holds one contiguous ``(topic, partition, offset)`` range (output of
    :func:`assign_dense`), which saves the range shuffle; rows are still sorted in-task."""
    cols = LOG_SCHEMA.fieldNames()
    keys = [F.col("topic"), F.col("partition"), F.col("offset")]
    df = records.select(*cols)
    if not ranged:
        df = df.repartitionByRange(*keys)
    (df.sortWithinPartitions(*keys)
     .write.mode(mode)
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy("topic", "partition")
     .parquet(log.records_path))


@contextmanager
def _task_per_file(spark):
    """Each input file smaller than a split is read by a task of its own. Restores the setting after."""
    key = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, spark.conf.get("spark.sql.files.maxPartitionBytes"))
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def write_topic(numbered: DataFrame, values: dict[str, Column], log: TopicLog, topic: str,
                max_records_per_file: int = 5_000_000) -> None:
    """Write a whole topic anew from ``numbered``, rows with ``partition`` and ``offset`` whose
    files hold one contiguous range each (:func:`assign_dense` with ``keep``). ``values`` are the
    record's other columns. The rows are sorted before these are built, so nothing wide is
    sorted, shuffled or kept."""
    cols = [f for f in LOG_SCHEMA.fields if f.name != "topic"]
    out = numbered.sortWithinPartitions("partition", "offset").select(
        *[(values[f.name] if f.name in values else F.col(f.name)).cast(f.dataType).alias(f.name) for f in cols])
    with _task_per_file(numbered.sparkSession):
        (out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).option("compression", "zstd")
         .partitionBy("partition").parquet(f"{log.records_path}/topic={topic}"))


def default_partition(key: F.Column, n: F.Column, spread: F.Column) -> F.Column:
    """Partition for a record without one: ``crc32(key) mod n``; NULL keys spread by
    ``spread`` (a hash of the record) so they do not pile onto one partition."""
    return F.when(key.isNotNull(), F.pmod(F.crc32(key), n)).otherwise(F.pmod(spread, n)).cast("int")


def plan_topic_write(spark, log: TopicLog, records: DataFrame, order_cols: list[str],
                     topic: str | None = None) -> DataFrame:
    """Records as they would be appended: partition chosen, offsets dense from ``high``.

    ``records`` has ``key, message`` and optionally ``topic``, ``partition`` and
    ``timestamp``; ``order_cols`` must order records uniquely within a partition, so
    numbering is reproducible. Offsets continue at each partition's current ``high``
    (0 for an empty partition) without gaps. A record whose topic is NULL or not in the
    catalogue, or whose partition the topic lacks, fails the write; none is dropped.
    """
    if topic is not None:
        require_topics(spark, log, [topic])
    df = records
    if topic is not None:
        df = df.withColumn("topic", F.lit(topic))
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.current_timestamp())
    cat = log.catalog(spark).select("topic", F.col("partitions").alias("_n"))
    df = df.join(broadcast_if_small(cat), "topic", "left")
    spread = F.xxhash64(*[F.col(c) for c in order_cols])
    part = default_partition(F.col("key"), F.col("_n"), spread)
    if "partition" in df.columns:
        part = F.coalesce(F.col("partition").cast("int"), part)
    wrong = (F.when(F.col("topic").isNull(), F.lit("record without a topic"))
             .when(F.col("_n").isNull(), F.concat(F.lit("unknown topic '"), F.col("topic"), F.lit("'")))
             .when(part.isNull() | (part < 0) | (part >= F.col("_n")),
                   F.concat(F.lit("topic '"), F.col("topic"), F.lit("' has no partition "), part.cast("string"))))
    # the partition is what offsets are numbered by, so the check cannot be pruned
    df = df.withColumn("partition", F.when(wrong.isNull(), part).otherwise(
        F.raise_error(F.concat(F.lit("Error: cannot write: "), wrong)).cast("int"))).drop("_n")
    if topic is not None:  # one known topic: its watermarks come from file footers
        highs = footer_watermarks(spark, log, [topic])
    else:
        highs = footer_watermarks(spark, log)
    highs = highs.select("topic", "partition", F.col("high").alias("base"))
    out = assign_dense(df, ["topic", "partition"], order_cols, "offset", base=highs)
    return out.select(*LOG_SCHEMA.fieldNames())


def to_topic(spark, log: TopicLog, records: DataFrame, order_cols: list[str],
             topic: str | None = None, write_id: str | None = None) -> DataFrame:
    """Append ``records`` to the log (single writer) and return what was written.

    Without ``write_id`` the planned records are checkpointed, then appended. With
    ``write_id`` the plan is first written to a staging table ``<log>/staging/<write_id>``
    (a write-ahead record in the shared folder). Only staged records the log does not
    hold yet are appended. A retry after a driver failure, even one in the middle of the
    append's commit, re-reads the same staged offsets and completes the write exactly
    once instead of planning new offsets.
    """
    if write_id is None:
        planned = plan_topic_write(spark, log, records, order_cols, topic).checkpoint(eager=True)
        write_records(planned, log, mode="append", ranged=True)
        return planned
    staging = f"{log.root}/staging/{write_id}"
    planned = _read_staged(spark, staging)
    if planned is None:
        plan = plan_topic_write(spark, log, records, order_cols, topic)
        write_records(plan, TopicLog(staging), mode="overwrite", ranged=True)
        spark.createDataFrame([(write_id,)], "write_id string").coalesce(1).write.mode("overwrite").json(
            f"{staging}/_staged")
        planned = _read_staged(spark, staging)
    write_records(_not_in_log(spark, log, planned), log, mode="append")
    return planned


def _read_staged(spark, staging: str) -> DataFrame | None:
    try:
        if spark.read.json(f"{staging}/_staged").count() != 1:
            return None
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return None
    return TopicLog(staging).records(spark)


def _not_in_log(spark, log: TopicLog, planned: DataFrame) -> DataFrame:
    """Staged records missing from the log. The log side is cut to the staged partitions
    and to offsets at or above the smallest staged offset (literals, pushed to Parquet),
    so a first attempt reads nothing but footers and row-group statistics."""
    lo = planned.agg(F.min("offset")).first()[0]
    if lo is None:
        return planned
    topics = broadcast_if_small(planned.select("topic").distinct())
    try:
        present = (log.records(spark).where(F.col("offset") >= F.lit(int(lo))).select("topic", "partition", "offset")
                   .join(topics, "topic", "left_semi"))
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return planned  # the log has no records yet
    return planned.join(present, ["topic", "partition", "offset"], "left_anti")


# ------------------------------------------------------------------------- ingestion


def pending_records(log_records: DataFrame, table: DataFrame, topics: list[str] | None = None) -> DataFrame:
    """Log records not yet in ``table``, exactly once by offset: those outside the offset
    intervals that the table holds, so a hole that a broken append left is found as well."""
    src = log_records if topics is None else log_records.where(F.col("topic").isin(topics))
    return outside(src, offset_intervals(table).checkpoint(eager=True))


_COMMITS = "topic string, partition int, lo long, hi long"


def committed_intervals(spark, table_path: str) -> DataFrame:
    """The offsets that an ingested table holds, as merged intervals."""
    held, found = _held_offsets(spark, table_path)
    return held if found is None else held.unionByName(found)


def _held_offsets(spark, table_path: str) -> tuple[DataFrame, DataFrame | None]:
    """Intervals from commit records, and those that had to be read from the table itself.

    Every append leaves a commit record (its intervals) beside the table. A partition is taken
    from these records when they count as many offsets as the table's file footers count
    rows; the offsets of any other partition (an append broke off before its record, or the table
    was written by other means) are read from the table, so nothing is lost or written twice. Fewer
    rows than committed offsets mean a damaged table, which is an error.
    """
    keys = ["topic", "partition"]
    try:
        with footer_aggregates(spark):
            rows = (spark.read.schema(LOG_SCHEMA).parquet(table_path).groupBy(*keys)
                    .agg(F.count(F.lit(1)).alias("_rows")).checkpoint(eager=True))
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        rows = spark.createDataFrame([], "topic string, partition int, _rows long")
    try:
        commits = spark.read.schema(_COMMITS).parquet(f"{table_path}-commits/*")
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        commits = spark.createDataFrame([], _COMMITS)
    commits = union_intervals(commits).checkpoint(eager=True)
    counted = commits.groupBy(*keys).agg(F.sum(F.col("hi") - F.col("lo")).alias("_committed"))
    both = rows.join(counted, keys, "full").select(
        *keys, (F.coalesce("_rows", F.lit(0)) - F.coalesce("_committed", F.lit(0))).alias("_over")).checkpoint(eager=True)
    lost = both.where("_over < 0").orderBy(*keys).first()
    if lost is not None:
        raise ValueError(f"table {table_path} holds {-lost._over} records of {lost.topic}[{lost.partition}] less than were committed")
    known = broadcast_if_small(both.where("_over = 0").select(*keys))
    if both.where("_over > 0").isEmpty():
        return commits, None
    unknown = broadcast_if_small(both.where("_over > 0").select(*keys))
    found = spark.read.schema(LOG_SCHEMA).parquet(table_path).join(unknown, keys, "left_semi")
    return commits.join(known, keys, "left_semi"), offset_intervals(found).checkpoint(eager=True)


def ingest(log_records: DataFrame, table_path: str, spark, topics: list[str] | None = None) -> DataFrame:
    """Append pending records to a Parquet table partitioned like the log; returns them. The
    offsets already held come from commit records (:func:`committed_intervals`), so no data of
    the table is read unless an append broke off. Only a table that does not exist yet counts
    as empty; any other read failure is raised. One writer at a time."""
    src = log_records if topics is None else log_records.where(F.col("topic").isin(topics))
    held, found = _held_offsets(spark, table_path)
    if found is not None:  # an append broke off: what it did write is recorded now
        _record(found, table_path)
        held = held.unionByName(found)
    new = outside(src, held).select(*LOG_SCHEMA.fieldNames()).checkpoint(eager=True)
    if not new.isEmpty():
        new.write.mode("append").partitionBy("topic", "partition").parquet(table_path)
        _record(offset_intervals(new), table_path)
    return new.select(*SCAN_COLUMNS)


def _record(intervals: DataFrame, table_path: str) -> None:
    intervals.write.parquet(f"{table_path}-commits/{uuid.uuid4().hex}")
