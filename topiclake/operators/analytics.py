"""Analytics over topic records: statistics, compaction, gaps, tails, diffs, windows.

All operators take and return DataFrames in the log's column names. None of them puts
the records of a whole topic partition or key in one task: per-key work is aggregated
partially before the shuffle, ranking uses Spark's per-task group limit, gap detection runs
its window over bounded offset buckets, and sessions are merged over ranges of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small, is_small
from .islands import merge_intervals, offset_intervals, union_intervals

# Offsets per bucket for windowed scans over a partition (bounds a window task).
GAP_BUCKET = 1 << 20
# Partitions up to which tail_n_from_log plans per-topic literal bounds on the driver.
TAIL_LITERAL_PARTITIONS_MAX = 100_000
# Most scan branches of a tail read; beyond it the bounds come from a join.
TAIL_BRANCHES_MAX = 100


def topic_stats(records: DataFrame) -> DataFrame:
    """Per topic partition: records, offset range, NULL keys, tombstones and bytes."""
    return (records.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.min("offset").alias("min_offset"),
                 F.max("offset").alias("max_offset"),
                 F.count_if(F.col("key").isNull()).alias("null_keys"),
                 F.count_if(F.col("message").isNull()).alias("tombstones"),
                 F.coalesce(F.sum(F.length("key").cast("long")), F.lit(0)).alias("key_bytes"),
                 F.coalesce(F.sum(F.length("message").cast("long")), F.lit(0)).alias("message_bytes")))


def topic_rollup(records: DataFrame) -> DataFrame:
    """Record counts per (topic, partition), per topic, and in total."""
    return (records.rollup("topic", "partition")
            .agg(F.count(F.lit(1)).alias("records"), F.grouping_id().alias("level")))


def latest_per_key(records: DataFrame) -> DataFrame:
    """Topic compaction: the last record per key (by partition, offset); a tombstone as
    last record deletes the key. ``max_by`` combines per task before the shuffle, so a
    hot key costs one partial row per task in the exchange. (Its buffer carries the
    binary payload, so Spark plans a sort-based aggregate: the map-side sort spills
    instead of holding all keys in memory.)"""
    keyed = records.where(F.col("key").isNotNull())
    last = (keyed.groupBy("topic", "key")
            .agg(F.max_by(F.struct("partition", "offset", "message"),
                          F.struct("partition", "offset")).alias("_l"))
            .select("topic", "key", "_l.partition", "_l.offset", "_l.message"))
    return last.where(F.col("message").isNotNull())


def offset_gaps(records: DataFrame, bucket: int = GAP_BUCKET) -> DataFrame:
    """Holes in offset sequences: ``(topic, partition, prev_offset, offset, missing)``."""
    points = records.select("topic", "partition", "offset", F.lit(True).alias("_starts"))
    return _gaps(points, bucket)


def _gaps(points: DataFrame, bucket: int) -> DataFrame:
    """Holes before the points that ``_starts`` marks.

    ``lag`` runs per ``(topic, partition, offset div bucket)``, so a window task never
    holds more than ``bucket`` offsets; the first row of each bucket takes its
    predecessor from the previous non-empty bucket's maximum (a small aggregate).
    """
    b = points.withColumn("_b", F.floor(F.col("offset") / bucket))
    w = Window.partitionBy("topic", "partition", "_b").orderBy("offset")
    local = b.withColumn("prev_offset", F.lag("offset").over(w))
    bmax = b.groupBy("topic", "partition", "_b").agg(F.max("offset").alias("_bmax"))
    wb = Window.partitionBy("topic", "partition").orderBy("_b")
    carry = bmax.withColumn("_carry", F.lag("_bmax").over(wb)).select("topic", "partition", "_b", "_carry")
    # one row per non-empty bucket: broadcast (size-checked), joined in the same pass
    joined = local.join(broadcast_if_small(carry), ["topic", "partition", "_b"], "left")
    joined = joined.withColumn("prev_offset", F.coalesce(F.col("prev_offset"), F.col("_carry")))
    return (joined.where(F.col("_starts") & (F.col("offset") - F.col("prev_offset") > 1))
            .select("topic", "partition", "prev_offset", "offset",
                    (F.col("offset") - F.col("prev_offset") - 1).alias("missing")))


def offset_gaps_from_log(spark, log, topics: list[str] | None = None, bucket: int = GAP_BUCKET) -> DataFrame:
    """The holes of a log, from its file index: a file that holds as many records as its bounds
    span is one interval; only the offset column of the other files is read."""
    from ..sources.fileindex import file_index
    from ..sources.topiclog import LOG_SCHEMA
    index = file_index(spark, log, topics).checkpoint(eager=True)
    whole = F.col("n") == F.col("hi") - F.col("lo") + 1
    intervals = index.where(whole).select("topic", "partition", "lo", (F.col("hi") + 1).alias("hi"))
    holed = [r.path for r in index.where(~whole).select("path").collect()]  # file names
    if holed:
        recs = spark.read.schema(LOG_SCHEMA).option("basePath", log.records_path).parquet(*holed)
        intervals = intervals.unionByName(offset_intervals(recs))
    merged = union_intervals(intervals).checkpoint(eager=True)
    starts = merged.select("topic", "partition", F.col("lo").alias("offset"), F.lit(True).alias("_starts"))
    ends = merged.where(F.col("hi") - F.col("lo") > 1).select("topic", "partition", (F.col("hi") - 1).alias("offset"),
                                                              F.lit(False).alias("_starts"))
    return _gaps(starts.unionByName(ends), bucket)


def tail_n(records: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` records of every partition. ``row_number() <= n`` over a
    descending offset order is planned with a per-task group limit before the shuffle,
    so at most ``n`` rows per partition and task are exchanged."""
    w = Window.partitionBy("topic", "partition").orderBy(F.col("offset").desc())
    return (records.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn"))


def tail_n_from_log(spark, log, n: int, topics: list[str] | None = None) -> DataFrame:
    """Exact newest ``n`` records per partition, reading little more than the tail.

    Watermarks come from file footers; each group of partitions with like highs is scanned
    with ``offset >= high - n`` as a literal, so files and row groups below the tail are
    skipped. Offsets may
    have holes, so a partition that yields fewer than ``n`` candidates while holding older
    records is re-read whole (only that partition), which keeps the result exact.
    """
    from ..sources.topiclog import footer_watermarks
    recs = log.records(spark)
    wm_df = footer_watermarks(spark, log, topics)
    if not is_small(wm_df, TAIL_LITERAL_PARTITIONS_MAX):   # very many partitions: exact window plan
        src = recs if topics is None else recs.where(F.col("topic").isin(topics))
        return tail_n(src, n)
    wm = wm_df.collect()                                       # one row per partition
    if not wm:
        return recs.limit(0)
    # Partitions of a topic whose highs lie within n of each other share a branch and its bound,
    # so no partition yields more than 2 n offsets, however idle or busy its neighbours are.
    groups: list[tuple[str, int, list[int]]] = []
    for r in sorted(wm, key=lambda r: (r.topic, r.high)):
        if groups and groups[-1][0] == r.topic and r.high - n - groups[-1][1] <= n:
            groups[-1][2].append(r.partition)
        else:
            groups.append((r.topic, max(0, r.high - n), [r.partition]))
    if len(groups) > TAIL_BRANCHES_MAX:                       # the same bounds by a join
        high = broadcast_if_small(wm_df.select("topic", "partition", "high"))
        cand = recs.join(high, ["topic", "partition"]).where(F.col("offset") >= F.col("high") - n).drop("high")
    else:
        cand = None
        for topic, bound, parts in groups:
            part = recs.where((F.col("topic") == F.lit(topic)) & F.col("partition").isin(parts)
                              & (F.col("offset") >= F.lit(bound)))
            cand = part if cand is None else cand.unionByName(part)
    head = tail_n(cand, n).checkpoint(eager=True)                 # at most n rows per partition
    have = {(r.topic, r.partition): r.c for r in head.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("c")).collect()}
    short = [(r.topic, r.partition) for r in wm if have.get((r.topic, r.partition), 0) < n and r.low < r.high - n]
    if not short:
        return head
    key = F.struct("topic", "partition")
    wanted = [F.struct(F.lit(t), F.lit(int(p))) for t, p in short]
    redo = tail_n(recs.where(key.isin(wanted)), n)
    return head.where(~key.isin(wanted)).unionByName(redo)


def snapshot_diff(newer: DataFrame, older: DataFrame) -> DataFrame:
    """Records in ``newer`` that ``older`` lacks (by topic, partition, offset)."""
    return newer.join(older.select("topic", "partition", "offset"), ["topic", "partition", "offset"], "left_anti")


# Offsets per fingerprint; and differing buckets up to which their bounds become literal filters.
FINGERPRINT_BUCKET = 1 << 16
LITERAL_BUCKETS_MAX = 500


def fingerprints(records: DataFrame, bucket: int = FINGERPRINT_BUCKET) -> DataFrame:
    """``topic, partition, bucket, n, mark``: per range of ``bucket`` offsets the number of records
    and an order-free sum of their hashes (offset, key, message). Combined inside tasks; kept with a
    snapshot, it tells later which ranges changed."""
    return (records.groupBy("topic", "partition", F.floor(F.col("offset") / bucket).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.xxhash64("offset", "key", "message").cast("decimal(38,0)")).alias("mark")))


def snapshot_changes(newer: DataFrame, older: DataFrame, newer_marks: DataFrame | None = None,
                     older_marks: DataFrame | None = None, bucket: int = FINGERPRINT_BUCKET) -> DataFrame:
    """What differs between two states of a log: ``topic, partition, offset, change`` with
    ``added``, ``removed`` or ``changed`` (another key or message at the same offset).

    Ranges of offsets whose fingerprints agree are not read: the others become literal partition
    and offset filters while they are few, else a join on the range. Fingerprints that were kept with
    the snapshots spare the pass over their records."""
    at = ["topic", "partition", "bucket"]
    a = fingerprints(newer, bucket) if newer_marks is None else newer_marks
    b = fingerprints(older, bucket) if older_marks is None else older_marks
    b = b.select(*at, F.col("n").alias("_n"), F.col("mark").alias("_mark"))
    differ = (a.join(b, at, "full").where(~(F.col("n").eqNullSafe(F.col("_n")) & F.col("mark").eqNullSafe(F.col("_mark"))))
              .select(*at).checkpoint(eager=True))
    listed = differ.limit(LITERAL_BUCKETS_MAX + 1).collect()

    def changed_part(df: DataFrame) -> DataFrame:
        df = df.select("topic", "partition", "offset", "key", "message")
        if len(listed) > LITERAL_BUCKETS_MAX:
            df = df.withColumn("bucket", F.floor(F.col("offset") / bucket))
            return df.join(broadcast_if_small(differ), at, "left_semi").drop("bucket")
        keep = F.lit(False)
        for r in listed:
            keep = keep | ((F.col("topic") == r.topic) & (F.col("partition") == r.partition)
                           & (F.col("offset") >= r.bucket * bucket) & (F.col("offset") < (r.bucket + 1) * bucket))
        return df.where(keep)

    key = ["topic", "partition", "offset"]
    new = changed_part(newer).select(*key, F.struct("key", "message").alias("_new"))
    old = changed_part(older).select(*key, F.struct("key", "message").alias("_old"))
    change = (F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
              .when(~F.col("_new").eqNullSafe(F.col("_old")), "changed"))
    return new.join(old, key, "full").select(*key, change.alias("change")).where(F.col("change").isNotNull())


def enrich(records: DataFrame, dim: DataFrame, left_key: Column, dim_key: str) -> DataFrame:
    """Join records to a dimension table; broadcast only when a bounded count proves the
    dimension small, else a shuffle join (AQE splits skewed keys)."""
    d = broadcast_if_small(dim)
    return records.join(d, left_key == d[dim_key], "inner")


# ------------------------------------------------------------------- event-time windows


def _ts(col: str) -> Column:
    return F.col(col).cast("timestamp")


def tumbling_counts(df: DataFrame, ts: str, width: str, by: list[str]) -> DataFrame:
    g = df.groupBy(F.window(_ts(ts), width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by, "n")


def sliding_counts(df: DataFrame, ts: str, width: str, slide: str, by: list[str]) -> DataFrame:
    g = df.groupBy(F.window(_ts(ts), width, slide).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *by, "n")


def session_counts(df: DataFrame, ts: str, gap: str, by: list[str], num_partitions: int | None = None) -> DataFrame:
    """Session windows (a new session starts when the gap to the previous event of the
    key is at least ``gap``): ``session_start, last_event, *by, n``. Events without a time are
    in no session.

    The events of a key are spread over tasks by ranges of time, whatever their number; each
    task builds its sessions, and only the sessions at the edges of tasks are joined
    (:mod:`topiclake.operators.islands`).
    """
    return _as_sessions(merge_sessions(session_segments(df, ts, by), gap, by, num_partitions), by)


def session_segments(df: DataFrame, ts: str, by: list[str]) -> DataFrame:
    """Events as sessions of one moment: ``*by, _first, _last, n``."""
    return df.select(*by, _ts(ts).alias("_first")).where(F.col("_first").isNotNull()).select(
        *by, "_first", F.col("_first").alias("_last"), F.lit(1).cast("long").alias("n"))


def merge_sessions(segments: DataFrame, gap: str, by: list[str], num_partitions: int | None = None) -> DataFrame:
    """Sessions out of parts of sessions, in any order and overlapping or not."""
    gap_s = F.expr(f"INTERVAL {gap}")
    return merge_intervals(segments, by, "_first", "_last", lambda first, reached: first < reached + gap_s, ["n"],
                           num_partitions)


def _as_sessions(merged: DataFrame, by: list[str]) -> DataFrame:
    return merged.select(F.col("_first").cast("timestamp_ntz").alias("session_start"),
                         F.col("_last").cast("timestamp_ntz").alias("last_event"), *by, "n")


def interval_seconds(text: str) -> int:
    n, unit = text.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult
