"""Merged intervals, sessions of hot keys, offset sets, broken appends and bucketed compaction."""
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from topiclake.operators import analytics, islands, sink
from topiclake.sources.topiclog import LOG_SCHEMA, TopicLog
from topiclake.streaming import feeds


def brute_merge(rows, joins):
    out = {}
    for k, a, b in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        s = out.setdefault(k, [])
        if s and joins(a, s[-1][1]):
            s[-1] = [s[-1][0], max(s[-1][1], b), s[-1][2] + 1]
        else:
            s.append([a, b, 1])
    return sorted(((k, *x) for k, v in out.items() for x in v), key=str)


@pytest.mark.parametrize("tasks", [1, 5, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_brute_force(spark, tasks, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(600):  # the NULL group holds a third of all rows; some intervals span many others
        k = rng.choice([None, None, "a", "b", "c", "dd"])
        a = rng.randrange(0, 3000)
        rows.append((k, a, a + rng.choice([1, 1, 1, 4, 30, 700 if rng.random() < 0.02 else 2])))
    df = spark.createDataFrame(rows, "k string, lo long, hi long").withColumn("n", F.lit(1)).repartition(4)
    got = islands.merge_intervals(df, ["k"], "lo", "hi", lambda lo, reached: lo <= reached + 2, ["n"], tasks)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_merge(rows, lambda a, r: a <= r + 2)


def test_sessions_of_a_hot_key_are_spread(spark):
    base = datetime(2024, 1, 1)
    rows = [(None, base + timedelta(minutes=7 * i if i < 3000 else 7 * i + 40)) for i in range(6000)]  # two sessions
    rows += [("a", base + timedelta(hours=i)) for i in range(50)] + [("b", None)] + [("c", base)] * 500
    df = spark.createDataFrame(rows, "k string, t timestamp").repartition(4)
    out = analytics.session_counts(df, "t", "30 minutes", ["k"], 16)
    got = out.orderBy("k", "session_start").collect()
    assert [(r.k, r.n) for r in got] == [(None, 3000), (None, 3000), *[("a", 1)] * 50, ("c", 500)]
    ranged = (analytics.session_segments(df, "t", ["k"]).repartitionByRange(16, "k", "_first")
              .groupBy(F.spark_partition_id(), "k").count())
    assert ranged.where("k IS NULL").count() > 8  # the hot key lies in many tasks


def test_offset_intervals_and_outside(spark):
    rows = [("t", 0, o, None, None, None) for o in [*range(5), *range(8, 12), 20]] + [("t", 1, 7, None, None, None)]
    recs = spark.createDataFrame(rows, LOG_SCHEMA)
    iv = islands.offset_intervals(recs)
    assert sorted(tuple(r) for r in iv.collect()) == [("t", 0, 0, 5), ("t", 0, 8, 12), ("t", 0, 20, 21), ("t", 1, 7, 8)]
    more = spark.createDataFrame([("t", p, o, None, None, None) for p in (0, 1, 2) for o in range(25)], LOG_SCHEMA)
    for bucket in (1 << 20, 3):
        left = {(r.partition, r.offset) for r in islands.outside(more, iv, bucket).collect()}
        held = {(p, o) for _, p, o, *_ in rows}
        assert left == {(p, o) for p in (0, 1, 2) for o in range(25)} - held


def test_broken_append_loses_and_repeats_nothing(spark, scratch):
    recs = spark.createDataFrame([("t", p, o, None, b"m", None) for p in range(3) for o in range(40)], LOG_SCHEMA)
    table = f"{scratch}/table"
    assert sink.ingest(recs.where("offset < 10"), table, spark).count() == 30
    # an append that broke off: its highest offsets arrived, lower ones did not, and it left no record
    recs.where("offset >= 30 and partition = 1").write.mode("append").partitionBy("topic", "partition").parquet(table)
    assert sorted(tuple(r)[1:] for r in sink.committed_intervals(spark, table).collect()) == [
        (0, 0, 10), (1, 0, 10), (1, 30, 40), (2, 0, 10)]
    assert sink.ingest(recs, table, spark).count() == 120 - 30 - 10
    got = spark.read.parquet(table).select("partition", "offset")
    assert got.count() == 120 and got.distinct().count() == 120
    assert sink.ingest(recs, table, spark).count() == 0
    _, found = sink._held_offsets(spark, table)
    assert found is None  # all of it is on record now: no data is read again


def test_lost_file_is_an_error(spark, scratch):
    recs = spark.createDataFrame([("t", p, o, None, None, None) for p in range(2) for o in range(4)], LOG_SCHEMA)
    table = f"{scratch}/table"
    sink.ingest(recs, table, spark)
    kept = spark.read.schema(LOG_SCHEMA).parquet(table).where("partition = 0").checkpoint()
    kept.write.mode("overwrite").partitionBy("topic", "partition").parquet(table)
    with pytest.raises(ValueError, match="less than were committed"):
        sink.ingest(recs, table, spark)


def test_dedup_reads_only_the_last_intervals(spark, scratch):
    """Copies many batches apart, and late offsets below the highest seen."""
    order = [*range(50, 80), *range(0, 20), *range(10, 60), *range(0, 100)]
    for i in range(0, len(order), 25):
        (spark.createDataFrame([("t", 0, o, None, None, None) for o in order[i:i + 25]], LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(f"{scratch}/landing"))
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/landing")
    out = feeds.dedup_into(src, f"{scratch}/table", f"{scratch}/ck")
    assert sorted(r.offset for r in out.collect()) == list(range(100))
    last = max(int(d.split("=")[1]) for d in os.listdir(f"{scratch}/table-offsets") if d.startswith("batch="))
    assert last == -(-len(order) // 25) - 1
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/table-offsets/batch={last}").collect()] == [("t", 0, 0, 100)]


def event(key, o, t, message=b"x"):
    return ("t", 0, o, key, message, t)


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_sessions_equal_batch_in_any_order(spark, scratch, seed):
    base = datetime(2024, 1, 1)
    rng = random.Random(seed)
    rows = [event(rng.choice([None, b"a", b"b"]), i, base + timedelta(minutes=rng.randrange(4000))) for i in range(400)]
    rng.shuffle(rows)  # late records join sessions of earlier batches
    for i in range(0, 400, 80):
        spark.createDataFrame(rows[i:i + 80], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/landing")
    src = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/landing")
    feeds.sessions_into(src, f"{scratch}/table", f"{scratch}/ck", "30 minutes")
    got = feeds.sessions(spark, f"{scratch}/table", "30 minutes").select(
        F.hex("key"), F.col("session_start").cast("timestamp_ntz"), F.col("last_event").cast("timestamp_ntz"), "n")
    want = analytics.session_counts(spark.createDataFrame(rows, LOG_SCHEMA), "timestamp", "30 minutes", ["key"]).select(
        F.hex("key"), "session_start", "last_event", "n")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 10


def test_compaction_writes_changed_buckets_only(spark, scratch):
    log = TopicLog(f"{scratch}/log")
    table, ck = f"{scratch}/table", f"{scratch}/ck"
    first = [event(f"k{i % 40}".encode(), i, None) for i in range(200)]
    sink.write_records(spark.createDataFrame(first, LOG_SCHEMA), log, mode="overwrite")

    def run():
        feeds.latest_into(feeds.stream_records(spark, log), table, ck, buckets=16)
        return {bytes(r.key): r.offset for r in feeds.latest_table(spark, table).collect()}

    want = {f"k{i % 40}".encode(): i for i in range(160, 200)}
    assert run() == want
    sink.write_records(spark.createDataFrame([event(b"k3", 300, None, b"new"), event(b"k5", 301, None, None)], LOG_SCHEMA), log)
    # a version that a broken batch left without a pointer is not seen
    spark.createDataFrame([("t", b"zz", 0, 999, b"m", 0)], feeds._LATEST).write.partitionBy("bucket").parquet(f"{table}/data/version=1")
    assert {bytes(r.key): r.offset for r in feeds.latest_table(spark, table).collect()} == want
    want[b"k3"] = 300
    del want[b"k5"]
    assert run() == want
    assert 1 <= len([d for d in os.listdir(f"{table}/data/version=1") if d.startswith("bucket=")]) <= 2
    # an older record of a deleted key comes late
    sink.write_records(spark.createDataFrame([event(b"k5", 250, None, b"late")], LOG_SCHEMA), log)
    assert run() == want
    assert run() == want  # nothing new


def test_a_whole_table_is_seen_in_the_middle_of_a_batch(spark, scratch):
    table = f"{scratch}/table"
    rows = spark.createDataFrame([("t", f"k{i}".encode(), 0, i, b"m", i % 4) for i in range(20)], feeds._LATEST)
    rows.write.partitionBy("bucket").parquet(f"{table}/data/version=0")
    spark.createDataFrame([(b, 0) for b in range(4)], "bucket int, version long").write.parquet(f"{table}/pointers/0")
    reader = feeds.latest_table(spark, table)
    rows.limit(1).write.partitionBy("bucket").parquet(f"{table}/data/version=1")  # a batch under way
    assert reader.count() == feeds.latest_table(spark, table).count() == 20
