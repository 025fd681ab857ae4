"""Analytics operators against brute force on small inputs."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from topiclake.operators import analytics


def test_offset_gaps_bucket_carry_matches_lag(spark, fx):
    recs = fx.log.records(spark).where(F.col("message").isNotNull() & F.col("topic").isin("events", "mixed"))
    got = analytics.offset_gaps(recs, bucket=16)   # many buckets: exercises the carry path
    w = Window.partitionBy("topic", "partition").orderBy("offset")
    want = (recs.withColumn("prev_offset", F.lag("offset").over(w))
            .where(F.col("offset") - F.col("prev_offset") > 1)
            .select("topic", "partition", "prev_offset", "offset",
                    (F.col("offset") - F.col("prev_offset") - 1).alias("missing")))
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_latest_per_key_tombstone_deletes(spark):
    rows = [("t", 0, 0, b"k1", b"a"), ("t", 0, 1, b"k1", None), ("t", 0, 2, b"k2", b"b"),
            ("t", 1, 0, b"k2", b"c"), ("t", 0, 3, None, b"x")]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, message binary")
    got = {bytes(r.key): (r.partition, r.offset, bytes(r.message)) for r in analytics.latest_per_key(df).collect()}
    assert got == {b"k2": (1, 0, b"c")}


def test_tail_uses_group_limit(spark, fx):
    df = analytics.tail_n(fx.log.records(spark), 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert df.groupBy("topic", "partition").count().where(F.col("count") > 5).count() == 0


def test_enrich_broadcasts_small_dimension(spark, fx):
    recs = fx.log.records(spark).where(F.col("topic") == "orders").withColumn("ck", F.col("offset"))
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = analytics.enrich(recs, cust, F.col("ck"), "c_custkey")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_session_counts_over_many_tasks_equal_single_pass(spark, fx):
    from topiclake.operators.analytics import session_counts
    recs = fx.log.records(spark).where(F.col("topic") == "events").withColumn("k", F.hex("key"))
    ref = (recs.groupBy("k", F.session_window(F.col("timestamp"), "30 minutes").alias("w"))
           .agg(F.count("*").alias("n"), F.min("timestamp").alias("s"), F.max("timestamp").alias("l"))
           .select(F.col("s").cast("timestamp_ntz").alias("session_start"),
                   F.col("l").cast("timestamp_ntz").alias("last_event"), "k", "n"))
    for tasks in (1, 7, 60):   # small tasks: keys and sessions lie in several
        got = session_counts(recs, "timestamp", "30 minutes", ["k"], tasks)
        assert got.count() == ref.count()
        assert got.exceptAll(ref.select(*got.columns)).count() == 0


def test_tail_from_log_exact_with_holes(spark, fx, scratch):
    from topiclake.operators import sink
    from topiclake.sources.topiclog import TopicLog
    recs = fx.log.records(spark).where(F.col("topic").isin("events", "orders"))
    # the newest offsets of partition 1 of events are holes: its tail lies below the bound
    holes = (F.col("topic") == "events") & (F.col("partition") == 1) & (F.col("offset") > 100)
    # partition 2 keeps offsets <= 50 and its last one: one candidate above the bound,
    # older records below it, so it must be re-read whole
    top2 = recs.where((F.col("topic") == "events") & (F.col("partition") == 2)).agg(F.max("offset")).first()[0]
    holes = holes | ((F.col("topic") == "events") & (F.col("partition") == 2) & (F.col("offset") > 50)
                     & (F.col("offset") < top2))
    log = TopicLog(f"{scratch}/log")
    sink.write_records(recs.where(~holes), log, mode="overwrite")
    got = analytics.tail_n_from_log(spark, log, 5)
    want = analytics.tail_n(log.records(spark), 5)
    p2 = sorted(r.offset for r in got.where((F.col("topic") == "events") & (F.col("partition") == 2)).collect())
    assert p2 == [47, 48, 49, 50, top2]
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_tail_from_log_window_fallback(spark, fx, monkeypatch):
    monkeypatch.setattr(analytics, "TAIL_LITERAL_PARTITIONS_MAX", 1)
    got = analytics.tail_n_from_log(spark, fx.log, 3)
    want = analytics.tail_n(fx.log.records(spark), 3)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
