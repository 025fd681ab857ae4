"""Dense offsets, partitioners, appends and incremental ingestion."""
import glob

import pyarrow.parquet as pq
from pyspark.sql import Window
from pyspark.sql import functions as F

from topiclake.operators import sink
from topiclake.operators.offsets import assign_dense
from topiclake.sources import topiclog as tl
from topiclake.sources.topiclog import TopicLog


def test_assign_dense_matches_row_number_with_a_hot_group(spark):
    # one group holds ~1/3 of the rows and is split over several tasks
    base = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") % 17) + 1).cast("int").alias("g"),
        (F.col("id") * 7919 % 100003).alias("k"))
    got = assign_dense(base, ["g"], ["k"], "n", num_partitions=12)
    want = base.withColumn("n", (F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).cast("long"))
    assert got.select("g", "k", "n").exceptAll(want.select("g", "k", "n")).count() == 0
    assert got.count() == want.count()
    spread = got.where(F.col("g") == 0).select(F.spark_partition_id()).distinct().count()
    assert spread > 1


def test_assign_dense_with_base(spark):
    df = spark.createDataFrame([(0, 5), (0, 3), (1, 9)], "p int, k int")
    base = spark.createDataFrame([(0, 100)], "p int, base long")
    got = {(r.p, r.k): r.o for r in assign_dense(df, ["p"], ["k"], "o", base=base).collect()}
    assert got == {(0, 3): 100, (0, 5): 101, (1, 9): 0}


def _copy_log(spark, fx, root):
    log = TopicLog(root)
    sink.write_records(fx.log.records(spark).where(F.col("topic") == "orders"), log, mode="overwrite")
    fx.log.catalog(spark).write.mode("overwrite").parquet(log.catalog_path)
    return log


def test_to_topic_appends_dense_offsets(spark, fx, scratch):
    log = _copy_log(spark, fx, scratch)
    before = {r.partition: r.high for r in tl.partition_watermarks(log.records(spark)).collect()}
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    new = o.select(F.col("o_orderkey"), F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("key"),
                   F.encode(F.col("o_orderstatus"), "UTF-8").alias("message"))
    written = sink.to_topic(spark, log, new, ["o_orderkey"], topic="orders")
    after = log.records(spark).where(F.col("topic") == "orders")
    assert after.count() == 2 * o.count()
    for r in written.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                              F.count("*").alias("n")).collect():
        assert r.lo == before[r.partition] and r.hi == r.lo + r.n - 1
    # crc32 partitioner: same key, same partition
    keyed = written.select(F.col("key"), "partition").distinct()
    assert keyed.groupBy("key").count().where(F.col("count") > 1).count() == 0


def test_null_keys_spread(spark, fx):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    recs = o.select("o_orderkey", F.lit(None).cast("binary").alias("key"), F.lit(b"v").alias("message"))
    planned = sink.plan_topic_write(spark, fx.log, recs, ["o_orderkey"], topic="orders")
    assert planned.select("partition").distinct().count() == 8


def test_pending_records_exactly_once(spark, fx, scratch):
    recs = fx.log.records(spark).where(F.col("topic") == "events")
    table = f"{scratch}/table"
    first = sink.ingest(recs.where(F.col("offset") < 50), table, spark)
    second = sink.ingest(recs, table, spark)
    third = sink.ingest(recs, table, spark)
    assert third.count() == 0
    assert first.count() + second.count() == recs.count()
    assert spark.read.parquet(table).count() == recs.count()


def test_to_topic_with_write_id_completes_exactly_once(spark, fx, scratch):
    log = _copy_log(spark, fx, scratch)
    base = log.records(spark).count()
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    new = o.select("o_orderkey", F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("key"),
                   F.encode(F.col("o_orderstatus"), "UTF-8").alias("message"))
    # an earlier attempt staged its plan and got half of it into the log before failing
    plan = sink.plan_topic_write(spark, log, new, ["o_orderkey"], topic="orders")
    staging = f"{log.root}/staging/w1"
    sink.write_records(plan, TopicLog(staging), mode="overwrite", ranged=True)
    spark.createDataFrame([("w1",)], "write_id string").write.mode("overwrite").json(f"{staging}/_staged")
    staged = TopicLog(staging).records(spark)
    sink.write_records(staged.where(F.col("partition") < 4), log, mode="append")
    # the retry appends only what is missing; a further retry appends nothing
    sink.to_topic(spark, log, new, ["o_orderkey"], topic="orders", write_id="w1")
    sink.to_topic(spark, log, new, ["o_orderkey"], topic="orders", write_id="w1")
    after = log.records(spark)
    assert after.count() == base + o.count()
    assert after.groupBy("partition", "offset").count().where(F.col("count") > 1).count() == 0
    assert staged.select("partition", "offset").exceptAll(after.select("partition", "offset")).count() == 0


def test_topic_written_from_kept_rows(spark, scratch):
    """Rows of a table are numbered once, kept narrow, and become sorted files of one offset range each."""
    rows = spark.range(5000).select((F.col("id") % 3).cast("int").alias("partition"), (F.hash("id") % 700).alias("a"), "id")
    numbered = assign_dense(rows, ["partition"], ["a", "id"], "offset", num_partitions=7, keep=f"{scratch}/rows")
    assert set(spark.read.parquet(f"{scratch}/rows").columns) == {"partition", "a", "id", "_dn_mid"}
    log = TopicLog(f"{scratch}/log")
    key, none = F.col("id").cast("string").cast("binary"), F.lit(None)
    for topic in ("t", "u"):
        sink.write_topic(numbered, {"key": key, "message": none, "timestamp": F.timestamp_seconds("id")}, log, topic)
    want = rows.select("partition", F.col("id").cast("string").alias("k"), (F.row_number().over(
        Window.partitionBy("partition").orderBy("a", "id")) - 1).alias("offset"))
    for topic in ("t", "u"):
        got = log.records(spark).where(F.col("topic") == topic).select("partition", F.col("key").cast("string").alias("k"), "offset")
        assert got.count() == 5000 and got.exceptAll(want).isEmpty()
    files = 0
    for p in range(3):
        ranges = []
        for f in glob.glob(f"{scratch}/log/records/topic=t/partition={p}/*.parquet"):
            offsets = pq.read_table(f, columns=["offset"], partitioning=None).column(0).to_pylist()
            assert offsets == list(range(offsets[0], offsets[0] + len(offsets)))
            ranges.append(offsets[0])
        files += len(ranges)
    assert 3 < files <= 9
    assert spark.conf.get("spark.sql.files.openCostInBytes") in ("4194304", "4194304b")
