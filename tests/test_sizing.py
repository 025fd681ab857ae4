"""The broadcast check bounds rows and bytes."""
from pyspark.sql import functions as F

from topiclake.plans.sizing import broadcast_if_small, is_small


def test_row_bound(spark):
    df = spark.range(100)
    assert is_small(df, max_rows=100) and not is_small(df, max_rows=99)


def test_byte_bound_counts_text(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert is_small(df, max_rows=100, max_bytes=20_000)
    assert not is_small(df, max_rows=100, max_bytes=5_000)


def test_nested_and_empty(spark):
    df = spark.range(5).select(F.array(F.col("id"), F.col("id")).alias("a"), F.struct("id").alias("s"))
    assert is_small(df, max_rows=10, max_bytes=1_000)
    assert is_small(spark.range(0), max_rows=1)


def test_broadcast_hint_only_when_small(spark):
    big = spark.range(1000).select("id", F.repeat(F.lit("y"), 100).alias("t"))
    plan = lambda d: spark.range(10).join(d, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(broadcast_if_small(big))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(broadcast_if_small(big, max_bytes=10_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
