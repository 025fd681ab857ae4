"""Merging intervals per group without putting a group in one task.

Sessions of a key, the offsets a table holds and the offsets a feed has seen are one problem:
intervals of a group are merged while each joins what the ones before it reach. A group may
hold a third of all rows, so a window over the group would stall the job. Instead:

1. equal starts of a group are combined (map-side first), then ``repartitionByRange`` on
   ``(group, start)`` gives every task one contiguous range of starts; the frame is
   checkpointed, so task boundaries are fixed for all passes and survive lost executors;
2. how far a group has reached before a task (a running maximum over the small table of
   ``(task, group)`` rows) is joined to the tasks that go on with a group: at most one group
   a task, so this side has no more rows than there are tasks;
3. each task merges its own intervals, its first ones with what was reached before;
4. only groups that lie in several tasks have pieces to join: a prefix sum over tasks
   numbers their stretches, and equal numbers are added up.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small

# Offsets per key of the join that finds records inside or outside of intervals.
OFFSET_BUCKET = 1 << 20


def _same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    return functools.reduce(operator.and_, [a[c].eqNullSafe(b[c]) for c in cols])


def _renamed(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` with ``cols`` under names of their own, for null-safe joins on them."""
    for c in cols:
        df = df.withColumnRenamed(c, f"_r_{c}")
    return df


def _join(a: DataFrame, b: DataFrame, cols: list[str], how: str) -> DataFrame:
    b = broadcast_if_small(_renamed(b, cols))
    on = functools.reduce(operator.and_, [a[c].eqNullSafe(b[f"_r_{c}"]) for c in cols])
    return a.join(b, on, how).drop(*[f"_r_{c}" for c in cols])


def merge_intervals(df: DataFrame, by: list[str], start: str, end: str,
                    joins: Callable[[Column, Column], Column], sums: list[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """``by, start, end`` and the ``sums`` of the merged intervals of every group.

    ``joins(start, reached)`` says whether an interval goes on with a stretch that has reached
    ``reached`` (the largest end so far). Starts and ends are not NULL; NULL group values are a
    group of their own.
    """
    sums = sums or []
    one = df.groupBy(*by, start).agg(F.max(end).alias(end), *[F.sum(c).alias(c) for c in sums])
    keys = [F.col(c) for c in [*by, start]]
    ranged = one.repartitionByRange(num_partitions, *keys) if num_partitions else one.repartitionByRange(*keys)
    ranged = ranged.withColumn("_task", F.spark_partition_id()).checkpoint(eager=True)
    pieces = ranged.groupBy("_task", *by).agg(F.max(end).alias("_reach"))
    before = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carried = (pieces.withColumn("_carry", F.max("_reach").over(before)).where(F.col("_carry").isNotNull())
               .select("_task", *by, "_carry").checkpoint(eager=True))
    rows = _join(ranged, carried, ["_task", *by], "left")
    inside = Window.partitionBy("_task", *by).orderBy(start)
    so_far = F.greatest(F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    rows = rows.withColumn("_so_far", so_far)
    rows = rows.withColumn("_new", F.when(F.col("_so_far").isNotNull() & joins(F.col(start), F.col("_so_far")), 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    added = [F.min(start).alias(start), F.max(end).alias(end), *[F.sum(c).alias(c) for c in sums]]
    stretches = rows.groupBy("_task", *by, "_island").agg(*added, F.sum("_new").alias("_new")).checkpoint(eager=True)
    split = carried.select(*by).distinct()
    whole = _join(stretches, split, by, "left_anti").select(*by, start, end, *sums)
    parts = _join(stretches, split, by, "left_semi")
    opened = parts.groupBy("_task", *by).agg(F.sum("_new").alias("_opened"))
    base = opened.withColumn("_base", F.coalesce(F.sum("_opened").over(before), F.lit(0))).drop("_opened")
    joined = _join(parts, base, ["_task", *by], "inner").withColumn("_island", F.col("_island") + F.col("_base"))
    joined = joined.groupBy(*by, "_island").agg(*added).select(*by, start, end, *sums)
    return whole.unionByName(joined)


# ------------------------------------------------------------------------- offset sets


def offset_intervals(records: DataFrame) -> DataFrame:
    """The offsets of ``records`` as merged half-open intervals ``topic, partition, lo, hi``."""
    one = records.select("topic", "partition", F.col("offset").alias("lo"), (F.col("offset") + 1).alias("hi"))
    return merge_intervals(one, ["topic", "partition"], "lo", "hi", lambda lo, reached: lo <= reached)


def union_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals of several sets as one merged set."""
    return merge_intervals(intervals.select("topic", "partition", "lo", "hi"), ["topic", "partition"], "lo", "hi",
                           lambda lo, reached: lo <= reached)


def outside(records: DataFrame, intervals: DataFrame, bucket: int = OFFSET_BUCKET) -> DataFrame:
    """Records whose offset lies in none of the intervals: an equi-join on
    ``(topic, partition, offset bucket)`` with the bounds as a residual, so a partition of any
    size is spread over its buckets."""
    held = intervals.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / bucket), F.floor((F.col("hi") - 1) / bucket))).alias("_b"))
    held = broadcast_if_small(held)
    at = F.floor(records["offset"] / bucket)
    inside = ((records["topic"] == held["_t"]) & (records["partition"] == held["_p"]) & (at == held["_b"])
              & (records["offset"] >= held["lo"]) & (records["offset"] < held["hi"]))
    return records.join(held, inside, "left_anti")
