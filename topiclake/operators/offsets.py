"""Dense, gap-free numbering per group without funnelling a group into one task.

``row_number() over (partition by g order by k)`` puts every row of a group in one task;
a group holding a third of all rows would stall the job. Instead:

1. ``repartitionByRange`` on ``(g…, k…)`` splits every group over as many tasks as its
   size needs, each task holding one contiguous key range; rows are sorted inside tasks.
2. ``monotonically_increasing_id`` read right after the sort is ``task << 33 | position``,
   i.e. a row's position inside its task, in key order. The frame is checkpointed into
   the shared folder (or written to ``keep`` as Parquet, which is smaller by far), so task
   boundaries and positions are fixed for both passes below and survive lost executors.
3. A tiny aggregate gives, per ``(task, g…)``, the row count and the first position;
   a window over that small table prefix-sums the counts of earlier tasks of the group.
4. Joined back (broadcast, size-checked): ``number = base + earlier + position - first``.

Only step 1 moves the data; every other step reads it in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_if_small

_POS_BITS = 33


def assign_dense(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str,
                 base: DataFrame | int | None = None, base_col: str = "base",
                 num_partitions: int | None = None, keep: str | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based rank of each row inside its group by ``order_cols``
    (which must be unique within a group), plus the group's ``base`` when given.

    ``base`` is a DataFrame of ``group_cols + [base_col]`` (groups absent from it start
    at 0; one row per group, e.g. per topic partition) or a constant. Meant for few,
    possibly huge groups (topic partitions, or no group at all); for many small groups a
    plain window is the better plan. ``keep`` names a folder of the caller's for the sorted
    rows: one file for each task, rows in key order.
    """
    keys = [F.col(c) for c in [*group_cols, *order_cols]]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    ranged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_dn_mid", F.monotonically_increasing_id()))
    if keep is None:
        ranged = ranged.checkpoint(eager=True)
    else:
        ranged.write.mode("overwrite").option("compression", "zstd").parquet(keep)
        ranged = df.sparkSession.read.schema(ranged.schema).parquet(keep)
    ranged = (ranged.withColumn("_dn_task", F.shiftright("_dn_mid", _POS_BITS))
              .withColumn("_dn_pos", F.col("_dn_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    pieces = (ranged.groupBy("_dn_task", *group_cols)
              .agg(F.count(F.lit(1)).alias("_dn_n"), F.min("_dn_pos").alias("_dn_first")))
    w = (Window.partitionBy(*group_cols).orderBy("_dn_task")
         .rowsBetween(Window.unboundedPreceding, -1)) if group_cols else \
        Window.orderBy("_dn_task").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_dn_before", F.coalesce(F.sum("_dn_n").over(w), F.lit(0)))
    if isinstance(base, DataFrame):
        b = base.select(*group_cols, F.col(base_col).alias("_dn_base"))
        pieces = pieces.join(broadcast_if_small(b), group_cols, "left")
        pieces = pieces.withColumn("_dn_before", F.col("_dn_before") + F.coalesce(F.col("_dn_base"), F.lit(0)))
    elif base:
        pieces = pieces.withColumn("_dn_before", F.col("_dn_before") + F.lit(int(base)))
    pieces = pieces.select("_dn_task", *group_cols, "_dn_first", "_dn_before").checkpoint(eager=True)
    out = ranged.join(broadcast_if_small(pieces), ["_dn_task", *group_cols], "inner")
    out = out.withColumn(out_col, (F.col("_dn_before") + F.col("_dn_pos") - F.col("_dn_first")).cast("long"))
    return out.drop("_dn_mid", "_dn_task", "_dn_pos", "_dn_first", "_dn_before")
