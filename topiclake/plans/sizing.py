"""Size-checked broadcast.

A side is broadcast only when an aggregate proves it small, in rows *and* bytes: it
counts rows and adds up each row's size: the bytes of string / binary columns, the JSON
bytes of nested ones, fixed widths for the rest. The aggregate combines inside each task
(two numbers per task are exchanged). A side whose files the planner already knows to be
far beyond the bound is not run at all. Beyond either bound the join is left to the
planner (sort-merge or shuffled hash join, with AQE splitting skewed partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds for sides that are small by nature (catalogues, watermarks, registries).
DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 256 << 20

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
          T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8}


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    t = field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(_FIXED.get(type(t), 16)).cast("long")


# A side that reads more than so many times the bound is taken as large without a run.
HOPELESS = 1024


def _scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files that the side reads, as the planner knows them (no job runs)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]
    known = [int(str(x)) for x in sizes]
    return sum(x for x in known if x < 1 << 62)


def is_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    if _scanned_bytes(df) > HOPELESS * max_bytes:
        return False
    widths = [_width(f) for f in df.schema.fields]
    row_bytes = sum(widths[1:], widths[0]) if widths else F.lit(0).cast("long")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    return r.n <= max_rows and (r.b or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                       max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
