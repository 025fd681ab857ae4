"""Helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import operator
import os
import tempfile
import uuid
import warnings
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import workspace

_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
                T.FloatType: 4, T.DoubleType: 8}
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 32 << 20


ARROW_ROWS = 1000
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: ship this package to the executors once, and make Arrow
    batches of whole texts small, so that a batch's memory stays bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="topiclake-py-"), "topiclake.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(archive)  # read by the driver only, which sends it to each executor
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``."""
    return workspace(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, the rows
    are computed exactly once, and lost executors re-read files instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(_FIXED_WIDTH.get(type(field.dataType), 16)).cast("long")


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when a count over the (already materialised) side proves that it
    is small in rows and bytes; otherwise the planner's shuffle join runs, same rows."""
    size = functools.reduce(operator.add, [_bytes(f) for f in df.schema.fields])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return F.broadcast(df) if r.n <= max_rows and (r.b or 0) <= max_bytes else df


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``(doc_id, xxhash64(text))`` is in ``dropped(doc_id, th)``
    (nulls are equal); the texts move only if ``dropped`` is too large to broadcast."""
    keys = broadcast_checked(materialise(dropped.select(
        F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct(), "dropped"))
    same = (docs["doc_id"].cast("long").eqNullSafe(keys["_gone_id"])
            & (F.xxhash64(docs["text"].cast("string")) == keys["_gone_th"]))
    return docs.join(keys, same, "left_anti")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a one-element ``transform``): a plain
    reuse of the expression inside a lambda would be evaluated again for every element."""
    return F.transform(F.array(value), body)[0]


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + x)


def held_out(doc_id: Column) -> Column:
    """Evaluation fold: crc32 of the id's decimal text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """``(doc_id, y)`` of the training fold, one row per id (ties: the larger label)."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    max_chars: int) -> list[tuple[str, int]]:
    """At most ``per_class`` labelled training texts of each class, in a fixed pseudo-random
    order of their ids; of a text the first ``max_chars`` characters are used.

    Ids are chosen among those that ``docs`` holds with a text (a bounded top-k over ids), so a table
    of labels for other documents, or a corpus of long texts, gives a full sample all the same. Only
    that bounded list is broadcast to the scan of ``docs``, and at most ``2 * per_class * max_chars``
    characters reach the driver. Labels that exist, but none for a text here, are warned of: the
    sample is then empty, and scores are a constant.
    """
    y = one_label(labels, label).withColumn("_o", F.xxhash64("doc_id"))
    there = docs.where(F.col("text").isNotNull()).select("doc_id")
    y = materialise(y.join(there, "doc_id", "left_semi"), "labels-here")
    ids = None
    for v in (0, 1):
        part = y.where(F.col("y") == v).orderBy("_o", "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.substring("text", 1, max_chars).alias("text"))
    picked = (texts.join(F.broadcast(ids), "doc_id").groupBy("_o", "doc_id", "y").agg(F.min("text").alias("text"))
              .orderBy("_o", "doc_id").limit(2 * per_class).collect())
    if not picked and not docs.isEmpty() and not one_label(labels, label).isEmpty():
        warnings.warn(f"no text here has a label {label!r} of the training fold", RuntimeWarning, stacklevel=2)
    return [(r.text, r.y) for r in picked]
