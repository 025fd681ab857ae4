"""A table of the log's files: topic, partition, row count and offset bounds, from footers.

The index is kept beside the log and grows with it: a call reads the footers of the files it does
not know yet, in tasks, and adds them; files that are gone drop out. Files are written once and
never changed, so a known file is not opened again. Watermarks, scan reports and gap searches start
from it: no record is read for the first two, and only files with holes for the third.
"""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .topiclog import LOG_SCHEMA, TopicLog, is_missing_path

INDEX_SCHEMA = "path string, topic string, partition int, n long, lo long, hi long"
_PLACE = re.compile(r"/topic=([^/]*)/partition=([^/]*)/[^/]*$")
# Files whose footers one task reads.
FILES_PER_TASK = 200


def _footers(batches):
    """Row count and offset bounds of every file, from its footer; where a writer left no
    statistics, from its offset column."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    for b in batches:
        rows = []
        for path in b.column(0).to_pylist():
            system, name = fs.FileSystem.from_uri(re.sub("[^\x00-\x7f]+", lambda m: quote(m[0]), path))
            with system.open_input_file(name) as f:
                meta = pq.ParquetFile(f)
                at = meta.schema_arrow.get_field_index("offset")
                n, lo, hi, whole = 0, None, None, True
                for g in range(meta.metadata.num_row_groups):
                    group = meta.metadata.row_group(g)
                    n += group.num_rows
                    s = group.column(at).statistics
                    if s is None or not s.has_min_max:
                        whole = whole and group.num_rows == 0
                        continue
                    lo, hi = s.min if lo is None else min(lo, s.min), s.max if hi is None else max(hi, s.max)
                if not whole:
                    offsets = meta.read(columns=["offset"])["offset"].to_numpy()
                    lo, hi = int(offsets.min()), int(offsets.max())
            rows.append((path, n, lo, hi))
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                         names=["path", "n", "lo", "hi"])


def _place(path: str) -> tuple[str, int] | None:
    """Topic and partition of a file, from its folders (names escaped once by Spark, once as URI)."""
    m = _PLACE.search(path)
    return (unquote(unquote(m[1])), int(m[2])) if m else None


def file_index(spark: SparkSession, log: TopicLog, topics: list[str] | None = None) -> DataFrame:
    """``path, topic, partition, n, lo, hi`` of the log's non-empty files (``hi`` is the last
    offset), after adding what is new to the stored index. The driver handles file names only."""
    try:
        listed = [(p, *place) for p in spark.read.schema(LOG_SCHEMA).parquet(log.records_path).inputFiles() if (place := _place(p))]
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        listed = []
    if topics is not None:
        listed = [x for x in listed if x[1] in topics]
    files = spark.createDataFrame(listed, "path string, topic string, partition int")
    stored = _stored(spark, log)
    new = files.join(stored, "path", "left_anti").checkpoint(eager=True)
    if not new.isEmpty():
        tasks = -(-len(listed) // FILES_PER_TASK)
        read = new.select("path").repartition(tasks, "path").mapInArrow(_footers, "path string, n long, lo long, hi long")
        rows = new.join(read, "path").select(*[c.split()[0] for c in INDEX_SCHEMA.split(", ")])
        rows.coalesce(1 + len(listed) // 100_000).write.mode("append").parquet(f"{log.root}/index")
        stored = _stored(spark, log)
    return stored.dropDuplicates(["path"]).join(files.select("path"), "path", "left_semi").where(F.col("n") > 0)


def _stored(spark: SparkSession, log: TopicLog) -> DataFrame:
    try:
        return spark.read.schema(INDEX_SCHEMA).parquet(f"{log.root}/index")
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], INDEX_SCHEMA)


def index_watermarks(index: DataFrame) -> DataFrame:
    """``topic, partition, low, high`` and the number of records of every non-empty partition."""
    return index.groupBy("topic", "partition").agg(F.min("lo").alias("low"), (F.max("hi") + 1).alias("high"),
                                                   F.sum("n").alias("records"))
