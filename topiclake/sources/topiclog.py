"""Topic logs stored as Parquet, partitioned by ``topic`` and ``partition``.

A *topic log* is the table form of a message broker's topics: one row per record with
``topic, partition, offset, key, message, timestamp``. It is laid out as

    <root>/records/topic=<t>/partition=<p>/part-*.parquet   (offset-sorted files)
    <root>/topics/                                          (catalogue: topic, partitions, error)
    <root>/brokers/                                         (cluster members: id, host, port)
    <root>/leaders/                                         (topic, partition, leader: a broker id)

Reads always pass an explicit schema, so topic names such as ``007`` stay strings and
``topic`` / ``partition`` predicates become ``PartitionFilters`` while ``offset``
predicates reach the Parquet reader as ``PushedFilters``.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sizing import broadcast_if_small, is_small

# Largest ranges table turned into literal partition / offset filters on the driver.
LITERAL_RANGES_MAX = 10_000

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("offset", T.LongType(), False),
    T.StructField("key", T.BinaryType(), True),
    T.StructField("message", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# The five columns a bounded topic scan returns (timestamp is opt-in).
SCAN_COLUMNS = ["topic", "partition", "offset", "key", "message"]

CATALOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partitions", T.IntegerType(), False),
    T.StructField("error", T.StringType(), True),
])

LEADER_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("partition", T.IntegerType(), False),
    T.StructField("leader", T.IntegerType(), True),
])

BROKER_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("host", T.StringType(), False),
    T.StructField("port", T.IntegerType(), False),
])

URI_SCHEME = "kafka://"


class TopicNotFound(ValueError):
    """Raised when a scan names a topic that the catalogue does not hold."""


@dataclass(frozen=True)
class TopicLog:
    """Handle on a topic log folder (any Hadoop-compatible URI)."""

    root: str

    @property
    def records_path(self) -> str:
        return f"{self.root}/records"

    @property
    def catalog_path(self) -> str:
        return f"{self.root}/topics"

    @property
    def brokers_path(self) -> str:
        return f"{self.root}/brokers"

    @property
    def leaders_path(self) -> str:
        return f"{self.root}/leaders"

    def records(self, spark: SparkSession) -> DataFrame:
        df = spark.read.schema(LOG_SCHEMA).parquet(self.records_path)
        # partition directories reorder columns; always end in the declared order
        return df.select(*LOG_SCHEMA.fieldNames())

    def catalog(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(CATALOG_SCHEMA).parquet(self.catalog_path)

    def brokers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BROKER_SCHEMA).parquet(self.brokers_path)

    def leaders(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LEADER_SCHEMA).parquet(self.leaders_path)


# --------------------------------------------------------------------------- addressing


def parse_topic_uri(topic: str) -> str:
    """Resolve a scan argument to a topic name (plain name or ``kafka://host/topic``).

    The host part is discarded; the text after the first ``/`` behind the scheme is the
    topic and may itself contain ``/``.
    """
    if not topic:
        raise ValueError("a topic name is needed")
    if topic.startswith(URI_SCHEME):
        pos = topic.find("/", len(URI_SCHEME))
        if pos < 0:
            raise ValueError(f"no topic behind the host in {topic!r}")
        return topic[pos + 1:]
    return topic


def topic_uri_col(uri: Column) -> Column:
    """Column form of :func:`parse_topic_uri`; NULL where the URI is malformed or empty."""
    is_uri = uri.startswith(F.lit(URI_SCHEME))
    has_slash = F.locate("/", uri, len(URI_SCHEME) + 1) > 0
    stripped = F.regexp_extract(uri, r"^kafka://[^/]*/(.*)$", 1)
    return (F.when(uri.isNull() | (uri == ""), F.lit(None).cast("string"))
            .when(is_uri & has_slash, stripped)
            .when(is_uri, F.lit(None).cast("string"))
            .otherwise(uri))


# --------------------------------------------------------------------------- scans


def scan_topic(spark: SparkSession, log: TopicLog, topic: str, *,
               with_timestamp: bool = False, check_exists: bool = True) -> DataFrame:
    """Bounded scan of one topic: every retained record, partition by partition.

    Raises :class:`TopicNotFound` when the catalogue lacks the topic (checked on the
    driver against the small catalogue table, before any record is read). A topic that
    exists but holds no records yields zero rows.
    """
    name = parse_topic_uri(topic)
    if check_exists:
        require_topics(spark, log, [name])
    cols = SCAN_COLUMNS + (["timestamp"] if with_timestamp else [])
    return log.records(spark).where(F.col("topic") == F.lit(name)).select(*cols)


def scan_topics(spark: SparkSession, log: TopicLog, topics: list[str], *,
                with_timestamp: bool = False) -> DataFrame:
    """One scan over several topics (partition pruning), instead of a union of scans."""
    names = [parse_topic_uri(t) for t in topics]
    require_topics(spark, log, names)
    cols = SCAN_COLUMNS + (["timestamp"] if with_timestamp else [])
    return log.records(spark).where(F.col("topic").isin(names)).select(*cols)


def require_topics(spark: SparkSession, log: TopicLog, names: list[str]) -> None:
    """Fail when any of ``names`` is not in the catalogue (catalogue rows ~ topic count)."""
    found = {r.topic for r in log.catalog(spark).where(F.col("topic").isin(names))
             .select("topic").collect()}
    missing = sorted(set(names) - found)
    if missing:
        raise TopicNotFound(f"Not found: topic {missing[0]!r}")


def missing_topics(requests: DataFrame, catalog: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Bulk form of the unknown-topic check: requested topics that the catalogue lacks."""
    req = requests.select(topic_uri_col(F.col(uri_col)).alias("topic")).where(F.col("topic").isNotNull())
    return req.distinct().join(catalog.select("topic"), "topic", "left_anti")


def resolve_topic_uris(requests: DataFrame, catalog: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Resolve a column of topic URIs and report whether each names a known topic."""
    known = catalog.select("topic", F.lit(True).alias("_known"))
    out = requests.withColumn("topic", topic_uri_col(F.col(uri_col)))
    out = out.join(broadcast_if_small(known, 1_000_000), "topic", "left")
    return out.withColumn("known", F.coalesce(F.col("_known"), F.lit(False))).drop("_known")


# --------------------------------------------------------------------------- watermarks


def partition_watermarks(records: DataFrame) -> DataFrame:
    """``[low, high)`` per non-empty partition: first retained offset and last + 1.

    A plain aggregate: partial min/max per file split, one small shuffle; with the V2
    Parquet source and ``spark.sql.parquet.aggregatePushdown`` it is answered from footers.
    """
    return (records.groupBy("topic", "partition")
            .agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")))


def is_missing_path(e: AnalysisException) -> bool:
    """Whether a read failed only because nothing has been written there yet."""
    return (e.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


@contextmanager
def footer_aggregates(spark: SparkSession):
    """Read Parquet through the V2 source with aggregate pushdown, so MIN/MAX grouped by
    partition columns are answered from file footers. Restores the settings after."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,parquet,text")
    wanted = {"spark.sql.sources.useV1SourceList": ",".join(x for x in v1.split(",") if x.strip() != "parquet"),
              "spark.sql.parquet.aggregatePushdown": "true"}
    old = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def footer_watermarks(spark: SparkSession, log: TopicLog, topics: list[str] | None = None) -> DataFrame:
    """Watermarks from Parquet footers only (no record data is read): one row per
    non-empty partition, materialised into the checkpoint folder while pushdown is on."""
    with footer_aggregates(spark):
        try:
            recs = spark.read.schema(LOG_SCHEMA).parquet(log.records_path)
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
            # no record has been written yet
            return spark.createDataFrame([], "topic string, partition int, low bigint, high bigint")
        if topics is not None:
            recs = recs.where(F.col("topic").isin(topics))
        return partition_watermarks(recs).checkpoint(eager=True)


@dataclass
class Snapshot:
    """Watermarks captured once; scans through it never see later appends."""

    watermarks: DataFrame  # topic, partition, low, high (materialised)

    def scan(self, records: DataFrame, cols: list[str] | None = None) -> DataFrame:
        """Records with ``low <= offset < high`` of their partition at capture time."""
        wm = self.watermarks.select("topic", "partition", "low", "high")
        # bounds over all partitions, as literals, let the reader skip row groups early
        bounds = self.watermarks.agg(F.min("low").alias("lo"), F.max("high").alias("hi")).first()
        out = records
        if bounds is not None and bounds.lo is not None:
            out = out.where((F.col("offset") >= F.lit(bounds.lo)) & (F.col("offset") < F.lit(bounds.hi)))
        wm = broadcast_if_small(wm, 1_000_000)  # one row per topic partition
        out = out.join(wm, ["topic", "partition"], "inner")
        out = out.where((F.col("offset") >= F.col("low")) & (F.col("offset") < F.col("high")))
        return out.select(*(cols or SCAN_COLUMNS))


def capture_snapshot(records: DataFrame, topics: list[str] | None = None) -> Snapshot:
    """Capture the watermarks of ``topics`` (all when None) into the checkpoint folder."""
    src = records if topics is None else records.where(F.col("topic").isin(topics))
    wm = partition_watermarks(src).checkpoint(eager=True)
    return Snapshot(wm)


def snapshot_scan(spark: SparkSession, log: TopicLog, topic: str) -> DataFrame:
    """Snapshot-consistent scan of one topic: capture watermarks (from file footers),
    then read strictly below them."""
    name = parse_topic_uri(topic)
    require_topics(spark, log, [name])
    recs = log.records(spark).where(F.col("topic") == F.lit(name))
    return Snapshot(footer_watermarks(spark, log, [name])).scan(recs)


# --------------------------------------------------------------------------- ranges


EARLIEST = -2
LATEST = -1


def scan_partitions(records: DataFrame, topic: str, partitions: list[int]) -> DataFrame:
    """Records of the given partitions only (``PartitionFilters``)."""
    return (records.where((F.col("topic") == F.lit(topic)) & F.col("partition").isin(list(partitions)))
            .select(*SCAN_COLUMNS))


def scan_offset_range(records: DataFrame, topic: str, ranges: dict[int, tuple[int, int]]) -> DataFrame:
    """Half-open ``[start, end)`` per partition; -2 = earliest, -1 = latest (no bound).

    Partitions absent from ``ranges`` are read whole. A start below the partition's
    first retained offset simply starts at it. Partitions sharing a range are read by one
    scan whose ``partition IN (…)`` prunes directories and whose offset bounds are
    literals pushed into the Parquet reader (row groups outside the range are skipped);
    the scans cover disjoint partitions and are unioned.
    """
    base = records.where(F.col("topic") == F.lit(topic))
    groups: dict[tuple[int, int], list[int]] = {}
    for p, (start, end) in ranges.items():
        if start == LATEST or end == EARLIEST:  # nothing to read in this partition
            groups.setdefault((0, 0), []).append(int(p))
            continue
        groups.setdefault((int(start), int(end)), []).append(int(p))
    parts = []
    for (start, end), ps in sorted(groups.items()):
        if (start, end) == (0, 0) and all(ranges[p][0] == LATEST or ranges[p][1] == EARLIEST for p in ps):
            continue
        cond = F.col("partition").isin(ps)
        if start >= 0:
            cond = cond & (F.col("offset") >= F.lit(start))
        if end >= 0:
            cond = cond & (F.col("offset") < F.lit(end))
        parts.append(base.where(cond))
    parts.append(base.where(~F.col("partition").isin([int(p) for p in ranges])) if ranges else base)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*SCAN_COLUMNS)


def scan_offset_table(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Table-driven ranges: ``ranges(topic, partition, start, end)`` (-2/-1 as above).

    Partitions present in the log but not in ``ranges`` are read whole. The ranges table
    has one row per topic partition (catalogue-sized): its partitions and overall
    ``[min start, max end)`` become literal filters, so directories are pruned and
    row groups outside every range are skipped, and the exact per-partition bounds are
    applied through a broadcast equi-join on ``(topic, partition)``.
    """
    r = ranges.select("topic", "partition", F.col("start").alias("_start"), F.col("end").alias("_end"))
    if not is_small(r, LITERAL_RANGES_MAX):
        return _scan_offset_join(records, r)
    listed = r.select("topic", "partition", "_start", "_end").collect()
    topics = sorted({row.topic for row in listed})
    recs = records.where(F.col("topic").isin(topics))
    pairs = F.struct("topic", "partition").isin([F.struct(F.lit(x.topic), F.lit(int(x.partition))) for x in listed]) \
        if listed else F.lit(False)
    live = [x for x in listed if x._start != LATEST and x._end != EARLIEST]
    ranged = recs.where(pairs)
    if live and all(x._start is not None for x in live):
        lo = min(0 if x._start == EARLIEST else x._start for x in live)
        ranged = ranged.where(F.col("offset") >= F.lit(int(lo)))
    if live and all(x._end is not None and x._end >= 0 for x in live):
        ranged = ranged.where(F.col("offset") < F.lit(int(max(x._end for x in live))))
    j = ranged.join(broadcast_if_small(r, 1_000_000), ["topic", "partition"], "inner")
    inside = j.where(_in_range(F.col("offset"), F.col("_start"), F.col("_end"))).select(*SCAN_COLUMNS)
    rest = recs.where(~pairs).select(*SCAN_COLUMNS)
    return inside.unionByName(rest)


def _in_range(offset: Column, start: Column, end: Column) -> Column:
    """Half-open range with -2 = earliest, -1 = latest; a NULL bound is no bound."""
    start, end = F.coalesce(start, F.lit(EARLIEST)), F.coalesce(end, F.lit(LATEST))
    return ((start != LATEST) & (end != EARLIEST) & ((start == EARLIEST) | (offset >= start))
            & ((end == LATEST) | (offset < end)))


def _scan_offset_join(records: DataFrame, r: DataFrame) -> DataFrame:
    """Ranges applied by a join alone (for very many listed partitions): records of
    listed partitions by equi-join plus range residual, the rest whole (anti-join)."""
    topics = broadcast_if_small(r.select("topic").distinct())
    r = r.withColumn("_listed", F.lit(True))
    j = records.join(topics, "topic", "left_semi").join(r, ["topic", "partition"], "left")
    keep = F.col("_listed").isNull() | _in_range(F.col("offset"), F.col("_start"), F.col("_end"))
    return j.where(keep).select(*SCAN_COLUMNS)


# --------------------------------------------------------------------------- metadata


def topic_partitions(catalog: DataFrame, leaders: DataFrame) -> DataFrame:
    """Cluster metadata as rows, one per topic partition: ``topic, error, partition,
    leader`` (a topic with an error, or without partitions, gives one row with NULL
    partition and leader).

    ``leaders`` is the stored partition table; a partition it lacks has no leader. One
    equi-join over the catalogue, so it scales with the number of topics and partitions.
    """
    return _with_leaders(catalog, leaders).select("topic", "error", "partition", "leader")


def _with_leaders(catalog: DataFrame, leaders: DataFrame) -> DataFrame:
    """The catalogue's rows, with their own columns, once for each ``partition`` and its ``leader``."""
    count = F.when(F.col("error").isNull() & (F.col("partitions") > 0), F.col("partitions"))
    parts = catalog.select("*", F.explode_outer(
        F.when(count.isNotNull(), F.sequence(F.lit(0), count - 1))).alias("partition"))
    return parts.join(leaders, ["topic", "partition"], "left")


def topic_metadata(catalog: DataFrame, brokers: DataFrame, leaders: DataFrame) -> DataFrame:
    """Cluster metadata as **one row**: ``brokers`` and ``topics`` nested lists, the
    shape a metadata call returns (``topics[i] = {name, error, partitions: [{id,
    leader}]}``; a topic with an error has no partitions). ``topics`` has an entry for
    each row of the catalogue, equal rows included.

    One shuffle by topic builds each topic's partition list; a global aggregate then
    nests all topics into the single row, so this form is bounded by the size of the
    cluster metadata. Analytics over many topics should use :func:`topic_partitions`.
    """
    rows = catalog.groupBy("topic", "partitions", "error").agg(F.count(F.lit(1)).cast("int").alias("_rows"))
    per_topic = (_with_leaders(rows, leaders).groupBy(*rows.columns)
                 .agg(F.sort_array(F.collect_list(
                     F.when(F.col("partition").isNotNull(), F.struct(F.col("partition").alias("id"), "leader"))))
                      .alias("_parts")))
    b = brokers.select(F.struct("id", "host", "port").alias("_b"),
                       F.lit(None).cast("struct<name:string,error:string,"
                                        "partitions:array<struct<id:int,leader:int>>>").alias("_t"))
    t = per_topic.select(F.lit(None).cast("struct<id:int,host:string,port:int>").alias("_b"), F.explode(F.array_repeat(
        F.struct(F.col("topic").alias("name"), "error", F.col("_parts").alias("partitions")), F.col("_rows"))).alias("_t"))
    return b.unionByName(t).agg(F.sort_array(F.collect_list("_b")).alias("brokers"),
                                F.sort_array(F.collect_list("_t")).alias("topics"))


def scan_report(spark: SparkSession, log: TopicLog, topic: str) -> DataFrame:
    """The scan's log lines as rows: one init line, then one watermark line per partition. They
    come from the file index (no record is read); an unknown topic is an error."""
    from .fileindex import file_index, index_watermarks
    name = parse_topic_uri(topic)
    require_topics(spark, log, [name])
    wm = index_watermarks(file_index(spark, log, [name])).checkpoint(eager=True)
    init = wm.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("Initialized topic scan").alias("event"),
        F.create_map(F.lit("partitions"), F.col("n").cast("string"),
                     F.lit("topic"), F.lit(name)).alias("info"),
        F.lit(-1).alias("_order"))
    lines = wm.select(
        F.lit("Partition watermarks").alias("event"),
        F.create_map(F.lit("partition"), F.col("partition").cast("string"),
                     F.lit("low"), F.col("low").cast("string"),
                     F.lit("high"), F.col("high").cast("string")).alias("info"),
        F.col("partition").alias("_order"))
    return init.unionByName(lines)
