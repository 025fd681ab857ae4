"""Live brokers through Spark's Kafka connector, normalised to the topic-log columns.

Requires the ``spark-sql-kafka-0-10`` package on the cluster's classpath; this module
only shapes options and columns. It is not exercised by the tests here: the image has
no connector jar and no broker.

Client settings use the JVM client's names with the ``kafka.`` prefix
(``kafka.bootstrap.servers``, ``kafka.security.protocol``, ``kafka.sasl.jaas.config``…);
``options`` given without the prefix get it added.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .topiclog import SCAN_COLUMNS, parse_topic_uri

KAFKA_FORMAT = "kafka"


REGISTRY_URL_KEY = "schema.registry.url"


def resolve_options(defaults: dict[str, str] | None, call: dict[str, str] | None
                    ) -> tuple[dict[str, str], str | None]:
    """Merge option sets the way a scan does: keys are case-folded, per-call values
    override defaults (e.g. cluster-wide settings), and the registry URL is taken out
    (it addresses the registry table, never the broker client). Returns
    ``(client options, registry url)``."""
    merged: dict[str, str] = {}
    for opts in (defaults or {}, call or {}):
        for k, v in opts.items():
            merged[k.lower()] = str(v)
    url = merged.pop(REGISTRY_URL_KEY, None)
    return merged, url


# Options of the connector itself, which take no ``kafka.`` prefix.
CONNECTOR_OPTIONS = {o.lower(): o for o in (
    "assign", "subscribe", "subscribePattern", "startingOffsets", "endingOffsets", "startingTimestamp",
    "endingTimestamp", "startingOffsetsByTimestamp", "endingOffsetsByTimestamp", "failOnDataLoss", "includeHeaders",
    "minPartitions", "maxRecordsPerPartition", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay",
    "kafkaConsumer.pollTimeoutMs", "fetchOffset.numRetries", "fetchOffset.retryIntervalMs", "groupIdPrefix", "topic")}
# ``cluster wide`` defaults of every scan, overridden by a call's own options.
DEFAULTS: dict[str, str] = {}


def _client_options(options: dict[str, str]) -> dict[str, str]:
    """Options for the connector: its own ones as they are, client settings with ``kafka.``; keys
    that address the schema registry never reach the client."""
    merged, _ = resolve_options(DEFAULTS, options)
    out = {}
    for k, v in merged.items():
        if k.startswith("schema.registry."):
            continue
        out[CONNECTOR_OPTIONS.get(k) or (k if k.startswith("kafka.") else f"kafka.{k}")] = v
    return out


def _source(topics: list[str], options: dict[str, str], partitions: dict[str, list[int]] | None) -> dict[str, str]:
    """``subscribe`` or, for given partitions, ``assign``; a call's own choice wins."""
    out = _client_options(options)
    if not {"assign", "subscribe", "subscribePattern"} & set(out):
        names = [parse_topic_uri(t) for t in topics]
        if partitions:
            out["assign"] = json.dumps({t: partitions[t] for t in names})
        else:
            out["subscribe"] = ",".join(names)
    return out


def _normalise(df: DataFrame, with_timestamp: bool) -> DataFrame:
    cols = [F.col("topic"), F.col("partition"), F.col("offset"), F.col("key"), F.col("value").alias("message")]
    if with_timestamp:
        cols.append(F.col("timestamp"))
    return df.select(*cols)


def scan_kafka(spark: SparkSession, topic: str, options: dict[str, str], *,
               starting: str = "earliest", ending: str = "latest", with_timestamp: bool = False,
               partitions: list[int] | None = None) -> DataFrame:
    """Bounded read: offsets from ``starting`` up to the ``latest`` captured when the query
    starts (so later appends are not seen). ``starting`` / ``ending`` also accept the
    connector's per-partition JSON, e.g. ``{"t":{"0":100,"1":-2}}`` (-2 earliest, -1 latest).
    ``failOnDataLoss`` stays true: a missing offset is an error, never a partial result."""
    given = {parse_topic_uri(topic): partitions} if partitions else None
    reader = (spark.read.format(KAFKA_FORMAT).option("startingOffsets", starting).option("endingOffsets", ending)
              .option("failOnDataLoss", "true").options(**_source([topic], options, given)))
    return _normalise(reader.load(), with_timestamp)


def stream_kafka(spark: SparkSession, topics: list[str], options: dict[str, str], *,
                 starting: str = "latest") -> DataFrame:
    """Continuous consumption (default: from the latest offsets); progress is kept in the
    streaming query's checkpoint."""
    reader = (spark.readStream.format(KAFKA_FORMAT).option("startingOffsets", starting)
              .option("failOnDataLoss", "true").options(**_source(topics, options, None)))
    return _normalise(reader.load(), with_timestamp=True)


def write_kafka(df: DataFrame, options: dict[str, str], topic: str | None = None) -> None:
    """Write ``key, message`` (and optional ``topic`` / ``partition``) to brokers; the
    broker assigns offsets. Without ``partition`` the producer's partitioner decides."""
    cols = [F.col("key"), F.col("message").alias("value")]
    if "topic" in df.columns:
        cols.append(F.col("topic"))
    if "partition" in df.columns:
        cols.append(F.col("partition"))
    w = df.select(*cols).write.format(KAFKA_FORMAT).options(**_client_options(options))
    if topic is not None:
        w = w.option("topic", parse_topic_uri(topic))
    w.save()


__all__ = ["SCAN_COLUMNS", "scan_kafka", "stream_kafka", "write_kafka"]
