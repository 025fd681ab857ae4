"""SQL face: temp views over a topic log and registry, and SQL table functions.

After ``register(spark, log, registry)``::

    SELECT * FROM scan_topic('kafka://broker/events');
    SELECT * FROM scan_topic(t => 'events', lo => 100, hi => 200);
    SELECT * FROM partition_watermarks('events');
    SELECT * FROM schema_latest('events-value');
    SELECT * FROM registry_versions('events-value');
    SELECT * FROM registry_subjects(TRUE);
    SELECT * FROM schema_by_version('events-value', 1);
    SELECT * FROM schema_by_subject_id('events-value', 2);
    SELECT * FROM schema_by_guid('…');
    SELECT wire_schema_id(message), canonical_json(wire_payload(message)) FROM scan_topic('events');
    SELECT * FROM scan_topic_decoded('events');   -- value as JSON text, value_error where it has none
    SELECT schema_structure('events-value');
    SELECT wire_encode(2, '{"a":1}');
    SELECT * FROM topic_metadata();        -- one row, nested (bounded by cluster metadata)
    SELECT * FROM topic_partitions();      -- one row per topic partition

A scan of a topic that the catalogue lacks fails, as in the scan API. The functions are SQL table UDFs over the views, so Catalyst inlines them: partition
pruning and offset pushdown survive the function boundary.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.messages import registry_ids
from ..operators.registry import Registry, current_view, latest_structures, schema_by_guid, schema_latest
from ..sources.topiclog import SCAN_COLUMNS, TopicLog, topic_metadata, topic_partitions

# A malformed address fails (NULL, empty, or a host without a topic), as the scan API does.
_URI_TO_TOPIC = ("CASE WHEN t IS NULL OR t = '' THEN raise_error('a topic name is needed') "
                 "WHEN t LIKE 'kafka://%' AND NOT t LIKE 'kafka://%/%' "
                 "THEN raise_error(concat('no topic behind the host in ', t)) "
                 "WHEN t LIKE 'kafka://%' THEN regexp_extract(t, '^kafka://[^/]*/(.*)$', 1) ELSE t END")

# No rows, but a failure where the catalogue lacks the topic.
_UNKNOWN_TOPIC = f"""
 SELECT '', 0, 0L, X'', X'' FROM (SELECT count(*) AS known FROM topic_catalog WHERE topic = {_URI_TO_TOPIC})
 WHERE CASE WHEN known = 0 THEN CAST(raise_error('Not found: the catalogue lacks the topic of this scan') AS BOOLEAN)
       ELSE FALSE END"""

# The first failing check of a message, as in ``functions.codec.decode_status``.
_DECODE_ERROR = """CASE WHEN s.message IS NULL THEN NULL
 WHEN length(s.message) < 5 THEN 'too_short' WHEN substring(s.message, 1, 1) <> X'00' THEN 'bad_magic'
 WHEN i.schema_type IS NULL THEN 'unknown_schema_id' WHEN i.schema_type <> 'JSON' THEN 'not_json_type'
 WHEN wire_payload(s.message) IS NULL THEN 'bad_utf8'
 WHEN try_parse_json(wire_payload(s.message)) IS NULL THEN 'bad_json' END"""


def register_scalar_functions(spark: SparkSession) -> None:
    """Wire-format and JSON helpers as SQL scalar functions (inlined by the analyzer, so
    they run as plain Catalyst expressions)."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION wire_schema_id(m BINARY) RETURNS INT
        RETURN CASE WHEN length(m) >= 5 AND substring(m, 1, 1) = X'00'
               THEN try_cast(CAST(conv(hex(substring(m, 2, 4)), 16, 10) AS BIGINT) AS INT) END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION wire_payload(m BINARY) RETURNS STRING
        RETURN try_validate_utf8(CAST(substring(m, 6) AS STRING))""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION wire_encode(id INT, j STRING) RETURNS BINARY
        RETURN CASE WHEN j IS NOT NULL THEN concat(X'00', unhex(lpad(hex(id), 8, '0')), encode(j, 'UTF-8')) END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION canonical_json(j STRING) RETURNS STRING
        RETURN to_json(try_parse_json(j))""")


def register(spark: SparkSession, log: TopicLog, registry: Registry | None = None) -> None:
    register_scalar_functions(spark)
    log.records(spark).createOrReplaceTempView("topic_log")
    log.catalog(spark).createOrReplaceTempView("topic_catalog")
    log.brokers(spark).createOrReplaceTempView("topic_brokers")
    cols = ", ".join(f"`{c}`" for c in SCAN_COLUMNS)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION scan_topic(
            t STRING, lo BIGINT DEFAULT -2, hi BIGINT DEFAULT -1)
        RETURNS TABLE (topic STRING, `partition` INT, `offset` BIGINT, key BINARY, message BINARY)
        RETURN SELECT {cols} FROM topic_log
               WHERE topic = {_URI_TO_TOPIC}
                 AND (lo < 0 OR `offset` >= lo) AND (hi < 0 OR `offset` < hi)
               UNION ALL {_UNKNOWN_TOPIC}""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION partition_watermarks(t STRING)
        RETURNS TABLE (topic STRING, `partition` INT, low BIGINT, high BIGINT)
        RETURN SELECT topic, `partition`, min(`offset`), max(`offset`) + 1 FROM topic_log
               WHERE topic = {_URI_TO_TOPIC} GROUP BY topic, `partition`""")
    topic_metadata(log.catalog(spark), log.brokers(spark), log.leaders(spark)).createOrReplaceTempView("topic_metadata_view")
    topic_partitions(log.catalog(spark), log.leaders(spark)).createOrReplaceTempView("topic_partitions_view")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION topic_partitions()
        RETURNS TABLE (topic STRING, error STRING, `partition` INT, leader INT)
        RETURN SELECT topic, error, `partition`, leader FROM topic_partitions_view""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION topic_metadata()
        RETURNS TABLE (brokers ARRAY<STRUCT<id: INT, host: STRING, port: INT>>,
                       topics ARRAY<STRUCT<name: STRING, error: STRING,
                                           partitions: ARRAY<STRUCT<id: INT, leader: INT>>>>)
        RETURN SELECT brokers, topics FROM topic_metadata_view""")
    if registry is None:
        return
    registry.changes(spark).createOrReplaceTempView("registry_log")
    current_view(registry.changes(spark)).createOrReplaceTempView("registry_current")
    current_view(registry.changes(spark), include_deleted=True).createOrReplaceTempView("registry_all")
    registry_ids(registry.changes(spark)).createOrReplaceTempView("registry_ids")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION scan_topic_decoded(t STRING, lo BIGINT DEFAULT -2, hi BIGINT DEFAULT -1)
        RETURNS TABLE (topic STRING, `partition` INT, `offset` BIGINT, key BINARY, value STRING, value_error STRING)
        RETURN SELECT s.topic, s.`partition`, s.`offset`, s.key, canonical_json(wire_payload(
                 CASE WHEN {_DECODE_ERROR} IS NULL THEN s.message END)), {_DECODE_ERROR}
               FROM scan_topic(t, lo, hi) s LEFT JOIN registry_ids i ON i.id = wire_schema_id(s.message)""")
    latest_structures(current_view(registry.changes(spark))).createOrReplaceTempView("registry_structures")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION schema_structure(s STRING) RETURNS STRING
        RETURN (SELECT max(structure) FROM registry_structures WHERE subject = s)""")
    # one row per key, so the functions below are plain filters (and lateral joins over
    # them decorrelate into equi-joins instead of per-row limits)
    schema_latest(current_view(registry.changes(spark))).createOrReplaceTempView("registry_latest")
    cur = current_view(registry.changes(spark))
    cur.dropDuplicates(["subject", "id"]).createOrReplaceTempView("registry_by_subject_id")
    schema_by_guid(cur, cur.select("guid").distinct()).createOrReplaceTempView("registry_by_guid")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION schema_latest(s STRING)
        RETURNS TABLE (id INT, guid STRING, subject STRING, version INT, schema_type STRING, schema STRING)
        RETURN SELECT id, guid, subject, version, schema_type, schema FROM registry_latest
               WHERE subject = s""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION registry_versions(s STRING)
        RETURNS TABLE (version INT)
        RETURN SELECT version FROM registry_current WHERE subject = s""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION registry_subjects(include_deleted BOOLEAN)
        RETURNS TABLE (subject STRING)
        RETURN SELECT DISTINCT subject FROM registry_all WHERE include_deleted OR NOT deleted""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION schema_by_version(s STRING, v INT)
        RETURNS TABLE (id INT, guid STRING, subject STRING, version INT, schema_type STRING, schema STRING)
        RETURN SELECT id, guid, subject, version, schema_type, schema FROM registry_current
               WHERE subject = s AND version = v""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION schema_by_subject_id(s STRING, i INT)
        RETURNS TABLE (schema_type STRING, schema STRING)
        RETURN SELECT schema_type, schema FROM registry_by_subject_id WHERE subject = s AND id = i""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION schema_by_guid(g STRING)
        RETURNS TABLE (schema_type STRING, schema STRING)
        RETURN SELECT schema_type, schema FROM registry_by_guid WHERE guid = g""")
