"""Scans, addressing, watermarks, snapshots, ranges, metadata, plan shape."""
import pytest
from pyspark.sql import functions as F

from topiclake.operators import sink
from topiclake.sources import topiclog as tl
from topiclake.sources.topiclog import TopicLog


@pytest.mark.parametrize("arg,topic", [
    ("events", "events"),
    ("kafka://broker:9092/events", "events"),
    ("kafka:///events", "events"),
    ("kafka://host/a/b", "a/b"),
    ("kafka://host/", ""),
])
def test_parse_topic_uri(arg, topic):
    assert tl.parse_topic_uri(arg) == topic


@pytest.mark.parametrize("arg", ["", "kafka://nohost"])
def test_parse_topic_uri_errors(arg):
    with pytest.raises(ValueError):
        tl.parse_topic_uri(arg)


def test_uri_column_agrees_with_driver_function(spark):
    uris = ["events", "kafka://b:1/events", "kafka:///x", "kafka://h/a/b", "kafka://nohost", "", None]
    df = spark.createDataFrame([(u,) for u in uris], "u string").select("u", tl.topic_uri_col(F.col("u")).alias("t"))
    for r in df.collect():
        try:
            want = tl.parse_topic_uri(r.u) if r.u else None
        except ValueError:
            want = None
        assert r.t == want, r.u


def test_unknown_topic_raises_before_reading(spark, fx):
    with pytest.raises(tl.TopicNotFound):
        tl.scan_topic(spark, fx.log, "no-such-topic")


def test_empty_topic_has_no_rows(spark, fx):
    assert tl.scan_topic(spark, fx.log, "empty").count() == 0


def test_scan_columns_and_types(spark, fx):
    df = tl.scan_topic(spark, fx.log, "events")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("topic", "string"), ("partition", "int"), ("offset", "bigint"), ("key", "binary"), ("message", "binary")]


def test_bytes_fidelity_nul_bytes(spark, fx):
    # every framed message starts with a NUL byte; it must survive verbatim
    r = tl.scan_topic(spark, fx.log, "events").where(F.col("message").isNotNull()).first()
    assert bytes(r.message)[0] == 0 and len(bytes(r.message)) > 5


def _small_log(spark, fx, root, where=None):
    recs = fx.log.records(spark).where(F.col("topic") == "events")
    if where is not None:
        recs = recs.where(where)
    log = TopicLog(root)
    sink.write_records(recs, log, mode="overwrite")
    fx.log.catalog(spark).write.mode("overwrite").parquet(log.catalog_path)
    fx.log.brokers(spark).write.mode("overwrite").parquet(log.brokers_path)
    return log


def test_snapshot_ignores_later_appends(spark, fx, scratch):
    log = _small_log(spark, fx, scratch)
    recs = log.records(spark).where(F.col("topic") == "events")
    snap = tl.capture_snapshot(recs)
    before = snap.scan(recs).count()
    new = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(50).select(
        F.lit(None).cast("binary").alias("key"), F.lit(b"x").alias("message"), F.col("event_id"))
    sink.to_topic(spark, log, new, ["event_id"], topic="events")
    recs2 = log.records(spark).where(F.col("topic") == "events")
    assert recs2.count() == before + 50
    assert snap.scan(recs2).count() == before


def test_watermarks_with_retention_and_holes(spark, fx, scratch):
    # retention: offsets below 10 removed; holes: every 7th offset removed
    log = _small_log(spark, fx, scratch, (F.col("offset") >= 10) & (F.col("offset") % 7 != 5))
    wm = {r.partition: (r.low, r.high) for r in tl.partition_watermarks(log.records(spark)).collect()}
    full = {r.partition: r.high for r in tl.partition_watermarks(
        fx.log.records(spark).where(F.col("topic") == "events")).collect()}
    for p, (low, high) in wm.items():
        assert low == 10
        assert high in (full[p], full[p] - 1)  # the last offset may itself be a hole


def test_offset_ranges(spark, fx):
    recs = fx.log.records(spark)
    got = tl.scan_offset_range(recs, "lineitem", {0: (100, 200), 3: (-2, 50), 5: (-1, 10), 6: (10, -2)})
    parts = {r.partition: r.n for r in got.groupBy("partition").agg(F.count("*").alias("n")).collect()}
    assert parts[0] == 100 and parts[3] == 50
    assert 5 not in parts and 6 not in parts
    total = recs.where((F.col("topic") == "lineitem") & F.col("partition").isin(1, 2, 4, 7)).count()
    assert sum(v for k, v in parts.items() if k in (1, 2, 4, 7)) == total


def test_metadata_one_row(spark, fx):
    m = tl.topic_metadata(fx.log.catalog(spark), fx.log.brokers(spark), fx.log.leaders(spark))
    rows = m.collect()
    assert len(rows) == 1
    topics = {t.name: t for t in rows[0].topics}
    failed = [t for t in topics.values() if t.error]
    assert failed and all(t.partitions == [] for t in failed)
    assert [p.id for p in topics["orders"].partitions] == list(range(8))
    assert [p.leader for p in topics["orders"].partitions] == [1, 2, 3, 1, 2, 3, 1, 2]
    assert len(topics) == fx.log.catalog(spark).count()
    empty = tl.topic_metadata(fx.log.catalog(spark).limit(0), fx.log.brokers(spark).limit(0), fx.log.leaders(spark).limit(0)).collect()
    assert len(empty) == 1 and empty[0].topics == [] and empty[0].brokers == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, fx):
    df = tl.scan_offset_range(fx.log.records(spark), "lineitem", {0: (100, 200)}).select("offset")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(topic" in plan and "(topic#" in plan
    assert "PushedFilters" in plan and "offset" in plan.split("PushedFilters")[1][:300]
    assert "ReadSchema: struct<offset:bigint>" in plan


def test_no_python_on_scan_and_decode_paths(spark, fx):
    from topiclake.operators import messages
    df = messages.scan_topic_decoded(spark, fx.log, fx.registry, "events")
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan


def test_footer_watermarks_equal_scanned(spark, fx):
    got = tl.footer_watermarks(spark, fx.log)
    want = tl.partition_watermarks(fx.log.records(spark))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"


def test_footer_watermarks_plan_reads_no_data(spark, fx):
    with tl.footer_aggregates(spark):
        recs = spark.read.schema(tl.LOG_SCHEMA).parquet(fx.log.records_path)
        plan = tl.partition_watermarks(recs)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(offset), MAX(offset)]" in plan


def test_option_precedence_and_registry_key():
    from topiclake.sources.kafka import _client_options, resolve_options
    client, url = resolve_options({"Bootstrap.Servers": "a:1", "schema.registry.url": "http://r", "x": "1"},
                                  {"bootstrap.servers": "b:2"})
    assert url == "http://r" and client == {"bootstrap.servers": "b:2", "x": "1"}
    assert _client_options(client) == {"kafka.bootstrap.servers": "b:2", "kafka.x": "1"}
    mixed = _client_options({"minPartitions": "4", "kafka.group.id": "g", "includeheaders": "true",
                             "schema.registry.url": "http://r", "kafkaConsumer.pollTimeoutMs": "9"})
    assert mixed == {"minPartitions": "4", "kafka.group.id": "g", "includeHeaders": "true",
                     "kafkaConsumer.pollTimeoutMs": "9"}


def test_offset_table_join_fallback_equals_literal_plan(spark, fx, monkeypatch):
    recs = fx.log.records(spark)
    ranges = spark.createDataFrame([("lineitem", 0, 100, 200), ("lineitem", 3, -2, 50), ("lineitem", 5, -1, 10),
                                    ("orders", 1, 10, -1), ("orders", 2, 5, -2)],
                                   "topic string, partition int, start long, end long")
    literal = tl.scan_offset_table(recs, ranges)
    monkeypatch.setattr(tl, "LITERAL_RANGES_MAX", 1)
    joined = tl.scan_offset_table(recs, ranges)
    assert literal.count() == joined.count() > 0
    assert literal.exceptAll(joined).count() == 0


def test_topic_partitions_rows_match_nested_form(spark, fx):
    rows = tl.topic_partitions(fx.log.catalog(spark), fx.log.leaders(spark))
    nested = tl.topic_metadata(fx.log.catalog(spark), fx.log.brokers(spark), fx.log.leaders(spark)).first()
    flat = {(t.name, p.id, p.leader) for t in nested.topics for p in t.partitions}
    assert flat == {(r.topic, r.partition, r.leader) for r in rows.where(F.col("partition").isNotNull()).collect()}


def test_nested_metadata_has_an_entry_for_each_catalogue_row(spark):
    catalog = spark.createDataFrame(
        [("a", 2, None), ("a", 2, None), ("a", 3, None), ("b", 4, "down"), ("b", 4, "down"), ("c", 0, None),
         (None, 1, None), (None, None, None), (None, None, None)], "topic string, partitions int, error string")
    brokers = spark.createDataFrame([(7, "h7", 1), (3, "h3", 2)], tl.BROKER_SCHEMA)
    leaders = spark.createDataFrame([("a", 0, 3), ("a", 1, 7), ("a", 1, 7)], "topic string, partition int, leader int")
    m = tl.topic_metadata(catalog, brokers, leaders).collect()
    assert len(m) == 1 and [tuple(b) for b in m[0].brokers] == [(3, "h3", 2), (7, "h7", 1)]
    assert len(m[0].topics) == 9
    flat = [(t.name, t.error, p.id, p.leader) if p else (t.name, t.error, None, None)
            for t in m[0].topics for p in t.partitions or [None]]
    assert sorted(map(str, flat)) == sorted(str(tuple(r)) for r in tl.topic_partitions(catalog, leaders).collect())


def test_metadata_query_comes_through_the_nested_form(spark, fx):
    from topiclake.plans.catalog import QUERIES
    from conftest import SF_SMALL
    df = QUERIES["topic_metadata"](spark, SF_SMALL)
    assert "collect_list" in _plan(df) and "host" in _plan(df)
    m = tl.topic_metadata(fx.log.catalog(spark), fx.log.brokers(spark), fx.log.leaders(spark)).first()
    want = [(len(m.brokers), t.name, t.error, p.id if p else None, p.leader if p else None)
            for t in m.topics for p in t.partitions or [None]]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))


def test_kafka_rows_normalise_to_scan_columns(spark):
    from topiclake.sources import kafka
    raw = spark.createDataFrame(
        [(b"k", b"v", "t", 0, 5, None, 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")
    out = kafka._normalise(raw, with_timestamp=False)
    assert out.columns == tl.SCAN_COLUMNS
    assert bytes(out.first().message) == b"v"
    assert kafka._normalise(raw, with_timestamp=True).columns == tl.SCAN_COLUMNS + ["timestamp"]
