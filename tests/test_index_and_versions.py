"""File index, gaps from it, snapshot fingerprints, many registry writers, merged versions, SQL errors."""
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from topiclake.functions.jsonschema import merge_structures
from topiclake.operators import analytics, registry as reg, sink
from topiclake.operators.registry import REGISTRY_LOG_SCHEMA, Registry
from topiclake.plans import sqlapi
from topiclake.sources import topiclog
from topiclake.sources.fileindex import file_index, index_watermarks
from topiclake.sources.topiclog import LOG_SCHEMA, TopicLog


def records(spark, offsets, topic="a b%/ü", partitions=2):
    return spark.createDataFrame([(topic, p, o, None, b"m", None) for p in range(partitions) for o in offsets], LOG_SCHEMA)


def test_index_follows_the_log(spark, scratch):
    log = TopicLog(f"{scratch}/log")
    assert file_index(spark, log).count() == 0
    sink.write_records(records(spark, range(50)), log, mode="overwrite")
    sink.write_records(records(spark, range(3), "t2", 1), log)
    wm = {(r.topic, r.partition): (r.low, r.high, r.records) for r in index_watermarks(file_index(spark, log)).collect()}
    assert wm == {("a b%/ü", 0): (0, 50, 50), ("a b%/ü", 1): (0, 50, 50), ("t2", 0): (0, 3, 3)}
    sink.write_records(records(spark, range(50, 60)), log)
    assert index_watermarks(file_index(spark, log, ["a b%/ü"])).where("records = 60 and high = 60").count() == 2
    # a known file is not opened again; one that is gone drops out
    stored = spark.read.parquet(f"{log.root}/index")
    assert stored.count() == stored.select("path").distinct().count()
    sink.write_records(records(spark, range(5), "t2", 1), log, mode="overwrite")
    assert index_watermarks(file_index(spark, log)).select("topic", "high").collect() == [("t2", 5)]


def test_gaps_come_from_the_index(spark, scratch):
    log = TopicLog(f"{scratch}/log")
    sink.write_records(records(spark, [*range(10), *range(12, 40)], "t"), log, mode="overwrite")
    sink.write_records(records(spark, range(45, 60), "t"), log)
    sink.write_records(records(spark, [60, 64, 66], "t", 1), log)
    want = {("t", p, *x) for p in (0, 1) for x in ((9, 12, 2), (39, 45, 5))} | {("t", 0, 60, 64, 3), ("t", 0, 64, 66, 1)}
    for bucket in (analytics.GAP_BUCKET, 4):
        assert {tuple(r) for r in analytics.offset_gaps_from_log(spark, log, None, bucket).collect()} == want
    # files without holes are not read: the scan works although their data pages are gone
    whole = [r.path for r in file_index(spark, log).where("n = hi - lo + 1").collect()]
    assert whole
    for p in whole:
        os.chmod(p.removeprefix("file:").replace("//", "/"), 0o600)
        with open(p.removeprefix("file:").replace("//", "/"), "wb") as f:
            f.write(b"")
    assert {tuple(r) for r in analytics.offset_gaps_from_log(spark, log).collect()} == want


def test_scan_report_of_an_unknown_topic(spark, fx):
    with pytest.raises(topiclog.TopicNotFound):
        topiclog.scan_report(spark, fx.log, "nope")


@pytest.mark.parametrize("literal", [500, 0])
def test_snapshot_changes(spark, monkeypatch, literal):
    monkeypatch.setattr(analytics, "LITERAL_BUCKETS_MAX", literal)
    old = records(spark, range(1000), "t")
    new = old.where("offset <> 17").withColumn("message", F.when((F.col("offset") == 900) & (F.col("partition") == 1), F.lit(b"x"))
                                               .otherwise(F.col("message"))).unionByName(records(spark, [1000], "t", 1))
    want = {(0, 17, "removed"), (1, 17, "removed"), (1, 900, "changed"), (0, 1000, "added")}
    got = analytics.snapshot_changes(new, old, bucket=64)
    assert {tuple(r)[1:] for r in got.collect()} == want
    marks = analytics.fingerprints(old, 64).checkpoint()  # kept with the older snapshot
    assert {tuple(r)[1:] for r in analytics.snapshot_changes(new, old, None, marks, 64).collect()} == want
    assert analytics.snapshot_changes(old, old, bucket=64).count() == 0


def test_two_writers_at_once(spark, scratch):
    registry = Registry(f"{scratch}/reg")
    spark.createDataFrame([], REGISTRY_LOG_SCHEMA).write.parquet(registry.changes_path)
    failed = []

    def write(name):
        try:
            for i in range(4):
                batch = spark.createDataFrame([(1, "s-value", "JSON", '{"title":"%s%d"}' % (name, i))],
                                              "req int, subject string, schema_type string, schema string")
                registry.commit(spark, lambda changes, b=batch: reg.register_schemas(changes, b)[0])
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=write, args=(n,)) for n in "ab"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    rows = registry.changes(spark).collect()
    assert sorted(r.seq for r in rows) == sorted(r.version for r in rows) == sorted(r.id for r in rows) == list(range(1, 9))
    none = registry.commit(spark, lambda changes: changes.limit(0))
    assert none.count() == 0


def test_a_dead_claim_blocks_until_released(spark, scratch):
    registry = Registry(f"{scratch}/reg")
    spark.createDataFrame([], REGISTRY_LOG_SCHEMA).write.parquet(registry.changes_path)
    assert reg._create(spark, registry._claim(1)) and not reg._create(spark, registry._claim(1))
    batch = spark.createDataFrame([(1, "s-value", "JSON", "{}")], "req int, subject string, schema_type string, schema string")
    plan = lambda changes: reg.register_schemas(changes, batch)[0]
    with pytest.raises(TimeoutError):
        registry.commit(spark, plan, patience=0.5)
    registry.release(spark, 1)
    assert registry.commit(spark, plan).first().seq == 1


def test_merged_structures():
    m = merge_structures
    assert m({"a": "BIGINT", "b": "VARCHAR"}, {"a": "DOUBLE", "c": ["BIGINT"]}) == {"a": "DOUBLE", "b": "VARCHAR", "c": ["BIGINT"]}
    assert m({"a": {"x": "BIGINT"}}, {"a": {"y": "BOOLEAN"}}) == {"a": {"x": "BIGINT", "y": "BOOLEAN"}}
    assert m("BIGINT", "VARCHAR") == "JSON" and m(["BIGINT"], ["DOUBLE"]) == ["DOUBLE"] and m({"a": "BIGINT"}, "BIGINT") == "JSON"


def test_rows_of_two_versions_in_one_projection(spark):
    from topiclake.functions import jsonschema as js
    v1, v2 = '{"type":"object","properties":{"n":{"type":"integer"},"old":{"type":"string"}}}', \
        '{"type":"object","properties":{"n":{"type":"number"},"new":{"type":"array","items":{"type":"integer"}}}}'
    log = spark.createDataFrame([(1, "register", "t-value", 1, 1, "g", "JSON", v1, False), (2, "register", "t-value", 2, 2, "h", "JSON", v2, False),
                                 (3, "register", "u-value", 1, 3, "i", "AVRO", "x", False)], REGISTRY_LOG_SCHEMA)
    s = reg.subject_structure(reg.current_view(log), "t-value")
    df = spark.createDataFrame([('{"n":1,"old":"x"}',), ('{"n":1.5,"new":[1,2]}',)], "v string")
    got = df.select(F.from_json("v", js.spark_type(s)).alias("r")).select("r.*").collect()
    assert [(r.n, r.new, r.old) for r in got] == [(1.0, None, "x"), (1.5, [1, 2], None)]
    for bad in ("u-value", "none"):
        with pytest.raises((ValueError, LookupError)):
            reg.subject_structure(reg.current_view(log), bad)
    assert json.loads(reg.merged_structures(reg.current_view(log)).first().structure) == s


@pytest.mark.parametrize("sql", ["SELECT * FROM scan_topic('nope')", "SELECT count(*) FROM scan_topic('kafka://h/nope')",
                                 "SELECT count(*) FROM scan_topic_decoded('nope')", "SELECT `offset` FROM scan_topic('nope', 1, 2)"])
def test_sql_scan_of_an_unknown_topic_fails(spark, fx, sql):
    sqlapi.register(spark, fx.log, fx.registry)
    with pytest.raises(Exception, match="Not found"):
        spark.sql(sql).collect()
    assert spark.sql("SELECT * FROM scan_topic('empty')").count() == 0
