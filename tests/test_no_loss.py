"""Nothing is lost silently: NULL bounds, unknown topics, odd bytes, missing schemas, damaged tables."""
import pytest
from pyspark.sql import functions as F

from topiclake.operators import messages, sink
from topiclake.plans import sizing, sqlapi
from topiclake.sources import fixtures, topiclog
from topiclake.sources.topiclog import LOG_SCHEMA, TopicLog


def bad_cause(e):
    return str(e.value)


def test_ranges_with_null_bounds_are_alike_in_both_plans(spark, monkeypatch):
    rows = [("t", p, o, None, None, None) for p in range(5) for o in range(5)]
    recs = spark.createDataFrame(rows, LOG_SCHEMA)
    ranges = spark.createDataFrame([("t", 0, 2, None), ("t", 1, None, 2), ("t", 2, -2, -1), ("t", 3, -1, None)],
                                   "topic string, partition int, start long, end long")
    want = {(0, 2), (0, 3), (0, 4), (1, 0), (1, 1), *((2, o) for o in range(5)), *((4, o) for o in range(5))}
    for limit in (10_000, -1):
        monkeypatch.setattr(topiclog, "LITERAL_RANGES_MAX", limit)
        got = topiclog.scan_offset_table(recs, ranges).collect()
        assert {(r.partition, r.offset) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("topic,partition,text", [
    ("nope", 0, "unknown topic"), (None, 0, "without a topic"), ("events", 7, "no partition 7"),
    ("events", -1, "no partition -1")])
def test_writes_that_cannot_land_fail(spark, fx, topic, partition, text):
    recs = spark.createDataFrame([(topic, partition, b"k", b"m", 1)],
                                 "topic string, partition int, key binary, message binary, o int")
    with pytest.raises(Exception) as e:
        sink.plan_topic_write(spark, fx.log, recs, ["o"]).collect()
    assert text in bad_cause(e)
    if topic == "nope":
        with pytest.raises(topiclog.TopicNotFound):
            sink.plan_topic_write(spark, fx.log, recs.drop("topic"), ["o"], topic="nope")


ODD = [(b"\x00\xff\xff\xff\xff{}", "unknown_schema_id"), (b"\x00\x80\x00\x00\x01{}", "unknown_schema_id"),
       ("é€ü plain".encode(), "bad_magic"), (b"\x00\x00\x00\x00\x01\xe9{}", "bad_utf8"), (b"\xff", "too_short"),
       (b"", "too_short"), (b"\x00\x00\x00\x00", "too_short"), (b"\x00\x00\x00\x00\x01", "bad_json"),
       (b"\x00\x00\x00\x00\x01{\"a\":\"\xc3\xa9\"}", None), (None, None), (b"\x00\x00\x00\x00\x04{}", "not_json_type")]


def odd_records(spark):
    return spark.createDataFrame([("t", 0, i, b"key", m) for i, (m, _) in enumerate(ODD)],
                                 "topic string, partition int, offset long, key binary, message binary")


def test_decode_is_total(spark, fx):
    ids = messages.registry_ids(fx.registry.changes(spark))
    got = messages.decode_messages(odd_records(spark), ids, mode="null").orderBy("offset").collect()
    assert [r.value_error for r in got] == [c for _, c in ODD]
    assert got[8].value == '{"a":"é"}' and got[9].value is None
    good, bad = messages.decode_messages(odd_records(spark), ids, mode="quarantine")
    assert good.count() == 2
    assert {bytes(r.raw_message) for r in bad.collect()} == {m for m, c in ODD if c}
    assert all(bytes(r.raw_key) == b"key" for r in bad.collect())


@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select("offset").collect(),
                                 lambda d: d.join(d.select("offset"), "offset").count()])
def test_strict_fails_whatever_is_read(spark, fx, use):
    ids = messages.registry_ids(fx.registry.changes(spark))
    with pytest.raises(Exception) as e:
        use(messages.decode_messages(odd_records(spark), ids))
    assert "cannot decode message" in bad_cause(e)


def test_permanently_deleted_schema_is_unknown(spark):
    cols = "seq long, op string, subject string, version int, id int, guid string, schema_type string, schema string, deleted boolean"
    log = spark.createDataFrame([(1, "register", "a-value", 1, 1, "g", "JSON", "{}", False),
                                 (2, "register", "b-value", 1, 2, "h", "JSON", "{}", False),
                                 (3, "soft_delete", "b-value", 1, 2, "h", "JSON", "{}", True),
                                 (4, "soft_delete", "a-value", 1, 1, "g", "JSON", "{}", True),
                                 (5, "hard_delete", "a-value", 1, 1, "g", "JSON", "{}", True)], cols)
    assert [r.id for r in messages.registry_ids(log).collect()] == [2]


def test_scan_decoded_modes_keep_the_error(spark, fx, scratch):
    log = TopicLog(f"{scratch}/log")
    odd = odd_records(spark).withColumn("topic", F.lit("events")).withColumn("timestamp", F.lit(None).cast("timestamp"))
    sink.write_records(odd, log, mode="overwrite")
    fx.log.catalog(spark).write.parquet(log.catalog_path)
    null = messages.scan_topic_decoded(spark, log, fx.registry, "events", mode="null")
    assert {r.offset for r in null.where("value is null and value_error is null").collect()} == {9}  # the tombstone
    good, bad = messages.scan_topic_decoded(spark, log, fx.registry, "events", mode="quarantine")
    assert good.count() == 2 and bad.count() == len(ODD) - 2
    with pytest.raises(ValueError):
        messages.scan_topic_decoded(spark, log, fx.registry, "events", mode="loose")


def test_encode_keeps_null_rows_and_user_columns(spark, fx):
    rows = [(1, "a", '{"type":"object"}', "{}", "s"), (2, None, '{"type":"object"}', "{}", "s"),
            (3, "a", None, "{}", "s"), (4, "a", '{"type":"object"}', None, "s")]
    df = spark.createDataFrame(rows, "i int, topic string, schema string, data string, subject string")
    out, _ = messages.encode_json(spark, fx.registry, df, "topic", "schema", "data")
    got = {r.i: (r.message is not None, r.subject) for r in out.collect()}
    assert got == {1: (True, "s"), 2: (False, "s"), 3: (False, "s"), 4: (False, "s")}
    broken = spark.createDataFrame([(1, "a", "{}", "{oops")], "i int, topic string, schema string, data string")
    for validate in (True, False):
        out, _ = messages.encode_json(spark, fx.registry, broken, "topic", "schema", "data", validate=validate)
        with pytest.raises(Exception) as e:
            out.count()
        assert "not JSON" in bad_cause(e)


def test_ingest_does_not_take_a_damaged_table_for_an_empty_one(spark, scratch):
    recs = spark.createDataFrame([("t", 0, o, None, None, None) for o in range(6)], LOG_SCHEMA)
    path = f"{scratch}/table"
    assert sink.ingest(recs, path, spark).count() == 6
    assert sink.ingest(recs, path, spark).count() == 0
    with open(f"{path}/topic=t/partition=0/part-zzz.parquet", "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        sink.ingest(recs, path, spark)


@pytest.mark.parametrize("arg,text", [("kafka://nohost", "no topic behind"), ("", "a topic name is needed")])
def test_sql_scan_of_a_malformed_address_fails(spark, fx, arg, text):
    sqlapi.register(spark, fx.log, fx.registry)
    with pytest.raises(Exception) as e:
        spark.sql(f"SELECT * FROM scan_topic('{arg}')").collect()
    assert text in bad_cause(e)


def test_sizes_are_bytes_and_big_files_are_not_run(spark, monkeypatch):
    df = spark.createDataFrame([("é" * 100,)], "s string")
    assert sizing.is_small(df, max_bytes=200) and not sizing.is_small(df, max_bytes=199)
    monkeypatch.setattr(sizing, "_scanned_bytes", lambda d: 1 << 50)
    assert not sizing.is_small(df)


def test_long_customer_keys_stay_whole(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "k long")
    assert [r[0] for r in df.select(fixtures.cust_digits(F.col("k"))).collect()] == ["000007", "1234567"]


def test_fixture_follows_the_files(spark, scratch):
    import shutil
    for t in ("conversations", "customer", "events", "lineitem", "orders"):
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", f"{scratch}/{t}.parquet")
    first = fixtures._source_key(spark, scratch)
    assert first == fixtures._source_key(spark, scratch) != fixtures._source_key(spark, "/root/testdata/sf0.001")
    shutil.copyfile("/root/testdata/sf0.01/events.parquet", f"{scratch}/events.parquet")
    assert fixtures._source_key(spark, scratch) != first




def test_tail_reads_no_idle_neighbour(spark, scratch, monkeypatch):
    from topiclake.operators import analytics
    log = TopicLog(f"{scratch}/log")
    rows = [("t", 0, o, None, None, None) for o in range(3)] + [("t", 1, o, None, None, None) for o in range(500)]
    rows += [("t", 2, o * 40, None, None, None) for o in range(10)]  # holes: fewer than n near the end
    sink.write_records(spark.createDataFrame(rows, LOG_SCHEMA), log, mode="overwrite")
    want = {(p, o) for p, o in [(0, 0), (0, 1), (0, 2)] + [(1, o) for o in range(495, 500)] + [(2, o * 40) for o in range(5, 10)]}
    for branches in (100, 0):
        monkeypatch.setattr(analytics, "TAIL_BRANCHES_MAX", branches)
        got = analytics.tail_n_from_log(spark, log, 5)
        assert {(r.partition, r.offset) for r in got.collect()} == want


def test_many_schemas_plan_quickly(spark, fx):
    import time
    from topiclake.functions.jsonschema import validate_by_schema
    texts = ['{"type":"object","title":"t%d","properties":{"a":{"type":"integer","minimum":%d},"b":{"type":"string"}}}'
             % (i, i % 40) for i in range(1000)]
    df = spark.createDataFrame([(texts[i], '{"a":5,"b":"x"}') for i in range(0, 1000, 10)], "s string, j string")
    t = time.time()
    out = validate_by_schema(df.withColumn("v", F.parse_json("j")), "v", "s", texts, "checks")
    bad = out.where("size(checks) > 0").count()
    assert time.time() - t < 60 and bad == sum(1 for i in range(0, 1000, 10) if i % 40 > 5)
