"""Wire format, canonical JSON, decode modes and quarantine codes."""
import pytest
from pyspark.sql import functions as F

from topiclake.functions import codec
from topiclake.operators import messages


def test_wire_roundtrip(spark):
    df = spark.createDataFrame([(7, '{"a":1}'), (70000, '{"b":"é"}'), (1, None)], "id int, j string")
    enc = df.select("id", "j", codec.wire_encode(F.col("id"), F.col("j")).alias("m"))
    rows = enc.select("id", "j", "m", codec.wire_schema_id(F.col("m")).alias("sid"),
                      codec.wire_payload_text(F.col("m")).alias("t")).collect()
    for r in rows:
        if r.j is None:
            assert r.m is None
            continue
        assert bytes(r.m)[:5] == b"\x00" + r.id.to_bytes(4, "big")
        assert r.sid == r.id and r.t == r.j


def test_canonical_json(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"d": [1, 2], "c": "x"}}',), ('{"a":1,"a":2}',), ("{bad",)], "s string")
    got = [r.c for r in df.select(codec.canonical_json(F.col("s")).alias("c")).collect()]
    assert got == ['{"a":{"c":"x","d":[1,2]},"b":1}', '{"a":2}', None]


M = "\ue000"  # the mark that numbers carry through the sorting
NUMBERS = [
    ("1.0", "1.0"), ("1.50", "1.5"), ("1e2", "100.0"), ("1E-7", "1e-07"), ("0.0001", "0.0001"), ("0.00001", "1e-05"),
    ("1e20", "1e+20"), ("1.5e300", "1.5e+300"), ("123456789012345.0", "123456789012345.0"),
    ("1234567890123456.0", "1.234567890123456e+15"), ("-0", "0"), ("-0.0", "-0.0"), ("2.0E-3", "0.002"),
    ("18446744073709551615", "18446744073709551615"), ("18446744073709551616", "1.8446744073709552e+19"),
    ("-9223372036854775808", "-9223372036854775808"), ("-9223372036854775809", "-9.223372036854776e+18"),
    ("01.0", None), ("1.", None), (".5", None), ("1.0-", None), ("[1.0, -]", None), ("[1.5 2]", None), ("NaN", None),
    ("{bad 1.0", None), ("1e999", None), ("", None), (None, None), ("[5, 7]", "[5,7]"), ('"1.0"', '"1.0"'),
    ('{"b":1.0,"a":[1.50,"x 1.0, \\"2.5\\" ",-3,{"d":1e2,"c":null}]}',
     '{"a":[1.5,"x 1.0, \\"2.5\\" ",-3,{"c":null,"d":100.0}],"b":1.0}'),
    (f'["{M}n5", 1.0]', f'["{M}n5",1.0]'),
    (f'["\\ue000n5", 1.0, "\\\\ue000", "\\uE000s"]', f'["{M}n5",1.0,"\\\\ue000","{M}s"]'),
    ('{"1.0":2.0}', '{"1.0":2.0}'), ('{"a":1.0,"a":2.0}', '{"a":2.0}'),
    (' [ 1.0 , true, "a\\\\" , 0.5 ] ', '[1.0,true,"a\\\\",0.5]'),
    ('["' + "x" * 200_000 + '", 2.50]', '["' + "x" * 200_000 + '",2.5]'),
    ("[" + ",".join(["1.50"] * 5000) + "]", "[" + ",".join(["1.5"] * 5000) + "]"),
]


def test_canonical_numbers(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(NUMBERS)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", codec.canonical_json(F.col("s")).alias("c")).collect()}
    for i, (s, want) in enumerate(NUMBERS):
        assert got[i] == want, s


def test_canonical_doubles_are_short_and_exact(spark):
    import random
    import re
    import struct
    rng = random.Random(8)
    xs = [x for x in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(2000)) if x == x and abs(x) != float("inf")]
    xs += [round(rng.uniform(-10, 10) * 10 ** rng.randrange(-8, 18), rng.randrange(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame([(repr(x) if "." in repr(x) or "e" in repr(x) else f"{x!r}.0", x) for x in xs], "s string, x double")
    for r in df.select("s", "x", codec.canonical_json(F.col("s")).alias("c")).collect():
        assert float(r.c) == r.x and re.fullmatch(r"-?(\d+\.\d+|\d(\.\d+)?e[+-]\d\d+)", r.c), r


def test_canonical_form_of_numbers_as_names_and_among_integers(spark):
    """Also: the form of doubles needs no regular expressions, which took most of the time."""
    texts = [("{1.5:2.0}", None), ('{"a":[1.5],2:3}', None), ('{"1.5":[2.0]}', '{"1.5":[2.0]}'), ("[01, 1.5]", None), ("[-01, 1.5]", None),
             ("[-0, 0, 10, -10, 1.5]", "[0,0,10,-10,1.5]"), ("[12345678901234567, 1.0]", "[12345678901234567,1.0]"),
             ("[1-2, 1.0]", None), ("[1.5-2, 1.0]", None), ("[-0.50, 0.0001, 0.00010, 12.0000500, 1e2]", "[-0.5,0.0001,0.0001,12.00005,100.0]"),
             ("[12345678.1234567, 123456789.12345678, 0.0, 100.00]", "[12345678.1234567,123456789.12345678,0.0,100.0]"), ("[1+2, 1.0]", None), ("[" + "7," * 3000 + "1.50]", "[" + "7," * 3000 + "1.5]"),
             ("[0.001, 0.00123, 9999999.5, 10000000.5, 12345678.0]", "[0.001,0.00123,9999999.5,10000000.5,12345678.0]"),
             ("[1e15, 1e14, 1.25e14, 1e-4, 1.25E-5, 2.0E+30]", "[1e+15,100000000000000.0,125000000000000.0,0.0001,1.25e-05,2e+30]")]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(texts)], "i int, s string")
    form = codec.canonical_json(F.col("s"))
    got = {r.i: r.c for r in df.select("i", form.alias("c")).collect()}
    assert [got[i] for i in range(len(texts))] == [want for _, want in texts]
    plan = df.select(form)._jdf.queryExecution().analyzed().toString()
    assert "regexp_extract" not in plan.lower()


def test_decode_is_inverse_of_encode(spark, fx):
    """Property: decode(encode(x)) == canonical(x), for every events payload text."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    txt = F.concat(F.lit('{"z": '), F.col("event_id").cast("string"), F.lit(', "a": "'), F.col("event_type"),
                   F.lit('", "p": '), F.col("props"), F.lit("}"))
    framed = e.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                      txt.alias("txt"), codec.wire_encode(F.lit(1), txt).alias("message"))
    dec = messages.decode_messages(framed, messages.registry_ids(fx.registry.changes(spark)))
    bad = dec.where(F.col("value") != codec.canonical_json(F.col("txt")))
    assert dec.count() == e.count() and bad.count() == 0


def test_quarantine_codes(spark, fx):
    recs = fx.log.records(spark).where(F.col("topic") == "mixed")
    good, bad = messages.decode_messages(recs, messages.registry_ids(fx.registry.changes(spark)), mode="quarantine")
    codes = {r.error_code for r in bad.select("error_code").distinct().collect()}
    assert codes == {codec.TOO_SHORT, codec.BAD_MAGIC, codec.UNKNOWN_SCHEMA_ID, codec.NOT_JSON_TYPE, codec.BAD_JSON}
    assert good.count() + bad.count() == recs.count()
    msg = bad.first().error_message
    assert msg.startswith("Error: ") and "topic='mixed'" in msg and "offset=" in msg


def test_strict_mode_fails_the_query(spark, fx):
    recs = fx.log.records(spark).where(F.col("topic") == "mixed")
    dec = messages.decode_messages(recs, messages.registry_ids(fx.registry.changes(spark)), mode="strict")
    with pytest.raises(Exception, match="cannot decode message"):
        dec.collect()


def test_registry_scan_rejects_non_json_subject(spark, fx):
    with pytest.raises(messages.DecodeError, match="schema type 'AVRO'"):
        messages.scan_topic_decoded(spark, fx.log, fx.registry, "lineitem")


def test_four_column_combinations(spark, fx):
    cols = {t: messages.scan_topic_decoded(spark, fx.log, fx.registry, t).columns
            for t in ("events", "copy", "orders", "conversations")}
    assert cols["events"][-2:] == ["key", "value"]
    assert cols["copy"][-2:] == ["key", "value"]
    assert cols["orders"][-2:] == ["key", "message"]
    assert cols["conversations"][-2:] == ["key", "message"]
    types = dict(messages.scan_topic_decoded(spark, fx.log, fx.registry, "events").dtypes)
    assert types["key"] == "binary" and types["value"] == "string"


def test_encode_validates_against_schema(spark, fx):
    rows = spark.createDataFrame(
        [(1, "events", '{"properties":{"n":{"minimum":0,"type":"integer"}},"type":"object"}', '{"n": 5}'),
         (2, "events", '{"properties":{"n":{"minimum":0,"type":"integer"}},"type":"object"}', None)],
        "id long, topic string, schema string, data string")
    enc, _ = messages.encode_json(spark, fx.registry, rows, "topic", "schema", "data")
    got = {r.id: r.message for r in enc.collect()}
    assert bytes(got[1])[5:] == b'{"n":5}' and got[2] is None
    bad = rows.limit(1).withColumn("data", F.lit('{"n": -1}'))
    enc_bad, _ = messages.encode_json(spark, fx.registry, bad, "topic", "schema", "data")
    with pytest.raises(Exception, match="does not match its schema"):
        enc_bad.collect()
    nojson = rows.limit(1).withColumn("data", F.lit("{nope"))
    enc_nj, _ = messages.encode_json(spark, fx.registry, nojson, "topic", "schema", "data")
    with pytest.raises(Exception, match="not JSON"):
        enc_nj.collect()


def test_decoding_with_more_ids_than_are_broadcast(spark, fx, monkeypatch):
    """A registry over the broadcast bound is cut to the ids that the messages use."""
    ids = messages.registry_ids(fx.registry.changes(spark))
    recs = fx.log.records(spark).where(F.col("topic") == "mixed")

    def codes():
        dec = messages.decode_messages(recs, ids, mode="null")
        return sorted(map(tuple, dec.select("partition", "offset", "value", "value_error").collect()), key=lambda r: r[:2])

    want = codes()
    monkeypatch.setattr(messages, "DEFAULT_MAX_ROWS", 3)
    assert codes() == want and len({r[3] for r in want}) > 4
