"""Topic logs and a registry change log derived from the driver's test tables.

The same derivation exists twice: as Spark DataFrame code (written once per scale
factor into the shared folder and then scanned like any topic log) and as DuckDB SQL
text (used by the oracle queries). Every derived row comes from a table row, so the
fixtures grow with the scale factor.

Topics (partition / offset order / key / message):

* ``events``   user_id % 4 / ts, event_id / UTF-8 user_id, NULL for views /
                NULL for errors, else wire JSON (schema 1 for even event_id, else 2)
* ``copy``     as events, key wire JSON integer user_id (schema 6)
* ``orders``   o_orderkey % 8 / o_orderkey / wire JSON integer o_custkey (schema 3) /
                plain JSON
* ``lineitem`` l_orderkey % 8 / unique 6-column key / UTF-8 l_orderkey / plain JSON
* ``conversations`` conv_id % 4 / conv_id, turn / UTF-8 conv_id / UTF-8 text
* ``mixed``    as events, every sixth message of a different kind of damage
* ``binary``   as events, messages of bytes that are not ASCII: ids beyond any schema's,
                invalid UTF-8, multi-byte text, too short ones
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import utf8, wire_encode
from ..operators.offsets import assign_dense
from ..operators.registry import REGISTRY_LOG_SCHEMA, Registry, content_guid
from ..operators.sink import write_topic
from ..session import workspace
from .topiclog import BROKER_SCHEMA, CATALOG_SCHEMA, LOG_SCHEMA, TopicLog, is_missing_path

FIXTURE_VERSION = "v7"

# ----------------------------------------------------------------------------------
# Schema texts, ids and cluster members of the fixture registry/cluster.
# ----------------------------------------------------------------------------------
EVENTS_V1 = ('{"properties":{"cents":{"type":"integer"},"event_id":{"type":"integer"},'
             '"event_type":{"type":"string"}},"required":["event_id","event_type"],"type":"object"}')
EVENTS_V2 = ('{"properties":{"cents":{"minimum":0,"type":"integer"},"event_id":{"type":"integer"},'
             '"event_type":{"enum":["click","purchase","signup","view"],"type":"string"}},'
             '"required":["cents","event_id","event_type"],"type":"object"}')
INTEGER_SCHEMA = '{"type":"integer"}'
UINT_SCHEMA = '{"minimum":0,"type":"integer"}'
CONV_SCHEMA = '{"type":"string"}'
LINEITEM_AVRO = ('{"fields":[{"name":"l_orderkey","type":"long"}],"name":"lineitem","type":"record"}')

# (seq, op, subject, version, id, schema_type, schema, deleted)
FIXED_CHANGES = [
    (1, "register", "events-value", 1, 1, "JSON", EVENTS_V1, False),
    (2, "register", "events-value", 2, 2, "JSON", EVENTS_V2, False),
    (3, "register", "orders-key", 1, 3, "JSON", INTEGER_SCHEMA, False),
    (4, "register", "lineitem-value", 1, 4, "AVRO", LINEITEM_AVRO, False),
    (5, "register", "conversations-value", 1, 5, "JSON", CONV_SCHEMA, False),
    (6, "register", "copy-value", 1, 1, "JSON", EVENTS_V1, False),
    (7, "register", "copy-key", 1, 6, "JSON", UINT_SCHEMA, False),
    (8, "soft_delete", "conversations-value", 1, 5, "JSON", CONV_SCHEMA, True),
]

# (topic, partitions, error): the declared data topics; ``empty`` holds no records.
# The rest of the catalogue is one topic per customer (see ``catalog_frame``).
CATALOG = [
    ("events", 4, None), ("copy", 4, None), ("orders", 8, None), ("lineitem", 8, None),
    ("conversations", 4, None), ("mixed", 4, None), ("binary", 4, None), ("empty", 2, None),
]
UNAVAILABLE = "Broker: Leader not available"

BROKERS = [(1, "broker-1", 9092), (2, "broker-2", 9092), (3, "broker-3", 9092)]

# Customer-derived registry rows: one subject per customer.
CUST_SUBJECT_DIGITS = 6
CUST_ID_BASE = 100


def cust_digits(key: Column) -> Column:
    """Customer key with at least ``CUST_SUBJECT_DIGITS`` digits; longer keys stay whole."""
    s = key.cast("string")
    return F.when(F.length(s) < CUST_SUBJECT_DIGITS, F.lpad(s, CUST_SUBJECT_DIGITS, "0")).otherwise(s)


DUCK_CUST_DIGITS = (f"(CASE WHEN length(c_custkey::VARCHAR) < {CUST_SUBJECT_DIGITS} "
                    f"THEN lpad(c_custkey::VARCHAR, {CUST_SUBJECT_DIGITS}, '0') ELSE c_custkey::VARCHAR END)")


# ---------------------------------------------------------------------------- Spark side


def events_json(e: DataFrame) -> Column:
    cents = F.round(F.col("value") * 100).cast("long")
    return F.concat(F.lit('{"cents":'), cents.cast("string"),
                    F.lit(',"event_id":'), F.col("event_id").cast("string"),
                    F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'))


@dataclass(frozen=True)
class Source:
    """A table whose rows become records: the columns that its topics need, with the record's
    ``partition``; the columns that number the rows of a partition (unique within it, the same for
    all its topics); and each topic's ``key``, ``message`` and ``timestamp``."""
    rows: DataFrame
    order: list[str]
    topics: dict[str, dict[str, Column]]


def _events_source(spark: SparkSession, sf_dir: str) -> Source:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = e.select((F.col("user_id") % 4).cast("int").alias("partition"), "ts", "event_id", "user_id", "event_type", "value")
    eid, j, ts = F.col("event_id"), events_json(rows), F.col("ts").cast("timestamp")
    is_error, none = F.col("event_type") == "error", F.lit(None).cast("binary")
    msg = F.when(is_error, none).when(eid % 2 == 0, wire_encode(F.lit(1), j)).otherwise(wire_encode(F.lit(2), j))
    key_txt = F.col("user_id").cast("string")
    kind = eid % 6
    damaged = (F.when(kind == 0, utf8((eid % 1000).cast("string")))
               .when(kind == 1, F.concat(F.lit(bytearray([1])), F.unhex(F.lit("00000001")), utf8(j)))
               .when(kind == 2, wire_encode(F.lit(999999), j))
               .when(kind == 3, wire_encode(F.lit(4), j))
               .when(kind == 4, wire_encode(F.lit(1), F.concat(F.lit("{bad"), j)))
               .otherwise(wire_encode(F.lit(1), j)))
    text = F.concat(F.lit('{"id":'), eid.cast("string"), F.lit(',"k":"é€日本"}'))
    odd = (F.when(kind == 0, F.concat(F.unhex(F.lit("00FFFFFFFF")), utf8(j)))
           .when(kind == 1, F.unhex(F.lit("0000000001E97B7D")))
           .when(kind == 2, utf8(F.concat(F.lit("é€ü "), eid.cast("string"))))
           .when(kind == 3, F.unhex(F.lit("80")))
           .when(kind == 4, wire_encode(F.lit(1), text))
           .otherwise(F.unhex(F.lit("000000"))))
    return Source(rows, ["ts", "event_id"], {
        "events": {"key": F.when(F.col("event_type") == "view", none).otherwise(utf8(key_txt)), "message": msg, "timestamp": ts},
        "copy": {"key": wire_encode(F.lit(6), key_txt), "message": msg, "timestamp": ts},
        "mixed": {"key": none, "message": F.when(is_error, none).otherwise(damaged), "timestamp": ts},
        "binary": {"key": none, "message": odd, "timestamp": ts}})


def _orders_source(spark: SparkSession, sf_dir: str) -> Source:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = o.select((F.col("o_orderkey") % 8).cast("int").alias("partition"), "o_orderkey", "o_custkey", "o_orderstatus",
                    "o_totalprice", "o_orderdate", "o_orderpriority")
    text = F.concat(F.lit('{"cents":'), F.round(F.col("o_totalprice") * 100).cast("long").cast("string"),
                    F.lit(',"o_custkey":'), F.col("o_custkey").cast("string"),
                    F.lit(',"o_orderkey":'), F.col("o_orderkey").cast("string"),
                    F.lit(',"o_orderpriority":"'), F.col("o_orderpriority"),
                    F.lit('","o_orderstatus":"'), F.col("o_orderstatus"), F.lit('"}'))
    return Source(rows, ["o_orderkey"], {"orders": {
        "key": wire_encode(F.lit(3), F.col("o_custkey").cast("string")), "message": utf8(text),
        "timestamp": F.col("o_orderdate").cast("timestamp")}})


def _lineitem_source(spark: SparkSession, sf_dir: str) -> Source:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    rows = li.select((F.col("l_orderkey") % 8).cast("int").alias("partition"), *order,
                     F.col("l_quantity").cast("long").alias("l_quantity"), "l_returnflag")
    text = F.concat(F.lit('{"l_linenumber":'), F.col("l_linenumber").cast("string"),
                    F.lit(',"l_orderkey":'), F.col("l_orderkey").cast("string"),
                    F.lit(',"l_partkey":'), F.col("l_partkey").cast("string"),
                    F.lit(',"l_quantity":'), F.col("l_quantity").cast("string"),
                    F.lit(',"l_returnflag":"'), F.col("l_returnflag"),
                    F.lit('","l_suppkey":'), F.col("l_suppkey").cast("string"), F.lit("}"))
    return Source(rows, order, {"lineitem": {
        "key": utf8(F.col("l_orderkey").cast("string")), "message": utf8(text),
        "timestamp": F.col("l_shipdate").cast("timestamp")}})


def _conversations_source(spark: SparkSession, sf_dir: str) -> Source:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = c.select((F.col("conv_id") % 4).cast("int").alias("partition"), "conv_id", "turn", "text")
    return Source(rows, ["conv_id", "turn"], {"conversations": {
        "key": utf8(F.col("conv_id").cast("string")), "message": utf8(F.col("text")),
        "timestamp": F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn"))}})


def sources(spark: SparkSession, sf_dir: str) -> dict[str, Source]:
    """The tables that the fixture topics come from."""
    return {"events": _events_source(spark, sf_dir), "orders": _orders_source(spark, sf_dir),
            "lineitem": _lineitem_source(spark, sf_dir), "conversations": _conversations_source(spark, sf_dir)}


def build_log(spark: SparkSession, sf_dir: str, log: TopicLog) -> None:
    """Write all fixture topics with dense offsets. Only the tables' own columns are shuffled, once a
    table; its topics' records are built from the sorted rows as they are written."""
    for name, src in sources(spark, sf_dir).items():
        numbered = assign_dense(src.rows, ["partition"], src.order, "offset", keep=f"{log.root}/rows/{name}")
        for topic, values in src.topics.items():
            write_topic(numbered, values, log, topic)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry change rows derived from ``customer``: one subject per customer key.

    v1 for every customer; v2 for keys divisible by 4; v1 soft-deleted where
    key % 10 = 3, and of those, permanently deleted where key % 20 = 3.
    """
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    subject = F.concat(F.lit("s"), cust_digits(F.col("c_custkey")),
                       F.lit("-value"))
    v1 = F.concat(F.lit('{"properties":{"c_acctbal":{"type":"number"},"c_custkey":{"const":'),
                  F.col("c_custkey").cast("string"),
                  F.lit(',"type":"integer"},"c_mktsegment":{"type":"string"}},"title":"'), F.coalesce(F.col("c_name"), F.lit("")),
                  F.lit('","type":"object"}'))
    v2 = F.concat(F.lit('{"properties":{"c_acctbal":{"type":"number"},"c_custkey":{"const":'),
                  F.col("c_custkey").cast("string"),
                  F.lit(',"type":"integer"},"c_mktsegment":{"type":"string"},"c_nationkey":'
                        '{"maximum":24,"minimum":0,"type":["integer","null"]}},"title":"'), F.coalesce(F.col("c_name"), F.lit("")),
                  F.lit('","type":"object"}'))
    k = F.col("c_custkey")
    id1 = (F.lit(CUST_ID_BASE) + k * 2).cast("int")
    id2 = (F.lit(CUST_ID_BASE + 1) + k * 2).cast("int")

    def rows(df, seq, op, version, sid, schema, deleted):
        return df.select(F.lit(seq).cast("long").alias("seq"), F.lit(op).alias("op"), subject.alias("subject"),
                         F.lit(version).cast("int").alias("version"), sid.alias("id"),
                         content_guid(F.lit("JSON"), schema).alias("guid"), F.lit("JSON").alias("schema_type"),
                         schema.alias("schema"), F.lit(deleted).alias("deleted"))

    return (rows(c, 10, "register", 1, id1, v1, False)
            .unionByName(rows(c.where(k % 4 == 0), 11, "register", 2, id2, v2, False))
            .unionByName(rows(c.where(k % 10 == 3), 12, "soft_delete", 1, id1, v1, True))
            .unionByName(rows(c.where(k % 20 == 3), 13, "hard_delete", 1, id1, v1, True)))


def registry_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.createDataFrame(
        [(s, op, sub, v, i, None, t, sch, d) for (s, op, sub, v, i, t, sch, d) in FIXED_CHANGES],
        REGISTRY_LOG_SCHEMA).withColumn("guid", content_guid(F.col("schema_type"), F.col("schema")))
    return fixed.unionByName(customer_changes(spark, sf_dir))


def uri_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic addresses as a user would send them, one per order: plain names,
    ``kafka://`` URIs (some naming unknown topics, some malformed)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    k = F.col("o_orderkey") % 5
    uri = (F.when(k == 0, F.concat(F.lit("kafka://broker-"), ((F.col("o_custkey") % 3) + 1).cast("string"),
                                   F.lit(":9092/events")))
           .when(k == 1, F.lit("orders"))
           .when(k == 2, F.concat(F.lit("kafka://b/"), F.col("o_orderpriority")))
           .when(k == 3, F.lit("kafka://nohost"))
           .otherwise(F.concat(F.lit("kafka://h/topics/"), F.col("o_orderstatus"))))
    return o.select(F.col("o_orderkey").alias("request_id"), uri.alias("uri"))


def catalog_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared data topics plus one topic per customer: ``c<key>.<segment>`` with
    ``c_nationkey % 6 + 1`` partitions, unavailable (error set) when the balance is
    negative. The catalogue, and so the cluster metadata, grows with the data."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    cust = c.select(
        F.concat(F.lit("c"), cust_digits(F.col("c_custkey")), F.lit("."),
                 F.lower(F.col("c_mktsegment"))).alias("topic"),
        ((F.col("c_nationkey") % 6) + 1).cast("int").alias("partitions"),
        F.when(F.col("c_acctbal") < 0, F.lit(UNAVAILABLE)).alias("error"))
    return spark.createDataFrame(CATALOG, CATALOG_SCHEMA).unionByName(cust)


def leader_frame(catalog: DataFrame) -> DataFrame:
    """The fixture cluster's partition table: partitions dealt over the brokers in turn."""
    p = catalog.where("error is null and partitions > 0").select("topic", F.explode(
        F.sequence(F.lit(0), F.col("partitions") - 1)).alias("partition"))
    ids = F.array(*[F.lit(i) for i, _, _ in sorted(BROKERS)])
    return p.withColumn("leader", F.element_at(ids, (F.col("partition") % len(BROKERS) + 1).cast("int")))


@dataclass(frozen=True)
class Fixture:
    log: TopicLog
    registry: Registry
    root: str

    @property
    def requests_path(self) -> str:
        return f"{self.root}/requests"


_READY: set[str] = set()


def _ready(spark: SparkSession, root: str) -> bool:
    if root in _READY:
        return True
    try:
        ok = spark.read.json(f"{root}/_manifest").count() == 1
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        ok = False
    if ok:
        _READY.add(root)
    return ok


_TABLES = ("conversations", "customer", "events", "lineitem", "orders")


def _source_key(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the tables' full paths, file names, sizes and times: changed tables, or another
    folder of the same name, get a fixture of their own."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    facts = []
    for t in _TABLES:
        path = hadoop.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        it = path.getFileSystem(conf).listFiles(path, True)
        while it.hasNext():
            f = it.next()
            facts.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(facts)).encode()).hexdigest()[:16]


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """Build (once per set of source files) and return the fixture topic log and registry."""
    name = sf_dir.rstrip("/").split("/")[-1]
    root = workspace(spark, "fixtures", f"{name}-{FIXTURE_VERSION}-{_source_key(spark, sf_dir)}")
    fx = Fixture(TopicLog(f"{root}/log"), Registry(f"{root}/registry"), root)
    if _ready(spark, root):
        return fx
    build_log(spark, sf_dir, fx.log)
    catalog_frame(spark, sf_dir).write.mode("overwrite").parquet(fx.log.catalog_path)
    spark.createDataFrame(BROKERS, BROKER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(fx.log.brokers_path)
    leader_frame(fx.log.catalog(spark)).write.mode("overwrite").parquet(fx.log.leaders_path)
    registry_changes(spark, sf_dir).write.mode("overwrite").parquet(fx.registry.changes_path)
    uri_requests(spark, sf_dir).write.mode("overwrite").parquet(fx.requests_path)
    spark.createDataFrame([(sf_dir, FIXTURE_VERSION)], "sf_dir string, version string") \
        .coalesce(1).write.mode("overwrite").json(f"{root}/_manifest")
    _READY.add(root)
    return fx


# ---------------------------------------------------------------------------- DuckDB side


def duck_wire(id_sql: str, text_sql: str) -> str:
    return f"(unhex('00') || unhex(printf('%08X', {id_sql})) || encode({text_sql}))"


DUCK_EVENTS_JSON = ("('{\"cents\":' || CAST(round(value*100) AS BIGINT)::VARCHAR || ',\"event_id\":' || "
                     "event_id::VARCHAR || ',\"event_type\":\"' || event_type || '\"}')")


def duck_topic_log_sql() -> str:
    """DuckDB SELECT producing the fixture topic log (same rows and bytes as Spark)."""
    j = DUCK_EVENTS_JSON
    ev_msg = f"CASE WHEN event_type = 'error' THEN NULL ELSE {duck_wire('CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END', j)} END"
    damaged = (f"CASE event_id % 6 WHEN 0 THEN encode((event_id % 1000)::VARCHAR) "
               f"WHEN 1 THEN unhex('01') || unhex('00000001') || encode({j}) "
               f"WHEN 2 THEN {duck_wire('999999', j)} WHEN 3 THEN {duck_wire('4', j)} "
               f"WHEN 4 THEN {duck_wire('1', chr(39) + '{bad' + chr(39) + ' || ' + j)} "
               f"ELSE {duck_wire('1', j)} END")
    text = "'{\"id\":' || event_id::VARCHAR || ',\"k\":\"é€日本\"}'"
    odd = (f"CASE event_id % 6 WHEN 0 THEN unhex('00FFFFFFFF') || encode({j}) "
           f"WHEN 1 THEN unhex('0000000001E97B7D') WHEN 2 THEN encode('é€ü ' || event_id::VARCHAR) "
           f"WHEN 3 THEN unhex('80') WHEN 4 THEN {duck_wire('1', text)} ELSE unhex('000000') END")
    ev_base = ("(user_id % 4)::INTEGER AS partition, "
               "(row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1)::BIGINT AS \"offset\"")
    o_json = ("('{\"cents\":' || CAST(round(o_totalprice*100) AS BIGINT)::VARCHAR || ',\"o_custkey\":' || "
              "o_custkey::VARCHAR || ',\"o_orderkey\":' || o_orderkey::VARCHAR || ',\"o_orderpriority\":\"' || "
              "o_orderpriority || '\",\"o_orderstatus\":\"' || o_orderstatus || '\"}')")
    l_json = ("('{\"l_linenumber\":' || l_linenumber::VARCHAR || ',\"l_orderkey\":' || l_orderkey::VARCHAR || "
              "',\"l_partkey\":' || l_partkey::VARCHAR || ',\"l_quantity\":' || CAST(l_quantity AS BIGINT)::VARCHAR || "
              "',\"l_returnflag\":\"' || l_returnflag || '\",\"l_suppkey\":' || l_suppkey::VARCHAR || '}')")
    return f"""
SELECT 'events' AS topic, {ev_base},
       CASE WHEN event_type = 'view' THEN NULL ELSE encode(user_id::VARCHAR) END AS key,
       {ev_msg} AS message, ts AS "timestamp"
FROM events
UNION ALL
SELECT 'copy', {ev_base}, {duck_wire('6', 'user_id::VARCHAR')}, {ev_msg}, ts FROM events
UNION ALL
SELECT 'mixed', {ev_base}, NULL::BLOB,
       CASE WHEN event_type = 'error' THEN NULL ELSE {damaged} END, ts FROM events
UNION ALL
SELECT 'binary', {ev_base}, NULL::BLOB, {odd}, ts FROM events
UNION ALL
SELECT 'orders', (o_orderkey % 8)::INTEGER,
       (row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1)::BIGINT,
       {duck_wire('3', 'o_custkey::VARCHAR')}, encode({o_json}), o_orderdate FROM orders
UNION ALL
SELECT 'lineitem', (l_orderkey % 8)::INTEGER,
       (row_number() OVER (PARTITION BY l_orderkey % 8 ORDER BY l_orderkey, l_linenumber, l_partkey,
                           l_suppkey, l_shipdate, l_extendedprice) - 1)::BIGINT,
       encode(l_orderkey::VARCHAR), encode({l_json}), l_shipdate FROM lineitem
UNION ALL
SELECT 'conversations', (conv_id % 4)::INTEGER,
       (row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) - 1)::BIGINT,
       encode(conv_id::VARCHAR), encode(text),
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 60 + turn) FROM conversations
"""


def duck_guid(h: str) -> str:
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


def duck_registry_sql() -> str:
    """DuckDB SELECT producing the fixture registry change log."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    vals = ",\n".join(
        f"({seq}, {q(op)}, {q(sub)}, {v}, {i}, {q(t)}, {q(sch)}, {str(d).lower()})"
        for (seq, op, sub, v, i, t, sch, d) in FIXED_CHANGES)
    subj = f"('s' || {DUCK_CUST_DIGITS} || '-value')"
    head = ('\'{"properties":{"c_acctbal":{"type":"number"},"c_custkey":{"const":\' || c_custkey::VARCHAR || '
            '\',"type":"integer"},"c_mktsegment":{"type":"string"}')
    v1 = f"({head}" + '}' + ',"title":"\' || coalesce(c_name, \'\') || \'","type":"object"}\')'
    v2 = (f"({head}" + ',"c_nationkey":{"maximum":24,"minimum":0,"type":["integer","null"]}},"title":"\' || '
          'coalesce(c_name, \'\') || \'","type":"object"}\')')
    id1 = f"({CUST_ID_BASE} + 2 * c_custkey)::INTEGER"
    id2 = f"({CUST_ID_BASE + 1} + 2 * c_custkey)::INTEGER"

    def cust(seq, op, version, sid, schema, deleted, where):
        return (f"SELECT {seq}::BIGINT, '{op}', {subj}, {version}, {sid}, 'JSON', {schema}, {deleted} "
                f"FROM customer {where}")
    body = "\nUNION ALL\n".join([
        f"SELECT * FROM (VALUES {vals}) v(seq, op, subject, version, id, schema_type, schema, deleted)",
        cust(10, "register", 1, id1, v1, "false", ""),
        cust(11, "register", 2, id2, v2, "false", "WHERE c_custkey % 4 = 0"),
        cust(12, "soft_delete", 1, id1, v1, "true", "WHERE c_custkey % 10 = 3"),
        cust(13, "hard_delete", 1, id1, v1, "true", "WHERE c_custkey % 20 = 3"),
    ])
    h = "sha256(schema_type || ':' || schema)"
    return (f"SELECT seq::BIGINT AS seq, op, subject, version::INTEGER AS version, id::INTEGER AS id, "
            f"{duck_guid(h)} AS guid, schema_type, schema, deleted FROM ({body}) r")


def duck_catalog_sql() -> str:
    vals = ", ".join(f"('{t}', {n}, {('NULL' if e is None else repr(e))})" for t, n, e in CATALOG)
    return (f"SELECT topic, partitions::INTEGER AS partitions, error::VARCHAR AS error "
            f"FROM (VALUES {vals}) c(topic, partitions, error) UNION ALL "
            f"SELECT 'c' || {DUCK_CUST_DIGITS} || '.' || lower(c_mktsegment), "
            f"(c_nationkey % 6 + 1)::INTEGER, CASE WHEN c_acctbal < 0 THEN '{UNAVAILABLE}' END FROM customer")


def duck_brokers_sql() -> str:
    vals = ", ".join(f"({i}, '{h}', {p})" for i, h, p in BROKERS)
    return f"SELECT id::INTEGER AS id, host, port::INTEGER AS port FROM (VALUES {vals}) b(id, host, port)"


def duck_requests_sql() -> str:
    return """SELECT o_orderkey AS request_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'kafka://broker-' || ((o_custkey % 3) + 1)::VARCHAR || ':9092/events'
       WHEN 1 THEN 'orders' WHEN 2 THEN 'kafka://b/' || o_orderpriority WHEN 3 THEN 'kafka://nohost'
       ELSE 'kafka://h/topics/' || o_orderstatus END AS uri
FROM orders"""


def duck_with() -> str:
    """``WITH`` clause naming every fixture relation for oracle queries."""
    return (f"WITH topic_log AS ({duck_topic_log_sql()}),\n"
            f"registry_log AS ({duck_registry_sql()}),\n"
            f"catalog AS ({duck_catalog_sql()}),\n"
            f"brokers AS ({duck_brokers_sql()}),\n"
            f"requests AS ({duck_requests_sql()})\n")
