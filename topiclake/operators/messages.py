"""Bulk encode / decode of registry-framed JSON messages, as joins against the registry.

A message names its writer schema by id. Rather than one registry call per record, the
ids are joined to the registry's ``(id, schema_type)`` table: broadcast when a bounded
count proves it small; otherwise it is first cut down to the ids that the messages use
(a partial aggregate), and only a large remainder falls back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..plans.sizing import DEFAULT_MAX_ROWS, broadcast_if_small, is_small
from ..sources.topiclog import SCAN_COLUMNS, TopicLog, parse_topic_uri, require_topics
from .registry import Registry, current_view, register_schemas, schema_latest, subject_for
from .validation import validate_rows


class DecodeError(ValueError):
    """A record could not be decoded (strict mode)."""


def registry_ids(changes: DataFrame) -> DataFrame:
    """``id → schema_type`` for every registered content. Ids stay resolvable after a soft
    delete, as messages written with them still exist; an id with no version left after
    permanent deletes is unknown."""
    return (current_view(changes, include_deleted=True).groupBy("id")
            .agg(F.first("schema_type").alias("schema_type")))


def _id_side(ids: DataFrame, used: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``ids(_sid, …)``, or, when they are many, those of them that ``used(_sid)`` names."""
    max_rows = DEFAULT_MAX_ROWS if max_rows is None else max_rows
    if is_small(ids, max_rows):
        return F.broadcast(ids)
    cut = ids.join(used.select("_sid").distinct(), "_sid", "left_semi")
    return broadcast_if_small(cut, max_rows)


def decode_column(df: DataFrame, col: str, ids: DataFrame, out: str, status: str) -> DataFrame:
    """Add ``out`` (canonical JSON text) and ``status`` (NULL or an error code) for the
    framed binary column ``col``; a NULL message stays NULL with NULL status."""
    df = df.withColumn("_sid", codec.wire_schema_id(F.col(col)))
    side = _id_side(ids.select(F.col("id").alias("_sid"), F.col("schema_type").alias("_stype")),
                    df.select("_sid").where(F.col("_sid").isNotNull()))
    df = df.join(side, "_sid", "left")
    df = df.withColumn("_text", codec.wire_payload_text(F.col(col)))
    df = df.withColumn("_parsed", F.try_parse_json(F.col("_text")))
    df = df.withColumn(status, codec.decode_status(F.col(col), F.col("_stype"), F.col("_text"), F.col("_parsed")))
    df = df.withColumn(out, F.when(F.col(status).isNull(), F.to_json(F.col("_parsed"))))
    return df.drop("_sid", "_stype", "_text", "_parsed")


def decode_messages(df: DataFrame, ids: DataFrame, col: str = "message", out: str = "value",
                    mode: str = "strict") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Decode framed messages into JSON text.

    ``mode='strict'``: a bad record fails the query, whatever columns are then read or
    counted (``raise_error`` in a filter, which no column pruning removes, with the
    record's topic/partition/offset and code). ``'null'``: bad records decode to NULL and
    keep their code in ``<out>_error``. ``'quarantine'``: returns ``(good, bad)``; ``bad``
    carries the error report fields and the record's whole key and message.
    """
    if mode not in MODES:
        raise ValueError(f"unknown decode mode {mode!r}")
    status = f"{out}_error"
    dec = decode_column(df, col, ids, out, status)
    if mode == "null":
        return dec.drop(col)
    if mode == "quarantine":
        good = dec.where(F.col(status).isNull()).drop(col, status)
        bad = error_report(dec.where(F.col(status).isNotNull()), col, status)
        return good, bad
    return _fail_on(dec, status).drop(col, status)


MODES = ("strict", "null", "quarantine")


def _fail_on(df: DataFrame, status: str) -> DataFrame:
    """Fail the query at the first record with an error code. A filter, so that counting or
    selecting other columns cannot skip the check."""
    text = F.concat(F.lit("Error: cannot decode message ("), F.col(status), F.lit(") topic='"),
                    F.col("topic"), F.lit("', partition="), F.col("partition").cast("string"),
                    F.lit(", offset="), F.col("offset").cast("string"))
    return df.where(F.when(F.col(status).isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))


def error_report(bad: DataFrame, col: str, status: str) -> DataFrame:
    """Quarantine rows: where the record is, what is wrong, and a formatted message
    listing only the fields that are present."""
    summary = codec.hex_summary(F.col(col))
    msg = F.concat_ws(", ",
                      F.concat(F.lit("Error: "), F.col(status), F.lit(" topic='"), F.col("topic"), F.lit("'")),
                      F.concat(F.lit("partition="), F.col("partition").cast("string")),
                      F.concat(F.lit("offset="), F.col("offset").cast("string")),
                      F.concat(F.lit("payload: "), summary))
    raw = [F.col(c).alias(f"raw_{c}") for c in dict.fromkeys(["key", "message", col]) if c in bad.columns]
    return bad.select("topic", "partition", "offset", F.col(status).alias("error_code"),
                      summary.alias("payload"), msg.alias("error_message"), *raw)


def scan_topic_decoded(spark: SparkSession, log: TopicLog, registry: Registry, topic: str,
                       mode: str = "strict") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Registry-aware scan. The latest ``<topic>-key`` / ``<topic>-value`` subjects decide,
    when the frame is built, whether ``key`` becomes JSON text and whether ``message`` is
    replaced by a JSON ``value`` column; a subject of another schema type is an error.

    ``mode='null'`` adds ``key_error`` / ``value_error`` for the decoded columns, so a bad
    record never looks like a tombstone; ``'quarantine'`` returns ``(good, bad)``, where
    ``bad`` reports the first failing column with the record's whole bytes."""
    if mode not in MODES:
        raise ValueError(f"unknown decode mode {mode!r}")
    name = parse_topic_uri(topic)
    require_topics(spark, log, [name])
    subj = [f"{name}-key", f"{name}-value"]
    latest = {r.subject: r.schema_type for r in
              schema_latest(registry.current(spark)).where(F.col("subject").isin(subj))
              .select("subject", "schema_type").collect()}
    for s, t in latest.items():
        if t is None:
            raise DecodeError(f"subject {s!r} has no schema type in the registry")
        if t != "JSON":
            raise DecodeError(f"subject {s!r} is of schema type {t!r}; only JSON can be decoded")
    df = log.records(spark).where(F.col("topic") == F.lit(name)).select(*SCAN_COLUMNS)
    ids = registry_ids(registry.changes(spark))
    decoded = [(c, o) for c, o, subject in (("key", "key", f"{name}-key"), ("message", "value", f"{name}-value"))
               if subject in latest]
    for c, o in decoded:
        df = decode_column(df, c, ids, f"_{o}", f"{o}_error")
    cols = ["topic", "partition", "offset"]
    cols += [F.col("_key").alias("key") if f"{name}-key" in latest else F.col("key")]
    cols += [F.col("_value").alias("value") if f"{name}-value" in latest else F.col("message")]
    errors = [f"{o}_error" for _, o in decoded]
    if mode == "null":
        return df.select(*cols, *errors)
    if mode == "quarantine":
        first = F.coalesce(*[F.concat(F.lit(f"{o}: "), F.col(f"{o}_error")) for _, o in decoded],
                           F.lit(None).cast("string"))
        raw = F.coalesce(*[F.when(F.col(f"{o}_error").isNotNull(), F.col(c)) for c, o in decoded],
                         F.lit(None).cast("binary"))
        df = df.withColumns({"_first": first, "_raw": raw})
        bad = error_report(df.where(F.col("_first").isNotNull()), "_raw", "_first")
        return df.where(F.col("_first").isNull()).select(*cols), bad.drop("raw__raw")
    for e in errors:
        df = _fail_on(df, e)
    return df.select(*cols)


def encode_json(spark: SparkSession, registry: Registry, df: DataFrame, topic_col: str, schema_col: str,
                data_col: str, normalize: bool = True, validate: bool = True) -> tuple[DataFrame, DataFrame]:
    """Bulk form of serialise-with-registry: each row's ``data`` JSON under its topic's
    value subject and ``schema``. Distinct ``(subject, schema)`` pairs are registered
    once (new ids / versions where needed); the ids are joined back and the frame is
    built with column expressions. Returns ``(encoded, registry change rows)``;
    ``encoded`` replaces ``data_col`` by ``message`` (binary) and adds ``schema_id``.

    A row with NULL topic, schema or data gives a NULL message (NULL in, NULL out) and is
    kept. Data that is not JSON fails the query, also without ``validate``. With
    ``validate`` (the default, as for serialisation with validation), every row is checked
    against its schema as data (:func:`topiclake.operators.validation.validate_rows`), however many
    schemas the batch has; a violation fails the query.
    """
    pairs = (df.select(subject_for(F.col(topic_col), False).alias("subject"),
                       F.col(schema_col).alias("schema")).where("subject is not null and schema is not null")
             .distinct().withColumn("schema_type", F.lit("JSON")))
    # request order = (subject, schema) text order, so new ids are reproducible
    batch = pairs.withColumn("req", F.concat_ws("\n", "subject", "schema"))
    changes, results = register_schemas(registry.changes(spark), batch, normalize=normalize)
    # the canonical form is what was registered: match requests on the original text.
    # One row per distinct (subject, schema): materialised once, then broadcast-checked.
    ids = batch.join(results.select("req", F.col("id").alias("schema_id")), "req").select(
        F.col("subject").alias("_enc_subject"), F.col("schema").alias("_enc_schema"), "schema_id").checkpoint(eager=True)
    subject = subject_for(F.col(topic_col), False)
    out = df.withColumn("_enc_key", subject)
    out = out.join(broadcast_if_small(ids), (out["_enc_key"] == ids["_enc_subject"])
                   & (out[schema_col] == ids["_enc_schema"]), "left").drop("_enc_subject", "_enc_schema", "_enc_key")
    complete = F.col("schema_id").isNotNull() & F.col(data_col).isNotNull()
    out = out.withColumn("_enc_parsed", F.when(complete, F.try_parse_json(F.col(data_col))))
    problem = F.when(complete & F.col("_enc_parsed").isNull(), F.lit("$: not JSON"))
    if validate:
        out = validate_rows(out, "_enc_parsed", schema_col, "_enc_checks")
        joined = F.array_join("_enc_checks", "; ")
        problem = problem.when(complete & (joined != ""), joined)
    out = out.withColumn("_enc_problem", problem)
    fail = F.raise_error(F.concat(F.lit("Error: data does not match its schema ("), F.col("_enc_problem"),
                                  F.lit(") subject='"), subject, F.lit("'")))
    out = out.where(F.when(F.col("_enc_problem").isNull(), F.lit(True)).otherwise(fail.cast("boolean")))
    message = F.when(complete, codec.wire_encode(F.col("schema_id"), F.to_json(F.col("_enc_parsed"))))
    out = out.withColumn("message", message).drop(data_col, "_enc_parsed", "_enc_problem", "_enc_checks")
    return out, changes
