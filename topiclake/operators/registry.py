"""A schema registry kept as a change log, queried and updated with DataFrame jobs.

Change log rows: ``seq, op, subject, version, id, guid, schema_type, schema, deleted``
with ``op`` one of ``register``, ``soft_delete``, ``hard_delete``. One batch of changes
shares one ``seq``. The *current view* is the last change per ``(subject, version)``;
permanently deleted versions drop out, soft-deleted ones stay, flagged.

Single-key registry calls become filters; the bulk forms join a DataFrame of keys to
the current view, so millions of lookups cost one join instead of millions of calls.
Writes (register, delete) return the change rows; :meth:`Registry.append` persists them.
:meth:`Registry.commit` does both under a claim of the next ``seq``, so many writers may commit
at once; ``append`` alone assumes one writer.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import canonical_json
from ..plans.sizing import broadcast_if_small, is_small
from .offsets import assign_dense

REGISTRY_LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("subject", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("id", T.IntegerType(), True),
    T.StructField("guid", T.StringType(), True),
    T.StructField("schema_type", T.StringType(), True),
    T.StructField("schema", T.StringType(), True),
    T.StructField("deleted", T.BooleanType(), False),
])



def _create(spark: SparkSession, name: str) -> bool:
    """Create an empty file; False when it is there already. Atomic on stores whose create without
    overwrite is (HDFS, object stores with conditional puts) and on local disks."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            local = jvm.java.io.File(path.toUri().getPath())
            return bool(local.createNewFile())
        fs.create(path, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise


# Columns of a registered schema, in the order a lookup returns them.
SCHEMA_COLUMNS = ["id", "guid", "subject", "version", "schema_type", "schema"]


class SchemaNotFound(LookupError):
    """A strict lookup found no matching schema."""


@dataclass(frozen=True)
class Registry:
    root: str

    @property
    def changes_path(self) -> str:
        return f"{self.root}/changes"

    def changes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(REGISTRY_LOG_SCHEMA).parquet(self.changes_path)

    def current(self, spark: SparkSession, include_deleted: bool = False) -> DataFrame:
        return current_view(self.changes(spark), include_deleted)

    def append(self, change_rows: DataFrame) -> None:
        change_rows.select(*REGISTRY_LOG_SCHEMA.fieldNames()).write.mode("append").parquet(self.changes_path)

    def commit(self, spark: SparkSession, plan: Callable[[DataFrame], DataFrame], patience: float = 300.0) -> DataFrame:
        """Append the change rows that ``plan(changes)`` gives, safe beside other writers.

        The batch's ``seq`` is claimed by creating a file that must not exist yet. A writer that
        finds it claimed plans again once the other's rows are there, so no id, version or ``seq`` is
        given twice. A claim whose writer died blocks its ``seq`` until :meth:`release`; waiting longer
        than ``patience`` seconds raises ``TimeoutError``. Returns the rows (none: nothing is claimed).
        """
        names, until = REGISTRY_LOG_SCHEMA.fieldNames(), time.monotonic() + patience
        while True:
            rows = plan(self.changes(spark)).select(*names).checkpoint(eager=True)
            top = rows.agg(F.max("seq")).first()[0]
            if top is None:
                return rows
            if _create(spark, self._claim(top)):
                self.append(rows)
                return rows
            while (self.changes(spark).agg(F.max("seq")).first()[0] or 0) < top:
                if time.monotonic() > until:
                    raise TimeoutError(f"seq {top} is claimed, but its writer has not written it")
                time.sleep(0.2)

    def release(self, spark: SparkSession, seq: int) -> None:
        """Drop the claim of a writer that is known to have died before it wrote."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self._claim(seq))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)

    def _claim(self, seq: int) -> str:
        return f"{self.root}/claims/{seq}"


def content_hash(schema_type: Column, schema: Column) -> Column:
    return F.sha2(F.concat(schema_type, F.lit(":"), schema), 256)


def content_guid(schema_type: Column, schema: Column) -> Column:
    """Deterministic GUID of a schema's content (8-4-4-4-12 hex of its hash)."""
    h = content_hash(schema_type, schema)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


# ------------------------------------------------------------------------------ R0 view


def current_view(changes: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Last change per ``(subject, version)``; ``max_by`` aggregates partially per task,
    so a subject with very many versions is combined before the shuffle."""
    last = (changes.groupBy("subject", "version")
            .agg(F.max_by(F.struct(*[c for c in REGISTRY_LOG_SCHEMA.fieldNames()
                                     if c not in ("subject", "version")]), F.col("seq")).alias("_c"))
            .select("subject", "version", "_c.*"))
    last = last.where(F.col("op") != "hard_delete")
    if not include_deleted:
        last = last.where(~F.col("deleted"))
    return last.select(*SCHEMA_COLUMNS, "deleted")


# ------------------------------------------------------------------------ R2-R7 lookups


def schema_by_subject_id(current: DataFrame, keys: DataFrame, strict: bool = False) -> DataFrame:
    """``(subject, id)`` → ``schema_type, schema`` (+ ``found``); NULLs when absent."""
    right = (current.select("subject", "id", "schema_type", "schema")
             .dropDuplicates(["subject", "id"]).withColumn("found", F.lit(True)))
    out = keys.join(right, ["subject", "id"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return _strict(out, strict)


def schema_by_guid(current: DataFrame, keys: DataFrame, strict: bool = False) -> DataFrame:
    """``guid`` → ``schema_type, schema``; a guid names one content, shared by subjects."""
    right = (current.groupBy("guid").agg(F.min_by(F.struct("schema_type", "schema"), F.col("id")).alias("_s"))
             .select("guid", "_s.*").withColumn("found", F.lit(True)))
    out = keys.join(right, "guid", "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return _strict(out, strict)


def schema_by_version(current: DataFrame, keys: DataFrame, strict: bool = False) -> DataFrame:
    """``(subject, version)`` → the six schema columns; deleted versions are not visible."""
    right = current.select(*SCHEMA_COLUMNS).withColumn("found", F.lit(True))
    out = keys.join(right, ["subject", "version"], "left").withColumn("found", F.coalesce("found", F.lit(False)))
    return _strict(out, strict)


def schema_latest(current: DataFrame, subjects: DataFrame | None = None) -> DataFrame:
    """Highest live version per subject, six columns (``max_by`` with partial aggregation)."""
    latest = (current.groupBy("subject")
              .agg(F.max_by(F.struct(*[c for c in SCHEMA_COLUMNS if c != "subject"]), F.col("version")).alias("_l"))
              .select("subject", "_l.*").select(*SCHEMA_COLUMNS))
    if subjects is None:
        return latest
    return subjects.join(latest, "subject", "left")


def versions(current: DataFrame, subjects: DataFrame | None = None) -> DataFrame:
    """One row per live version: ``subject, version``."""
    v = current.select("subject", "version")
    return v if subjects is None else v.join(subjects.select("subject").distinct(), "subject", "left_semi")


def subjects(changes: DataFrame, deleted: bool = False) -> DataFrame:
    """Subjects with a live version, or with any non-permanently-deleted version."""
    return current_view(changes, include_deleted=deleted).select("subject").distinct()


def _strict(out: DataFrame, strict: bool) -> DataFrame:
    if strict:
        miss = out.where(~F.col("found")).limit(1).collect()
        if miss:
            raise SchemaNotFound(f"Schema not found: {miss[0].asDict()}")
    return out


# ------------------------------------------------------------------------------- writes


def _next_seq(changes: DataFrame) -> Column:
    return F.lit(int((changes.agg(F.max("seq")).first()[0] or 0) + 1)).cast("long")


def register_schemas(changes: DataFrame, batch: DataFrame, normalize: bool = False,
                     ) -> tuple[DataFrame, DataFrame]:
    """Bulk registration. ``batch(req, subject, schema_type, schema)``; ``req`` orders it.

    Per request: if the subject already holds this content as a live version, that
    version is returned; otherwise the content keeps the id it has anywhere in the
    registry, or gets the next new id (new contents numbered in order of first request),
    and the subject gets the next version after its highest. Returns
    ``(change_rows, results)``; results have ``req`` and the six schema columns.
    """
    schema = (F.when(F.col("schema_type") == "JSON", F.coalesce(canonical_json(F.col("schema")), F.col("schema")))
              .otherwise(F.col("schema")) if normalize else F.col("schema"))
    b = batch.select("req", "subject", "schema_type", schema.alias("schema"))
    b = b.withColumn("_h", content_hash(F.col("schema_type"), F.col("schema")))

    every = current_view(changes, include_deleted=True)
    live = every.where(~F.col("deleted"))
    live_h = live.select("subject", "version", "id",
                         content_hash(F.col("schema_type"), F.col("schema")).alias("_h"))
    # one live version per (subject, content): the lowest
    live_h = live_h.groupBy("subject", "_h").agg(F.min_by(F.struct("version", "id"), F.col("version")).alias("_v"))
    # requests marked with their existing live version; read by both branches below,
    # so materialised once (batch-sized) instead of re-joined per branch
    b = b.join(live_h, ["subject", "_h"], "left").checkpoint(eager=True)
    existing = b.where(F.col("_v").isNotNull()).select("req", "subject", "schema_type", "schema", "_h",
                                                       F.col("_v.version").alias("version"),
                                                       F.col("_v.id").alias("id"))
    fresh = b.where(F.col("_v").isNull()).drop("_v")

    # ids: a content registered anywhere (changes, incl. deleted) keeps its id
    known_ids = (changes.where(F.col("op") == "register")
                 .select(content_hash(F.col("schema_type"), F.col("schema")).alias("_h"), "id")
                 .groupBy("_h").agg(F.min("id").alias("_known")))
    top = changes.agg(F.max("seq").alias("s"), F.max("id").alias("i")).first()
    max_seq, max_id = int(top.s or 0), int(top.i or 0)
    new_contents = (fresh.groupBy("_h").agg(F.min("req").alias("_first"))
                    .join(known_ids, "_h", "left"))
    # new contents numbered densely in order of first request: a window when the set is
    # proven small, else the distributed numbering (no single task holds the set)
    unknown = new_contents.where(F.col("_known").isNull())
    if is_small(unknown):
        unknown = unknown.withColumn("_new", F.lit(max_id) + F.row_number().over(Window.orderBy("_first", "_h")))
    else:
        unknown = assign_dense(unknown, [], ["_first", "_h"], "_new", base=max_id + 1)
    ids = (new_contents.where(F.col("_known").isNotNull()).select("_h", F.col("_known").alias("id"))
           .unionByName(unknown.select("_h", F.col("_new").cast("int").alias("id"))))

    # versions: first request of each (subject, content) gets max version + rank
    pairs = fresh.groupBy("subject", "_h").agg(F.min("req").alias("_first"))
    max_ver = changes.groupBy("subject").agg(F.max("version").alias("_maxv"))
    pairs = pairs.join(max_ver, "subject", "left").withColumn(
        "version", (F.coalesce("_maxv", F.lit(0)) + F.row_number().over(
            Window.partitionBy("subject").orderBy("_first"))).cast("int")).drop("_maxv", "_first")
    fresh = fresh.join(pairs, ["subject", "_h"]).join(ids, "_h").checkpoint(eager=True)

    seq = F.lit(max_seq + 1).cast("long")
    change_rows = (fresh.groupBy("subject", "version", "id", "schema_type", "schema").agg(F.min("req").alias("_r"))
                   .select(seq.alias("seq"), F.lit("register").alias("op"), "subject", "version", "id",
                           content_guid(F.col("schema_type"), F.col("schema")).alias("guid"),
                           "schema_type", "schema", F.lit(False).alias("deleted")))
    results = existing.unionByName(fresh.select(*existing.columns)).select(
        "req", "id", content_guid(F.col("schema_type"), F.col("schema")).alias("guid"),
        "subject", "version", "schema_type", "schema")
    return change_rows, results


def delete_subjects(changes: DataFrame, subject_keys: DataFrame, permanent: bool = False,
                    ) -> tuple[DataFrame, DataFrame]:
    """Soft delete: every live version of the subjects is flagged deleted. Permanent:
    versions already soft-deleted are removed for good. Returns ``(change_rows,
    results(subject, deleted_version))``."""
    every = current_view(changes, include_deleted=True)
    target = every.where(F.col("deleted") if permanent else ~F.col("deleted"))
    target = target.join(subject_keys.select("subject").distinct(), "subject", "left_semi")
    return _deletion(changes, target, permanent)


def delete_subject_versions(changes: DataFrame, keys: DataFrame, permanent: bool = False,
                            ) -> tuple[DataFrame, DataFrame]:
    """As :func:`delete_subjects`, for explicit ``(subject, version)`` keys."""
    every = current_view(changes, include_deleted=True)
    target = every.where(F.col("deleted") if permanent else ~F.col("deleted"))
    target = target.join(keys.select("subject", "version").distinct(), ["subject", "version"], "left_semi")
    return _deletion(changes, target, permanent)


def _deletion(changes: DataFrame, target: DataFrame, permanent: bool) -> tuple[DataFrame, DataFrame]:
    seq = _next_seq(changes)
    rows = target.select(seq.alias("seq"), F.lit("hard_delete" if permanent else "soft_delete").alias("op"),
                         "subject", "version", "id", "guid", "schema_type", "schema",
                         F.lit(True).alias("deleted"))
    return rows, target.select("subject", F.col("version").alias("deleted_version"))


# --------------------------------------------------------------------------- R10 naming


def subject_for(topic: Column, is_key: bool) -> Column:
    return F.concat(topic, F.lit("-key" if is_key else "-value"))


def topic_subject_coverage(catalog: DataFrame, current: DataFrame) -> DataFrame:
    """Per topic: the latest key / value schema id and type (NULL when no subject).

    The catalogue (one row per topic) is the small side: its two subject names per topic
    are broadcast into the registry's latest view, then the few hits are pivoted.
    """
    wanted = catalog.select("topic", F.explode(F.array(
        F.struct(F.lit("key").alias("role"), subject_for(F.col("topic"), True).alias("subject")),
        F.struct(F.lit("value").alias("role"), subject_for(F.col("topic"), False).alias("subject")))).alias("_w")
    ).select("topic", "_w.role", "_w.subject")
    latest = schema_latest(current).select("subject", "id", "schema_type")
    hits = latest.join(broadcast_if_small(wanted), "subject")
    per_topic = hits.groupBy("topic").agg(
        F.max(F.when(F.col("role") == "key", F.col("id"))).alias("key_schema_id"),
        F.max(F.when(F.col("role") == "key", F.col("schema_type"))).alias("key_schema_type"),
        F.max(F.when(F.col("role") == "value", F.col("id"))).alias("value_schema_id"),
        F.max(F.when(F.col("role") == "value", F.col("schema_type"))).alias("value_schema_type"))
    return catalog.select("topic").join(per_topic, "topic", "left")


# ------------------------------------------------------------------- J1 (single subject)


def latest_structure(current: DataFrame, subject: str) -> str:
    """Structure text of a subject's latest schema, constant for the query that uses it
    (resolved once, on the driver). Errors: unknown subject, no schema type, a type
    other than JSON, no schema text, unparsable schema."""
    from ..functions.jsonschema import structure_text
    row = schema_latest(current).where(F.col("subject") == F.lit(subject)).first()
    if row is None:
        raise SchemaNotFound(f"no live schema under subject {subject!r}")
    if row.schema_type is None:
        raise ValueError(f"subject {subject!r} has no schema type")
    if row.schema_type != "JSON":
        raise ValueError(f"subject {subject!r} is of type {row.schema_type!r}, not JSON")
    if row.schema is None:
        raise ValueError(f"subject {subject!r} has no schema text")
    return structure_text(row.schema)


def subject_structure(current: DataFrame, subject: str):
    """The structure that holds the messages of every version of a subject (parsed form; see
    :func:`topiclake.functions.jsonschema.merge_structures`). Versions are read as distinct
    structures, not as schema texts. Errors as for :func:`latest_structure`."""
    import json

    from ..functions.jsonschema import merge_structures, structure_text_udf
    rows = (current.where(F.col("subject") == F.lit(subject))
            .select("schema_type", F.when(F.col("schema_type") == "JSON", structure_text_udf(F.col("schema"))).alias("s"))
            .distinct().collect())
    if not rows:
        raise SchemaNotFound(f"no live schema under subject {subject!r}")
    if any(r.schema_type != "JSON" for r in rows):
        raise ValueError(f"subject {subject!r} has versions that are not JSON")
    if any(r.s is None for r in rows):
        raise ValueError(f"subject {subject!r} has a version without a readable schema")
    return functools.reduce(merge_structures, [json.loads(r.s) for r in sorted(rows, key=lambda r: r.s)])


def latest_structures(current: DataFrame) -> DataFrame:
    """``subject, version, structure`` of every subject whose latest schema is JSON; the helper runs
    over distinct schema texts."""
    from ..functions.jsonschema import structure_text_udf
    latest = schema_latest(current).where(F.col("schema_type") == "JSON")
    texts = latest.select("schema").distinct().withColumn("structure", structure_text_udf(F.col("schema")))
    return latest.join(texts, "schema").select("subject", "version", "structure")


def merged_structures(current: DataFrame) -> DataFrame:
    """``subject, versions, structure``: what holds the messages of all live JSON versions of a
    subject, so rows written with different versions fit one projection."""
    from ..functions.jsonschema import merge_texts_udf, structure_text_udf
    live = current.where(F.col("schema_type") == "JSON")
    texts = live.select("schema").distinct().withColumn("structure", structure_text_udf(F.col("schema")))
    per = (live.join(texts, "schema").groupBy("subject")
           .agg(F.count(F.lit(1)).alias("versions"), F.sort_array(F.collect_set("structure")).alias("all")))
    merged = per.select("all").distinct().withColumn("structure", merge_texts_udf(F.col("all")))
    return per.join(merged, "all").select("subject", "versions", "structure")
