"""Registry change log: current view, lookups, registration and deletes."""
from pyspark.sql import functions as F

from topiclake.operators import registry as reg
from topiclake.operators.registry import Registry


def test_current_view_hides_deleted(spark, fx):
    cur = fx.registry.current(spark)
    assert cur.where(F.col("subject") == "conversations-value").count() == 0
    every = reg.current_view(fx.registry.changes(spark), include_deleted=True)
    assert every.where(F.col("subject") == "conversations-value").count() == 1


def test_latest_picks_highest_live_version(spark, fx):
    latest = {r.subject: (r.version, r.id) for r in reg.schema_latest(fx.registry.current(spark)).collect()}
    assert latest["events-value"] == (2, 2)
    assert latest["copy-value"] == (1, 1)


def test_register_is_idempotent_and_shares_ids(spark, fx, scratch):
    r = Registry(scratch)
    fx.registry.changes(spark).write.parquet(r.changes_path)
    batch = spark.createDataFrame(
        [(1, "new-value", "JSON", '{"type":"string"}'), (2, "other-value", "JSON", '{"type":"string"}'),
         (3, "events-value", "JSON", '{"type":"integer"}')], "req long, subject string, schema_type string, schema string")
    rows, res = reg.register_schemas(r.changes(spark), batch)
    res1 = {x.req: (x.id, x.version) for x in res.collect()}
    r.append(rows)
    assert res1[1][0] == 5            # same content as conversations-value v1: id kept
    assert res1[2][0] == res1[1][0]   # shared across subjects
    assert res1[3] == (3, 3)          # known content (orders-key), next version of events-value
    rows2, res2 = reg.register_schemas(r.changes(spark), batch)
    assert {x.req: (x.id, x.version) for x in res2.collect()} == res1
    assert rows2.count() == 0


def test_soft_then_permanent_delete(spark, fx, scratch):
    r = Registry(scratch)
    fx.registry.changes(spark).write.parquet(r.changes_path)
    subj = spark.createDataFrame([("events-value",)], "subject string")
    rows, res = reg.delete_subjects(r.changes(spark), subj)
    assert sorted(x.deleted_version for x in res.collect()) == [1, 2]
    r.append(rows)
    assert reg.subjects(r.changes(spark)).where(F.col("subject") == "events-value").count() == 0
    assert reg.subjects(r.changes(spark), deleted=True).where(F.col("subject") == "events-value").count() == 1
    rows, res = reg.delete_subjects(r.changes(spark), subj, permanent=True)
    r.append(rows)
    assert reg.subjects(r.changes(spark), deleted=True).where(F.col("subject") == "events-value").count() == 0


def test_strict_lookup_raises(spark, fx):
    import pytest
    keys = spark.createDataFrame([("nope", 1)], "subject string, version int")
    with pytest.raises(reg.SchemaNotFound):
        reg.schema_by_version(fx.registry.current(spark), keys, strict=True)


def test_latest_structure_and_errors(spark, fx):
    import pytest
    cur = fx.registry.current(spark)
    assert reg.latest_structure(cur, "events-value") == '{"cents":"BIGINT","event_id":"BIGINT","event_type":"VARCHAR"}'
    assert reg.latest_structure(cur, "orders-key") == '"BIGINT"'   # primitive root: quoted
    with pytest.raises(ValueError, match="not JSON"):
        reg.latest_structure(cur, "lineitem-value")
    with pytest.raises(reg.SchemaNotFound):
        reg.latest_structure(cur, "conversations-value")        # soft-deleted: invisible
