"""Session defaults and the shared working folder.

Everything this package materialises (fixture topic logs, checkpoints, sink tables of
streaming runs) lives under the folder the cluster names in ``spark.checkpoint.dir``.
That folder is read from the session (or is the checkpoint folder already set on the
context); a private one is created only for a local master without either, as in tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this package wants. Shuffle partitions are sized for local
# runs; on a cluster pass ``shuffle_partitions`` (or let AQE coalesce from a large value).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # JSON objects with a repeated key keep the last value, as the message decoder does.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Partition columns come from the explicit log schema, never from inference.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "topiclake",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options this package relies on (safe on an existing session)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys",
              "spark.sql.sources.partitionColumnTypeInference.enabled"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # pragma: no cover - static conf on a foreign session
            pass


_LOCAL_DIR: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-visible working folder (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a private folder created and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` works as well.
    """
    global _LOCAL_DIR
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="topiclake-ckpt-")
        d = _LOCAL_DIR
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def workspace(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder, e.g. ``workspace(spark, 'fixtures', 'sf0.01')``."""
    return "/".join([shared_dir(spark), "topiclake", *parts])


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a run over ``input_bytes`` of topic log on ``total_cores``.

    Scan splits of ``target_partition_bytes`` (256 MiB); the initial shuffle partition
    count is such that a shuffle of the whole input lands near the target size per
    partition (at least twice the cores); AQE then coalesces small partitions toward the
    advisory size and splits skewed ones. For 100 TB on 1000 executors x 8 cores this
    gives ~400k initial partitions, coalesced at run time.
    """
    initial = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # broadcasts are decided by explicit, size-checked hints; keep the automatic one small
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
