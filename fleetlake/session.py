"""Session construction and shared-storage helpers.

Everything that must hold for correct results is set here once:

* ``spark.sql.session.timeZone=UTC`` – capture times arrive as UTC text; parsing
  them under a local session zone would shift them twice.
* ``spark.sql.sources.partitionColumnTypeInference.enabled=false`` – partition
  values such as ``hora_id_ref=05`` must stay strings.
* AQE on, with skew-join splitting, so a hot line or hour does not pin one task.

Scratch output (lineage cuts, staged upserts) goes below the directory the
cluster names in ``spark.checkpoint.dir``; a private one is made only when that
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# Tuning defaults, applied only when the cluster configuration does not set them.
# With AQE's default parallelism-first coalescing, minPartitionSize is the only
# floor; a small floor keeps small shuffles (gold tables, hour lists) spread over
# the cores instead of one task, and has no effect on large shuffles.
DEFAULT_TUNING = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
}


def build_session(master: str | None = None, app: str = "fleetlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    launch = spark.sparkContext.getConf()
    for k, v in DEFAULT_TUNING.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir); only when neither is set – local runs – a private temp folder is used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _looks_like_context_subdir(current) else current
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
    sc.setCheckpointDir(root)
    return root


def _looks_like_context_subdir(path: str) -> bool:
    # SparkContext.setCheckpointDir appends a random UUID directory.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/fleetlake/{name}-{uuid.uuid4().hex[:12]}"


def local_test_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (``local[N]``)."""
    extra = {"spark.driver.memory": os.environ.get("FLEETLAKE_DRIVER_MEMORY", "16g"),
             "spark.sql.execution.arrow.pyspark.enabled": "true",
             # local disk: list partition folders on the driver (a listing job costs more
             # than it saves); object stores on a cluster keep the parallel default
             "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000"}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=shuffle_partitions, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
