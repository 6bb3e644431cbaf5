"""SparkSession construction with the settings every operator relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (UTC instants,
# case-insensitive column names) and for plans that hold at scale (AQE,
# skew-join splitting, partition coalescing).
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Sizing for a ~100 TB, ~1000-executor cluster, applied only where the
# cluster configuration leaves a key unset.  Shuffles start wide (64k
# partitions: ~20 TB of projected shuffle data at ~300 MB each) and AQE
# coalesces them toward 256 MB; scans split files at 256 MB; skewed join
# partitions above 1 GB (and 5x the median) are split.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "65536",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "65536",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def get_spark(
    app: str = "tessera",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) the session.

    On a cluster ``master`` stays None so the launcher decides, and
    ``CLUSTER_DEFAULTS`` fill the sizing keys the cluster left unset.
    Locally (tests, bench) pass ``local[N]``.  ``spark.checkpoint.dir`` is read
    from the cluster configuration; only when it is unset (tests) is a
    private scratch folder created.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in _REQUIRED_CONF.items():
        if key != "spark.ui.enabled":
            spark.conf.set(key, value)
    if not master:  # on a cluster: size for the data unless the cluster (or the caller) already decided
        explicit = spark.sparkContext.getConf()
        requested = set(extra_conf or {}) | ({"spark.sql.shuffle.partitions"} if shuffle_partitions else set())
        for key, value in CLUSTER_DEFAULTS.items():
            if not explicit.contains(key) and key not in requested:
                spark.conf.set(key, value)
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)  # clusters set theirs; it is read when a lineage cut needs it
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # executors on many machines need one shared folder; a local temp dir would lose lineage cuts
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")  # local mode only (tests, bench)
    sc.setCheckpointDir(configured)
    return configured


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage-cutting writes (merge staging, streaming state)."""
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    import uuid

    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_test_session(partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench: local[8], UTC, small shuffles."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    return get_spark(
        app="tessera-local",
        master=f"local[{cpus}]",
        shuffle_partitions=partitions,
        extra_conf={"spark.driver.memory": "8g", "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)},
    )
