"""Session helpers: UTC pinning and the shared scratch folder.

Scratch output (streaming checkpoints, keyed log tables, cold-lake copies made by the
query catalogue) always lives under the cluster's shared checkpoint folder, read from the
session (``spark.checkpoint.dir`` / ``SparkContext.getCheckpointDir``). Only when that is
unset *and* the master is local (tests, laptops) does this module create its own folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(
    master: str = "local[*]",
    app_name: str = "txnscope",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session configured the way the library expects.

    On a cluster, pass ``master=None``-equivalent settings through spark-submit instead and
    only call :func:`pin_utc`; this builder exists for tests, benches and notebooks.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # RocksDB keeps windowed-aggregation state off the JVM heap and spills to disk.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    return spark


# Starting points for a large cluster (order of 1000 executors, ~100 TB of input). The
# shuffle partition count is an upper bound that AQE coalesces down to ~256 MB per
# partition at runtime; it is fixed for stateful streaming queries at their first start,
# so choose it for the largest expected state. Skewed shuffle partitions are split by AQE.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.metricsEnabled": "true",
}
# For executors with small heaps. Aggregations over sparse keys (1-minute windows per user,
# sliding windows) spill their hash maps many times, and merging the spills allocates
# read-ahead buffers for every spill file at once. On 8 threads with a 1 GB heap, the
# sliding-window aggregation of a 20M-row table ran out of memory with read-ahead and
# completed without it.
LOW_MEMORY_CONF = {"spark.unsafe.sorter.spill.read.ahead.enabled": "false"}

# State-store partitions for streaming queries (``state_partitions=`` of the start_*
# functions): sized for the state (open windows x users), not for batch scans.
STREAMING_STATE_PARTITIONS = 400


# Fixed by a streaming query at its first start.
STREAMING_CONF = {k: v for k, v in CLUSTER_CONF.items() if k.startswith("spark.sql.streaming.stateStore.")}


def prepare_streaming(spark: SparkSession) -> None:
    """State settings for queries about to start; what the user has set stays."""
    for key, value in STREAMING_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def pin_utc(spark: SparkSession) -> None:
    """Window alignment, calendar partition columns and ISO text all assume UTC."""
    spark.conf.set("spark.sql.session.timeZone", UTC)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads the session's checkpoint folder. If none is configured on a local master, a
    private folder is created and registered as the checkpoint folder (test setup). On a
    cluster an unset folder is an error: a machine-local path would not survive the loss
    of the executor or driver host that wrote it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a driver-side context (Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir().rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared (HDFS/object store) folder "
            "for checkpoints and intermediate tables"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="txnscope-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared root (not created here)."""
    return f"{shared_root(spark)}/txnscope/{name}-{uuid.uuid4().hex[:12]}"
