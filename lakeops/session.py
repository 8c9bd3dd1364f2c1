"""Session profile and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on; safe to set on any running session.
RESULT_SETTINGS = {"spark.sql.session.timeZone": "UTC"}

# Settings for speed. A cluster may override any of them at submit time.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Checkpoint files go when their frame does.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state on local disk rather than on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "lakeops", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the profile applied; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_profile(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def sibling_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A session on the same context and catalog with its own SQL settings (`__` for dots).

    Settings are read when a query runs, so a lazily returned frame needs a session of
    its own rather than a setting that is put back afterwards.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    for key, value in conf.items():
        sibling.conf.set(key.replace("__", "."), value)
    return apply_profile(sibling)


def skew_session(
    spark: SparkSession, threshold: str = "256MB", factor: float = 5.0, piece: str = "64MB", **conf: str
) -> SparkSession:
    """A sibling session tuned for adaptive skew joins.

    A partition above `threshold` and `factor` times the median is cut into pieces of
    about `piece`.
    """
    return sibling_session(
        spark,
        spark__sql__adaptive__enabled="true",
        spark__sql__adaptive__skewJoin__enabled="true",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes=threshold,
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=str(factor),
        spark__sql__adaptive__advisoryPartitionSizeInBytes=piece,
        spark__sql__adaptive__forceOptimizeSkewedJoin="true",
        **conf,
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`, with checkpoints enabled.

    Only a local master may fall back to a temporary folder: on a cluster that folder
    would exist on one machine only.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if root is None:
        root = tempfile.mkdtemp(prefix="lakeops-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table or a checkpoint."""
    return f"{scratch_root(spark)}/lakeops/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
