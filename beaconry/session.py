"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. AQE splits a hot join key; forcing it allows the split even when an aggregate above the
# join must then shuffle its (already partially aggregated) rows once more.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # row_number() <= n limits every group before it shuffles, for n up to this
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="beaconry-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared ``spark.checkpoint.dir``.

    Where that setting is absent a temporary folder takes its place on a local master, and an error is raised on any
    other: executors would write to disks that nobody else reads.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master: {master or 'unknown'})")
        root = _local_root()
    return f"{root.rstrip('/')}/beaconry/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than cores before CPU-heavy column work.

    A table worth a cluster has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
