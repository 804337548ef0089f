"""Spark session defaults and the checkpoint folder used to cut lineage.

The library never calls ``localCheckpoint``: every job that must survive an
executor loss with a stable result (surrogate keys, running totals, snapshot
swaps) checkpoints into ``spark.checkpoint.dir``, the shared folder the cluster
names.  A private folder is only created when that setting is missing and the
master is local (tests, the driver's smoke run).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on.  AQE re-plans joins from
# runtime sizes (broadcast only below the measured threshold), splits skewed
# join partitions and coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Of written tables: a fingerprint's hex digits take half of what they take by Snappy
CODEC = "zstd"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "kpiforge", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; the UI stays off."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a private one only when
    it is unset and the master is local.  On a cluster a missing setting is an
    error, because a machine-local folder would not survive executor loss."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder "
                           "(HDFS/S3/ABFS) before running key or running-total jobs")
    d = tempfile.mkdtemp(prefix="kpiforge-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the checkpoint folder and read again: lineage is
    cut as by a checkpoint, but a reader takes only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
