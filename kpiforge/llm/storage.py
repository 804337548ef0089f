"""Tables written between the steps of a job, under the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the data set at ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: Spark removes those of a query at
    its end, not when the driver next happens to collect its garbage, so a job of
    many steps holds those of one step on disk."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again.
    This cuts the lineage, so a lost executor costs a re-read, not a re-run."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows and bytes of an Arrow batch at most: texts are up to megabytes, and each task
# holds a batch on both sides of its Python worker
ARROW_ROWS, ARROW_BYTES = 1_000, 4 << 20


def visible(spark: SparkSession) -> None:
    """Prepare a session for the operators: let the Python workers find this
    package where the driver found it, for runs whose PYTHONPATH doesn't name it
    (a cluster is given it by --py-files), and bound Arrow batches, unless
    the session has smaller bounds."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = spark.conf.get(name).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([*paths, root])
