"""Folder-level publishing of partitioned tables: write once, check, move into place.

Rows are written one time, to a hidden folder inside the table's own folder,
partitioned like the table.  Whatever has to be checked is checked there.  Then each
staged partition folder takes the place of the table's folder of that name.
A failed load leaves the table as it was; one that stops between two moves is
completed by running it again.  A reader that lists a partition at the moment it is
swapped can miss it, as with Spark's own dynamic partition overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_name(spark: SparkSession, column: str, value: str | None) -> str:
    """The folder of one partition value, escaped as Spark writes it."""
    if value is None or value == "":
        return f"{column}={NULL_PARTITION}"
    return f"{column}=" + spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the partition folders in ``path``, sorted."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName())


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """``source`` in the place of ``target``, whose old content goes."""
    remove(spark, target)
    t, fs = _path(spark, target)
    if not fs.exists(t.getParent()):
        fs.mkdirs(t.getParent())
    if not fs.rename(_path(spark, source)[0], t):
        raise OSError(f"could not move {source} to {target}")


def stage(df: DataFrame, table_path: str, partition_by: Iterable[str]) -> str:
    """Write ``df`` once, to a new hidden folder of the table; returns it."""
    staged = f"{table_path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(staged)
    return staged


def publish(spark: SparkSession, staged: str, table_path: str, drop: Iterable[str] = (), depth: int = 1) -> None:
    """Put the staged partition folders, ``depth`` levels deep, in the place of the
    table's, remove the folders named in ``drop`` (relative), then the staging folder."""
    def below(path: str, level: int) -> Iterable[str]:
        for name in folders(spark, f"{staged}/{path}" if path else staged):
            here = f"{path}/{name}" if path else name
            if level == depth:
                yield here
            else:
                yield from below(here, level + 1)

    for name in list(below("", 1)):
        move(spark, f"{staged}/{name}", f"{table_path.rstrip('/')}/{name}")
    for name in drop:
        remove(spark, f"{table_path.rstrip('/')}/{name}")
    remove(spark, staged)


def replace_files(spark: SparkSession, staged: str, table_path: str) -> None:
    """The staged data files of a table without partitions in the place of its files."""
    t, fs = _path(spark, table_path)

    def data(path) -> list:
        return [s.getPath() for s in fs.listStatus(path) if s.isFile() and s.getPath().getName()[0] not in "_."]

    old = data(t)
    for p in data(_path(spark, staged)[0]):
        if not fs.rename(p, t):
            raise OSError(f"could not move {p} to {table_path}")
    for p in old:
        fs.delete(p, False)
    remove(spark, staged)
