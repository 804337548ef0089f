"""O-35 in place: the fact as a bucketed table of Spark's catalog, merged bucket by bucket.

The table is bucketed on the merge keys and has each bucket in a partition
folder of its own, ``_bucket=<k>``.  A load is shuffled to the buckets, the table
is not: both joins of a merge read it by its buckets.  Only buckets that hold a
key of the load are read and written; their folders take the place of the
old ones, all others are untouched.

A merge that stops half-way leaves buckets of both versions.  Run again with the same load
it finds the rows it had merged unchanged and merges the rest (inserts that were not
published yet get ids after the published ones).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CODEC, scratch_path, stored
from ..sources.publish import publish, remove
from .fact import FACT_CHANGE_COLS, FACT_KEYS, LOOKUP_COLS, assert_unique, merge_action, merged_values
from .keys import running_total


@dataclass
class BucketedFact:
    """A fact table ``name`` of the session's catalog with its files at ``path``."""
    spark: SparkSession
    name: str
    path: str
    buckets: int
    keys: Sequence[str] = tuple(FACT_KEYS)
    id_col: str = "event_id"
    #: buckets that the last merge read and wrote
    touched: tuple[int, ...] = ()

    # -- storage
    def _bucket(self):
        # the bucket number that Spark's own bucketing gives a row
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str, path: str, dealt: bool = False) -> None:
        rows = rows.withColumn("_bucket", self._bucket())
        if not dealt:
            rows = rows.repartition(self.buckets, *self.keys)
        (rows.write.option("compression", CODEC).partitionBy("_bucket").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", path).saveAsTable(name))

    def create(self, rows: DataFrame) -> BucketedFact:
        """A first version: rows with ids, e.g. of ``upsert(None, ...)``."""
        self._write(rows, self.name, self.path)
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop("_bucket")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    # -- merge
    def against(self, src: DataFrame, columns: Sequence[str], how: str, buckets: Sequence[int]) -> DataFrame:
        """``src`` joined to the table's rows in ``buckets``, whose ``columns`` come as _t_*."""
        t = self.spark.table(self.name).where(F.col("_bucket").isin(*buckets))
        t = t.select(*self.keys, *[F.col(c).alias(f"_t_{c}") for c in columns], F.lit(True).alias("_in_target"))
        return src.join(t, list(self.keys), how)

    def merge(self, src: DataFrame, change_cols: Sequence[str] = FACT_CHANGE_COLS,
              update_cols: Sequence[str] | None = None) -> DataFrame:
        """Insert, update or leave each row of ``src`` as ``upsert`` does, in
        place.  Returns the changes, a written row per source row: the keys,
        ``action``, and structs ``old`` and ``new`` of the value columns (old is
        NULL for an insert, new what the table holds now)."""
        keys, spark = list(self.keys), self.spark
        values = [c for c in src.columns if c not in keys]
        update_cols = [c for c in values if c not in LOOKUP_COLS] if update_cols is None else update_cols
        src = stored(src, "merge-batch")
        assert_unique(src, keys)
        buckets = sorted(r[0] for r in src.select(self._bucket()).distinct().collect())  # `buckets` at most
        self.touched = tuple(buckets)

        # what becomes of each source row, and the ids of inserts
        j = self.against(src, [self.id_col, *values], "left", buckets).withColumn("action", merge_action(change_cols))
        struct = lambda prefix: F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in values])
        path = scratch_path(spark, "merge-changes")
        (j.select(*keys, "action", F.col(f"_t_{self.id_col}").alias(self.id_col), F.when(F.col("_in_target"), struct("_t_")).alias("old"),
                  *merged_values(values, update_cols))
         .select(*keys, "action", self.id_col, "old", F.struct(*values).alias("new")).write.option("compression", CODEC).parquet(path))
        changes = spark.read.parquet(path)
        start = self.read().agg(F.max(self.id_col)).first()[0] or 0
        inserts = running_total(changes.where("action = 'insert'").select(*keys), order_by=keys, out="_rank")
        inserts = inserts.select(*keys, (F.col("_rank") + start).cast("bigint").alias("_new_id"))

        # the touched buckets, with the changed rows in place of the old ones
        new = (changes.join(inserts, keys, "left")
               .select(*keys, F.coalesce(self.id_col, "_new_id").alias("_id"), "new"))
        rows = self.against(new, [self.id_col, *values], "full", buckets).select(
            F.coalesce(f"_t_{self.id_col}", "_id").alias(self.id_col), *keys,
            *[F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in values])
        staged, name = f"{self.path.rstrip('/')}/_staged", f"{self.name}_staged"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, staged)  # of a merge that stopped
        # joined by buckets, the rows lie as the table does; with another number of partitions they are dealt again
        dealt = spark.conf.get("spark.sql.shuffle.partitions") == str(self.buckets)
        self._write(rows.select(*self.read().columns), name, staged, dealt)
        spark.sql(f"DROP TABLE {name}")
        publish(spark, staged, self.path)
        spark.catalog.recoverPartitions(self.name)
        spark.catalog.refreshTable(self.name)
        return changes
