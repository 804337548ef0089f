"""Contiguous shards of near-equal byte size.

Documents are laid out in (doc_id, checksum) order over range partitions.  Every
partition adds up its own bytes, the partition totals give global prefix sums,
and the byte axis is cut at ``n`` equal targets: a document goes to the shard
in which the middle of its byte span falls.  Only the id, the size and the
checksum are moved, never the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one for the record end; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 text; that of the empty text for null."""
    return F.crc32(F.coalesce(text, F.lit("")))


def assign_shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Shards are runs of the order (doc_id, text_crc32, size), nulls first; two
    shards differ by at most about the largest document.  ``slot`` counts from
    0 in each shard without gaps.  Null and empty texts have size 1; rows that
    repeat a doc_id are kept apart; an empty table gives no rows; other columns
    are ignored, whatever their names."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_size(F.col("text")).alias("size"),
                         text_crc(F.col("text")).alias("text_crc32"))
    at = running(narrow, ["doc_id", "text_crc32", "size"], "size", name="shards")
    total = at.agg(F.sum("size")).first()[0] or 1
    # the middle of the span over the total, in whole numbers (decimals: no overflow at any size)
    mid = (F.lit(2).cast("decimal(20,0)") * F.col("_before") + F.col("size")) * F.lit(n_shards)
    at = at.withColumn("shard", F.least(F.floor(mid / F.lit(2 * total).cast("decimal(20,0)")),
                                        F.lit(n_shards - 1)).cast("int"))
    firsts = F.broadcast(at.groupBy("shard").agg(F.min("_row").alias("_first")))  # n_shards rows
    return at.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, rows_per_file: int = 100_000) -> DataFrame:
    """Write the documents under ``path/shard=<k>``, in files of
    ``rows_per_file`` consecutive slots, and return the assignment.  Needs
    unique doc_ids, since the assignment is joined back to the texts."""
    at = assign_shards(docs, n_shards)
    files = at.select("doc_id", "shard", "slot", F.expr(f"slot div {int(rows_per_file)}").alias("_file"))
    (docs.drop("shard", "slot", "_file").join(files, "doc_id").repartition("shard", "_file")
     .sortWithinPartitions("shard", "slot").drop("_file").write.partitionBy("shard").parquet(path))
    return at
