"""Token counts kept as rollups by signed deltas.

A store holds, under one folder, for each committed batch of changes

* ``ledger/batch=<id>``: the state that the batch left of the documents it touched,
* ``deltas/batch=<id>``: what it added to the totals by source, language and
  tokenizer version, signed,
* ``commits/batch=<id>``: one row, written last.

Totals are the sum of the committed deltas, so a batch costs what it changes.  A
batch that was written in part has no commit row, isn't read, and is overwritten
when it is tried again; a batch that is already committed changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import per_text, text_bytes

DIMENSIONS = ("source", "lang", "tokenizer")
CHANGES = "seq long, op string, doc_id long, tokenizer string, source string, lang string, n_tokens long"


# -- counting

def ranks_of(path: str) -> bytes:
    """The content of a rank file (base64 token, rank) that the driver can open."""
    with open(path, "rb") as f:
        return f.read()


@cache
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    import base64
    table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


class Counter:
    """Token counts of texts under one byte-level tokenizer, whose rank file is
    broadcast (its size is that of the vocabulary)."""

    def __init__(self, spark: SparkSession, ranks: bytes, pattern: str):
        self._sent = spark.sparkContext.broadcast((ranks, pattern))

    def __call__(self, text: Column) -> Column:
        """Tokens of a text, special tokens read as text; 0 for null and empty texts."""
        sent = self._sent

        def setup():
            enc = _encoding(*sent.value)
            return lambda ts: pa.array([len(x) for x in enc.encode_ordinary_batch(
                [t.decode("utf-8", "replace") for t in ts], num_threads=1)], pa.int64())

        return per_text(setup, "long")(text_bytes(text))


# -- the store

class Rollup:
    """Totals of a folder that Spark can write.  Batches are committed one after
    the other, with growing ids; there is one writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def create(self) -> Rollup:
        """Start an empty store; leaves one that exists as it is."""
        spark = self.spark
        none = spark.createDataFrame([], CHANGES).selectExpr("doc_id", "tokenizer", "source", "lang", "n_tokens", "true as alive")
        none.write.mode("ignore").parquet(f"{self.path}/ledger/batch=0")
        none.selectExpr("source", "lang", "tokenizer", "n_tokens as n_docs", "n_tokens").write.mode("ignore").parquet(
            f"{self.path}/deltas/batch=0")
        spark.range(1).select(F.lit(0).cast("long").alias("n_changes")).write.mode("ignore").parquet(f"{self.path}/commits/batch=0")
        return self

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")

    def committed(self) -> list[int]:
        """The ids of the committed batches: one row for each."""
        return sorted(r[0] for r in self._read("commits").select(F.col("batch").cast("long")).distinct().collect())

    def _parts(self, name: str, batches: Sequence[int]) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/{name}").parquet(
            *(f"{self.path}/{name}/batch={b}" for b in batches))

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply a batch of ``CHANGES`` once; False if it was committed before.

        ``op`` is insert, delete or revise.  The last change by ``seq`` of a
        document under a tokenizer version decides (of equal ones the one whose
        columns sort last): insert and revise leave it with the given source,
        language and count, whether or not it was there; delete leaves it out.  A
        null count is 0; null sources, languages and versions are values like
        others; rows with another op or without doc_id change nothing."""
        done = self.committed()
        if batch in done:
            return False
        if batch <= max(done):
            raise ValueError(f"batch {batch} comes before committed batch {max(done)}")
        new = (changes.where(F.col("op").isin("insert", "delete", "revise") & F.col("doc_id").isNotNull())
               .select("doc_id", "tokenizer", F.struct(
                   F.lit(batch).cast("long").alias("batch"), F.col("seq").cast("long").alias("seq"),
                   (F.col("op") != "delete").alias("alive"), "source", "lang",
                   F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens")).alias("new"),
                   F.lit(None).alias("old")))
        kept = self._parts("ledger", done).select("doc_id", "tokenizer", F.lit(None).alias("new"), F.struct(
            F.col("batch").cast("long").alias("batch"), F.lit(0).cast("long").alias("seq"), "alive", "source", "lang",
            "n_tokens").alias("old"))
        state = new.unionByName(kept).groupBy("doc_id", "tokenizer").agg(F.max("new").alias("new"), F.max("old").alias("old"))
        touched = state.where("new is not null")
        ledger = f"{self.path}/ledger/batch={batch}"
        (touched.select("doc_id", "tokenizer", "new.source", "new.lang", "new.n_tokens", "new.alive", "old")
         .write.mode("overwrite").parquet(ledger))
        rows = self._parts("ledger", [batch])
        signed = (rows.where("alive").select(*DIMENSIONS, F.lit(1).alias("n_docs"), "n_tokens")
                  .unionAll(rows.where("old.alive").select("old.source", "old.lang", "tokenizer", F.lit(-1).alias("n_docs"),
                                                           (-F.col("old.n_tokens")).alias("n_tokens"))))
        (signed.groupBy(*DIMENSIONS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}"))
        (rows.agg(F.count(F.lit(1)).alias("n_changes")).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}"))
        return True

    def totals(self) -> DataFrame:
        """n_docs and n_tokens by source, language and tokenizer version, of the
        committed batches; groups without documents are left out."""
        return (self._parts("deltas", self.committed()).groupBy(*DIMENSIONS)
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0"))
