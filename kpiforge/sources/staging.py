"""Staging layer: contracted scans, lineage, idempotent loads, dedup, manifest.

O-01 read_source, O-02 read_products, O-05 with_lineage, O-06 replace_by_source,
O-07 dedup_latest, O-08 manifest, O-09/O-72 row_counts, O-10 bound filters,
O-11 save, O-16 coerce_dates.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import coerce_ts, row_md5
from .contracts import CATEGORY_TRANSLATION, NA_TOKENS, PRODUCTS, Contract
from .publish import folder_name, folders, publish, remove, stage


class ContractError(ValueError):
    pass


# ---------------------------------------------------------------------------
# O-01 contracted CSV scan
# ---------------------------------------------------------------------------
def _typed(c: str, spark_type: str) -> Column:
    raw = F.when(F.col(c).isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c))
    if spark_type == "string":
        return raw.alias(c)
    if spark_type == "timestamp_ntz":
        return coerce_ts(raw).alias(c)
    if spark_type.startswith("int") or spark_type == "bigint":
        # whole numbers only; "3.0", as float columns write it, is one, "3.7" is bad text
        number = raw.try_cast("decimal(38,6)")
        whole = F.when(number == F.floor(number), F.floor(number).try_cast(spark_type))
        return F.coalesce(raw.try_cast(spark_type), whole).alias(c)
    return raw.try_cast(spark_type).alias(c)


def read_source(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Read a CSV with header as text, keep the contract's column whitelist,
    turn NA tokens into NULL and type every column (bad values -> NULL).  Quotes
    in quoted texts are doubled; the contract says whether texts hold line breaks.
    Raises ``ContractError`` when a contracted column is missing."""
    reader = (spark.read.option("header", "true").option("inferSchema", "false")
              .option("mode", "PERMISSIVE").option("escape", '"')
              .option("multiLine", str(contract.multiline).lower()))
    raw = reader.csv(path)
    missing = [c for c in contract.names if c not in raw.columns]
    if missing:
        raise ContractError(f"{path}: missing columns {missing} for {contract.table}")
    return raw.select(*[_typed(c, t) for c, t in contract.columns])


@dataclass
class Checked:
    """A scan split by what the contract says of each record."""
    rows: DataFrame       # contract columns, _source_file, _reason (NULL: kept), _record (rejected ones' text)

    @property
    def kept(self) -> DataFrame:
        return self.rows.where(F.col("_reason").isNull()).drop("_reason", "_record")

    @property
    def rejected(self) -> DataFrame:
        """_source_file, reason, record of each rejected line."""
        return self.rows.where(F.col("_reason").isNotNull()).select(
            "_source_file", F.col("_reason").alias("reason"), F.col("_record").alias("record"))


def read_checked(spark: SparkSession, path: str, contract: Contract) -> Checked:
    """``read_source`` that drops and hides nothing: every record is either kept,
    all of it typed, or rejected with its text and the first reason:

    * ``field count``: more or fewer fields than the header names, or broken quotes;
    * ``bad <column>``: a text that isn't missing and can't be read as the column's type.

    Records of a file are its lines but for the header and blank ones; kept and
    rejected ones add up to them.  All files must have the same header."""
    options = {"header": "true", "mode": "PERMISSIVE", "escape": '"', "multiLine": str(contract.multiline).lower(),
               "columnNameOfCorruptRecord": "_corrupt", "enforceSchema": "false", "columnPruning": "false"}
    names = spark.read.option("header", "true").option("escape", '"').csv(path).columns
    if missing := [c for c in contract.names if c not in names]:
        raise ContractError(f"{path}: missing columns {missing} for {contract.table}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_corrupt"]])
    raw = spark.read.options(**options).schema(schema).csv(path)
    reason = F.lit(None).cast("string")
    for c, t in reversed(contract.columns):
        there = F.col(c).isNotNull() & ~F.col(c).isin(*NA_TOKENS)
        reason = F.when(there & _typed(c, t).isNull(), F.lit(f"bad {c}")).otherwise(reason)
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("field count")).otherwise(reason)
    record = F.coalesce("_corrupt", F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])))
    return Checked(raw.select(*[_typed(c, t) for c, t in contract.columns], F.col("_metadata.file_name").alias("_source_file"),
                              reason.alias("_reason"), F.when(reason.isNotNull(), record).alias("_record")))


def read_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """O-02: products inner-joined to the category translation.

    Blank keys are rejected so NULL never matches NULL.
    """
    tr = (translation.select(*CATEGORY_TRANSLATION.names)
          .filter(F.col("product_category_name").isNotNull()))
    return (products.select(*PRODUCTS.names)
            .join(tr, "product_category_name", "inner")
            .select("product_id", "product_category_name", "product_category_name_english"))


# ---------------------------------------------------------------------------
# O-05 lineage + O-19 fingerprint
# ---------------------------------------------------------------------------
def with_lineage(df: DataFrame, source_file: str | Column,
                 hash_fields: Iterable[tuple[str, str]],
                 ingested_at: Column | None = None) -> DataFrame:
    """Stamp ``_ingested_at`` (load time), ``_source_file`` and ``_row_md5``."""
    src = F.lit(source_file) if isinstance(source_file, str) else source_file
    ts = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({
        "_ingested_at": ts.cast("timestamp_ntz"),
        "_source_file": src,
        "_row_md5": row_md5(hash_fields),
    })


# ---------------------------------------------------------------------------
# O-16 coercing parse over a column list
# ---------------------------------------------------------------------------
def coerce_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: coerce_ts(c) for c in cols})


# ---------------------------------------------------------------------------
# O-06 idempotent per-file load
# ---------------------------------------------------------------------------
def replace_by_source(df: DataFrame, table_path: str, source_files: Iterable[str] | None = None,
                      partition_col: str = "_source_file") -> None:
    """Replace exactly the rows of the given source file(s) in a staging table.

    ``df`` is evaluated and written once, beside the table.  Rows of a file that
    isn't listed in ``source_files`` are an error, before anything changes; then the
    written partitions take the place of the old ones, and those of listed
    files without rows go."""
    spark = df.sparkSession
    staged = stage(df, table_path, [partition_col])
    drop = []
    if source_files is not None:
        wanted = [folder_name(spark, partition_col, f) for f in source_files]
        found = folders(spark, staged)
        if other := [f for f in found if f not in wanted]:
            remove(spark, staged)
            raise ValueError(f"rows of files that are not replaced: {other}")
        drop = [f for f in wanted if f not in found]
    publish(spark, staged, table_path, drop)


# ---------------------------------------------------------------------------
# O-07 keep the latest version of each key
# ---------------------------------------------------------------------------
def dedup_latest(df: DataFrame, keys: list[str], by: list[str], latest: bool = True) -> DataFrame:
    """One row per key: the greatest (``latest``) or least ``struct(by)``; the
    other columns break ties so the choice is deterministic.

    Written as a ``max``/``min`` of a struct instead of a ranking window:
    the partial aggregate collapses a hot key to one row per map task before
    the shuffle, so a key holding a third of the rows never lands whole in
    one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    # the ordering struct holds every non-key column, so it is its own payload
    order = F.struct(*[F.col(c) for c in by + rest])
    pick = F.max(order) if latest else F.min(order)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))


# ---------------------------------------------------------------------------
# O-08 load manifest
# ---------------------------------------------------------------------------
def manifest(df: DataFrame, source_col: str = "_source_file", hash_col: str = "_row_md5") -> DataFrame:
    """Rows and two order-free checksums over the first 60 bits of each row
    fingerprint per source file: their XOR, in which a pair of equal rows
    cancels out, and their sum modulo 2^60, in which it doesn't."""
    h = F.conv(F.substring(F.col(hash_col), 1, 15), 16, 10).cast("bigint")
    total = F.sum(h.cast("decimal(38,0)")) % F.lit(1 << 60).cast("decimal(38,0)")
    return (df.groupBy(F.col(source_col).alias("source_file"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("checksum"), total.cast("bigint").alias("hash_sum")))


# ---------------------------------------------------------------------------
# O-09 / O-72 post-load row counts
# ---------------------------------------------------------------------------
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of (table_name, n_rows); each count is a partial+final aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Reads Parquet by the v2 reader, which can answer counts, minima and maxima from file footers.
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
                   "spark.sql.parquet.aggregatePushdown": "true"}


def from_footers(spark: SparkSession, path: str, *aggs: Column) -> Row:
    """Whole-table COUNT(*), COUNT, MIN and MAX of a Parquet table, answered
    from its file footers: no column chunk is read."""
    with _settings(spark, FOOTER_SETTINGS):
        return spark.read.parquet(path).agg(*aggs).first()


def footer_plan(spark: SparkSession, path: str, *aggs: Column) -> str:
    """The plan of ``from_footers``, for tests and explanations."""
    with _settings(spark, FOOTER_SETTINGS):
        return spark.read.parquet(path).agg(*aggs)._jdf.queryExecution().executedPlan().toString()


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """O-09 for Parquet tables: (table_name, n_rows) from the footers; a row per table."""
    rows = [(name, from_footers(spark, path, F.count(F.lit(1)))[0]) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table_name string, n_rows bigint")


# ---------------------------------------------------------------------------
# O-11 persist
# ---------------------------------------------------------------------------
def save(df: DataFrame, base_path: str, layer: str, name: str, version: int,
         partition_by: list[str] | None = None, view: bool = True) -> str:
    """Write ``<base>/<layer>/<name>/v=<version>`` (never over the path being
    read) and register a temp view ``<layer>_<name>`` on the new version."""
    path = f"{base_path.rstrip('/')}/{layer}/{name}/v={version}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if view:
        df.sparkSession.read.parquet(path).createOrReplaceTempView(f"{layer}_{name}")
    return path
