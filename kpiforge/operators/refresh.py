"""O-11 / O-46: quarterly KPI tables that follow the fact's changes.

Three tables, partitioned by (year, quarter), are kept under one folder:

* ``sums``: the additive state of a quarter (revenue, on-time items, items with a flag, items);
* ``leads``: how many of its items have each lead time, from which exact percentiles come;
* ``kpis``: revenue, lead-time percentile, on-time rate.

A load's changes (``BucketedFact.merge``) are signed rows: an insert adds its
new row, an update takes its old row away and adds the new one.  Summed by quarter
they update the state; only the folders of the quarters they fall into are read
and written.  The fact is not read at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from ..sources.publish import folders, publish, stage
from .kpis import YQ, on_time_value, scoped_fact
from .percentiles import null_safe_join, percentiles_of_counts

SUMS = ["revenue", "on_time", "n_flag", "n_rows"]
_NEEDED = ["calendar_sk", "customer_sk", "price", "lead_time_days", "on_time_flag"]


class StateError(ValueError):
    """Changes that don't fit the state: they take away rows that it never had."""


def signed_rows(changes: DataFrame, columns: Sequence[str] = _NEEDED) -> DataFrame:
    """The rows that a merge's ``changes`` (action, old, new) add (``_sign`` 1)
    and take away (-1); unchanged ones do neither."""
    def part(sign: int, row: str, actions: Sequence[str]) -> DataFrame:
        return changes.where(F.col("action").isin(*actions)).select(F.lit(sign).alias("_sign"), *[F.col(f"{row}.{c}").alias(c) for c in columns])

    return part(1, "new", ["insert", "update"]).unionAll(part(-1, "old", ["update"]))


@dataclass
class KpiTables:
    spark: SparkSession
    path: str
    cal: DataFrame
    cust: DataFrame
    city: str
    p: float = 0.9
    #: quarters that the last refresh read and wrote
    touched: tuple[tuple[int, int], ...] = ()

    def _table(self, name: str, quarters: Sequence[tuple[int, int]] | None = None) -> DataFrame:
        """A state table, or its rows of the given quarters that it has folders for."""
        t = self.spark.read.schema(self._schemas[name]).parquet(f"{self.path}/{name}")
        if quarters is None:
            return t
        mine = F.lit(False)
        for y, q in quarters:
            mine = mine | ((F.col("year") == y) & (F.col("quarter") == q))
        return t.where(mine)

    @property
    def _schemas(self) -> dict[str, str]:
        by = "year int, quarter int"
        return {"sums": f"revenue decimal(38,2), on_time bigint, n_flag bigint, n_rows bigint, {by}",
                "leads": f"lead_time_days double, n bigint, {by}",
                "kpis": f"revenue_sp decimal(38,2), lead_time_p double, on_time_rate double, {by}"}

    # -- deltas
    def _deltas(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The sums and lead-time counts of signed fact rows in scope, both from
        one pass: the rows are summed by lead time, these sums by quarter."""
        rows = scoped_fact(rows, self.cal, self.cust, self.city)
        sign, on_time = F.col("_sign"), on_time_value()
        by_lead = self._store("by-lead", rows.groupBy(*YQ, "lead_time_days").agg(
            F.sum(F.col("price").cast("decimal(28,2)") * sign).cast("decimal(38,2)").alias("revenue"),
            F.sum(on_time.cast("bigint") * sign).alias("on_time"),
            F.sum(F.when(on_time.isNotNull(), sign).otherwise(0)).cast("bigint").alias("n_flag"), F.sum(sign).cast("bigint").alias("n_rows")))
        sums = by_lead.groupBy(*YQ).agg(*[F.sum(c).cast("decimal(38,2)" if c == "revenue" else "bigint").alias(c) for c in SUMS])
        leads = by_lead.where("lead_time_days is not null and n_rows != 0").select(*YQ, "lead_time_days", F.col("n_rows").alias("n"))
        return sums.fillna(0, ["on_time"]), leads

    def _save(self, tables: dict[str, DataFrame], quarters: Sequence[tuple[int, int]] | None) -> None:
        for name, df in tables.items():
            path = f"{self.path}/{name}"
            # a quarter's rows lie together; one with many lead times is dealt to several tasks
            staged = stage(df.repartitionByRange(*YQ, *(["lead_time_days"] if name == "leads" else [])), path, YQ)
            there = {f"{y}/{q}" for y in folders(self.spark, staged) for q in folders(self.spark, f"{staged}/{y}")}
            gone = [f"year={y}/quarter={q}" for y, q in quarters or [] if f"year={y}/quarter={q}" not in there]
            publish(self.spark, staged, path, gone, depth=2)

    def _kpis(self, sums: DataFrame, leads: DataFrame) -> DataFrame:
        pct = percentiles_of_counts(leads, YQ, "lead_time_days", "n", {"lead_time_p": self.p})
        rate = F.col("on_time").cast("double") / F.nullif(F.col("n_flag").cast("double"), F.lit(0.0))
        g = sums.select(*YQ, F.col("revenue").alias("revenue_sp"), rate.alias("on_time_rate"))
        return null_safe_join(g, pct, YQ, "left").select("revenue_sp", "lead_time_p", "on_time_rate", *YQ)

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        return stored(df, f"refresh-{name}")

    # -- use
    def build(self, fact: DataFrame) -> KpiTables:
        """The tables from all of the fact."""
        sums, leads = self._deltas(fact.select(F.lit(1).alias("_sign"), *_NEEDED))
        self._save({"sums": sums, "leads": leads}, None)
        self._save({"kpis": self._kpis(self._table("sums"), self._table("leads"))}, None)
        return self

    def refresh(self, changes: DataFrame) -> KpiTables:
        """The tables after a merge's changes.  The new state is written aside and
        checked before the first folder is replaced."""
        sums, leads = (self._store(n, d) for n, d in zip(("sums", "leads"), self._deltas(signed_rows(changes))))
        quarters = [tuple(r) for r in sums.select(*YQ).distinct().collect()]  # a row per quarter
        self.touched = tuple(sorted(quarters))
        if not quarters:
            return self
        sums = self._store("sums", self._table("sums", quarters).unionByName(sums).groupBy(*YQ).agg(
            *[F.sum(c).cast("decimal(38,2)" if c == "revenue" else "bigint").alias(c) for c in SUMS]).where("n_rows != 0"))
        leads = self._store("leads", self._table("leads", quarters).unionByName(leads).groupBy(*YQ, "lead_time_days")
                            .agg(F.sum("n").cast("bigint").alias("n")).where("n != 0"))
        if not sums.where("n_rows < 0").isEmpty() or not leads.where("n < 0").isEmpty():
            raise StateError("the changes take away rows that the state doesn't hold")
        self._save({"sums": sums, "leads": leads, "kpis": self._kpis(sums, leads)}, quarters)
        return self

    def kpis(self) -> DataFrame:
        """year, quarter, revenue_sp, lead_time_p90 (or the percentile asked for), on_time_rate."""
        return self._table("kpis").select(*YQ, "revenue_sp", F.col("lead_time_p").alias(f"lead_time_p{self.p * 100:g}"), "on_time_rate")
