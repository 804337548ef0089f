"""A/B experiment read-out, all quarters in one job.

O-25 ab_group (functions.columns), O-73 ab_orders, O-74 ab_summary,
O-75 ab_welch, O-76 ab_effect_grid, O-77 ab_winsor.

The reference pulls one quarter's order revenues into numpy; here every
statistic is an aggregate of conditional sums per (year, quarter), so the
work is partial-aggregated on the executors and only one row per quarter
reaches the arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ab_group
from .kpis import scoped_fact
from .percentiles import null_safe_join, percentiles

YQ = ["year", "quarter"]

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
MDE_GRID = (0.02, 0.03, 0.05, 0.08, 0.10)   # minimum detectable effects (relative)
WINSOR_P = 0.999                           # cap at each group's own 99.9th percentile


def ab_orders(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str) -> DataFrame:
    """One row per order of the city: revenue (sum of item prices), MIN(year),
    MIN(quarter), MIN(customer_id) as coded, and the hash group."""
    rows = scoped_fact(fact, cal, cust, city, carry=["customer_id"])
    o = rows.groupBy("order_id").agg(F.sum("price").alias("order_revenue"),
                                     F.min("year").alias("year"),
                                     F.min("quarter").alias("quarter"),
                                     F.min("customer_id").alias("customer_id"))
    return o.withColumn("group_id", ab_group("customer_id"))


def ab_summary(ab: DataFrame, value: str = "order_revenue") -> DataFrame:
    """count, mean, std (n-1), exact median, min, max per quarter and group."""
    by = [*YQ, "group_id"]
    ab = ab.select(*by, F.col(value).cast("double").alias("_x")).checkpoint(eager=True)
    return percentiles(ab, by, "_x", {"median": 0.5}, also={
        "n": F.count("_x"), "mean": F.avg("_x"), "std": F.stddev_samp("_x"), "min": F.min("_x"),
        "max": F.max("_x")}).select(*by, "n", "mean", "std", "median", "min", "max")


def _moments(ab: DataFrame, x: Column) -> DataFrame:
    def g(i: int, agg):
        return agg(F.when(F.col("group_id") == i, x))
    return ab.groupBy(*YQ).agg(
        g(0, F.count).alias("n0"), g(1, F.count).alias("n1"),
        g(0, F.avg).alias("mean0"), g(1, F.avg).alias("mean1"),
        g(0, F.var_samp).alias("var0"), g(1, F.var_samp).alias("var1"))


def _welch_from_moments(m: DataFrame) -> DataFrame:
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    v0, v1 = F.col("var0"), F.col("var1")
    pooled_var = ((n0 - 1) * v0 + (n1 - 1) * v1) / F.nullif(n0 + n1 - 2, F.lit(0.0))
    sd_pool = F.when(F.col("n0") > 1, F.sqrt(pooled_var)).otherwise(F.sqrt(v0))
    se = F.sqrt(v0 / n0 + v1 / n1)
    uplift = F.col("mean1") - F.col("mean0")
    dof = F.pow(v0 / n0 + v1 / n1, 2) / (
        F.pow(v0, 2) / (F.pow(n0, 2) * (n0 - 1)) + F.pow(v1, 2) / (F.pow(n1, 2) * (n1 - 1)))
    return m.select(
        *YQ, "n0", "n1", F.col("mean0").alias("baseline_mean"), "mean1",
        F.sqrt(v0).alias("baseline_sd"), sd_pool.alias("sd_pool"),
        uplift.alias("uplift_abs"),
        (uplift / F.nullif(F.col("mean0"), F.lit(0.0))).alias("uplift_rel"),
        se.alias("se"), (uplift / F.nullif(se, F.lit(0.0))).alias("t_stat"),
        dof.alias("welch_df"))


def ab_welch(ab: DataFrame, value: str = "order_revenue") -> DataFrame:
    """Per quarter: baseline (control) mean and SD, pooled SD, observed
    uplift (abs, rel), standard error, Welch t and Welch-Satterthwaite df."""
    return _welch_from_moments(_moments(ab, F.col(value).cast("double")))


def ab_effect_grid(welch: DataFrame, mdes: Sequence[float] = MDE_GRID) -> DataFrame:
    """Cohen's d of each relative MDE per quarter with the smaller group's N.
    The grid is an ``explode`` of a literal array, not a join."""
    grid = F.explode(F.array(*[F.lit(float(m)) for m in mdes])).alias("mde_rel")
    w = welch.select(*YQ, "baseline_mean", "sd_pool", "n0", "n1", grid)
    effect_abs = F.col("baseline_mean") * F.col("mde_rel")
    sd = F.when(F.col("sd_pool") > 0, F.col("sd_pool")).otherwise(F.lit(1.0))
    return w.select(*YQ, "mde_rel", effect_abs.alias("effect_abs"),
                    (effect_abs / sd).alias("cohens_d"),
                    F.least("n0", "n1").alias("n_per_group"))


def ab_winsor(ab: DataFrame, p: float = WINSOR_P, value: str = "order_revenue") -> DataFrame:
    """Cap each (quarter, group) at its own exact p-quantile, then redo the
    Welch moments.  The caps are one row per (quarter, group)."""
    by = [*YQ, "group_id"]
    ab = ab.select(*by, F.col(value).cast("double").alias("_x")).checkpoint(eager=True)
    caps = percentiles(ab, by, "_x", {"_cap": p})
    capped = null_safe_join(ab, caps, by, "left").withColumn("_w", F.least("_x", "_cap"))
    return _welch_from_moments(_moments(capped, F.col("_w")))
