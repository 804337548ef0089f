"""Quarterly KPI aggregates (by delivery quarter, one city in scope).

O-38 revenue_by_quarter, O-39 revenue_by_quarter_scoped, O-40 orders_by_quarter_rows,
O-41 review_share, O-42 on_time_rate, O-43 lead_time_pctl, O-44 late_by_category,
O-45 category_share (with O-53 group total), O-46 kpi_quarter, O-47 guardrail,
O-48 delivered_share, O-49 orders_per_quarter, O-50 avg_lateness,
O-51 shipping_profile, O-52 kpi_by_category.

Every aggregate groups the fact after the city filter has been pushed into
the customer dimension; partial aggregation runs map-side, so a quarter or a
city holding a third of the rows is reduced before the shuffle.  Rates are
doubles (``F.lit(1.0)``), never decimal literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import share
from .fact import delivered, scope
from .percentiles import percentiles, percentiles_approx

YQ = ["year", "quarter"]


# ---------------------------------------------------------------------------
# building blocks
# ---------------------------------------------------------------------------
def with_quarter(fact: DataFrame, cal: DataFrame) -> DataFrame:
    return fact.join(cal.select("calendar_sk", "year", "quarter"), "calendar_sk", "inner")


def scoped_fact(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str,
                prod: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Fact rows of customers in ``city`` with (year, quarter) [and category,
    and the ``carry`` columns of the customer]."""
    c = scope(cust, city).select("customer_sk", *carry)
    out = with_quarter(fact.join(c, "customer_sk", "inner"), cal)
    if prod is not None:
        out = out.join(prod.select("product_sk", F.col("product_category_name").alias("category")),
                       "product_sk", "inner")
    return out


def on_time_value() -> Column:
    """1.0 / 0.0 / NULL: NULL flags are left out of the rate."""
    f = F.col("on_time_flag")
    return F.when(f == 1, F.lit(1.0)).when(f == 0, F.lit(0.0))


def late_value() -> Column:
    """0.0 if on time, 1.0 otherwise -- a NULL flag counts as late here."""
    return F.when(F.col("on_time_flag") == 1, F.lit(0.0)).otherwise(F.lit(1.0))


# ---------------------------------------------------------------------------
# O-38 / O-39 revenue
# ---------------------------------------------------------------------------
def revenue_by_quarter(fact: DataFrame, cal: DataFrame) -> DataFrame:
    return with_quarter(fact, cal).groupBy(*YQ).agg(F.sum("price").alias("revenue"))


def revenue_by_quarter_scoped(fact: DataFrame, cal: DataFrame, cust: DataFrame,
                              city: str) -> DataFrame:
    return (scoped_fact(fact, cal, cust, city).groupBy(*YQ)
            .agg(F.sum("price").alias("revenue_sp")))


# ---------------------------------------------------------------------------
# O-40 delivered orders with quarter (from staging, not the fact)
# ---------------------------------------------------------------------------
def orders_by_quarter_rows(orders: DataFrame, cust: DataFrame, cal: DataFrame,
                           city: str) -> DataFrame:
    o = delivered(orders).select("order_id", "customer_id",
                                 F.to_date("order_delivered_customer_date").alias("delivered_date"))
    c = scope(cust, city).select("customer_id", "customer_city")
    d = cal.select(F.col("date").alias("delivered_date"), "calendar_sk", "year", "quarter")
    return (o.join(c, "customer_id", "inner").join(d, "delivered_date", "inner")
            .select("order_id", "customer_id", "delivered_date", "calendar_sk", "year",
                    "quarter", "customer_city"))


# ---------------------------------------------------------------------------
# O-41 review share
# ---------------------------------------------------------------------------
def review_share(orders_q: DataFrame, reviews: DataFrame, min_score: int = 4) -> DataFrame:
    """Share of reviews with score >= min_score over the reviews of the
    quarter's delivered orders; a NULL score counts as below.  An order with
    several reviews counts several times."""
    r = reviews.select("order_id", "review_score")
    good = F.when(F.col("review_score") >= min_score, F.lit(1.0)).otherwise(F.lit(0.0))
    return (orders_q.select("order_id", "year", "quarter").join(r, "order_id", "inner")
            .groupBy(*YQ).agg(F.avg(good).alias("share_ge4")))


# ---------------------------------------------------------------------------
# O-42 / O-43 on-time rate, lead-time percentile
# ---------------------------------------------------------------------------
def on_time_rate(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str) -> DataFrame:
    return (scoped_fact(fact, cal, cust, city).groupBy(*YQ)
            .agg(F.avg(on_time_value()).alias("on_time_rate")))


def lead_time_pctl(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str,
                   p: float = 0.9, out: str = "lead_time_p90", approx: bool = False) -> DataFrame:
    """P90 per quarter: exact, or with ``approx`` by a mergeable sketch, which
    reads the fact once and adds the number of lead times, ``n_rows``."""
    rows = scoped_fact(fact, cal, cust, city)
    return (percentiles_approx if approx else percentiles)(rows, YQ, "lead_time_days", {out: p})


# ---------------------------------------------------------------------------
# O-44 late items by category
# ---------------------------------------------------------------------------
def late_by_category(fact: DataFrame, cal: DataFrame, cust: DataFrame, prod: DataFrame,
                     city: str, distinct_orders: bool = False) -> DataFrame:
    """``n_orders`` counts item rows (as the reference does); ``late_rate``
    counts a NULL flag as late.  ``distinct_orders`` adds the order count."""
    aggs = [F.count(F.lit(1)).alias("n_orders"), F.avg(late_value()).alias("late_rate")]
    if distinct_orders:
        aggs.append(F.countDistinct("order_id").alias("n_distinct_orders"))
    g = scoped_fact(fact, cal, cust, city, prod).groupBy(*YQ, "category").agg(*aggs)
    return g.withColumn("late_orders", F.col("n_orders") * F.col("late_rate")).select(
        *YQ, "category", "n_orders", "late_rate", "late_orders",
        *(["n_distinct_orders"] if distinct_orders else []))


# ---------------------------------------------------------------------------
# O-45 / O-53 category share
# ---------------------------------------------------------------------------
def with_group_total(df: DataFrame, value: str, part: Sequence[str], out: str) -> DataFrame:
    """O-53: SUM(SUM(x)) OVER (PARTITION BY part) on already grouped rows."""
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*part)))


def category_share(fact: DataFrame, cal: DataFrame, cust: DataFrame, prod: DataFrame,
                   city: str) -> DataFrame:
    g = (scoped_fact(fact, cal, cust, city, prod).groupBy(*YQ, "category")
         .agg(F.sum("price").alias("revenue_cat")))
    g = with_group_total(g, "revenue_cat", YQ, "revenue_total")
    return g.withColumn("share_cat", share("revenue_cat", "revenue_total"))


# ---------------------------------------------------------------------------
# O-46 consolidated KPI table
# ---------------------------------------------------------------------------
def fact_kpis(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str,
              p: float = 0.9) -> DataFrame:
    """Revenue, P90 and on-time rate of the scoped fact; the sums and the
    percentile's sketch come from one scan."""
    return percentiles(scoped_fact(fact, cal, cust, city), YQ, "lead_time_days", {"lead_time_p90": p},
                       also={"revenue_sp": F.sum("price"), "on_time_rate": F.avg(on_time_value())})


def kpi_quarter(fact: DataFrame, cal: DataFrame, cust: DataFrame, orders: DataFrame,
                reviews: DataFrame, city: str) -> DataFrame:
    """Four KPIs per quarter; a quarter present in any input is kept (full
    outer join on year, quarter), ordered by year, quarter."""
    f = fact_kpis(fact, cal, cust, city)
    r = review_share(orders_by_quarter_rows(orders, cust, cal, city), reviews).withColumnRenamed(
        "share_ge4", "reviews_ge4_share")
    return (f.join(r, YQ, "full")
            .select(*YQ, "revenue_sp", "reviews_ge4_share", "lead_time_p90", "on_time_rate")
            .orderBy(F.col("year").asc_nulls_last(), F.col("quarter").asc_nulls_last()))


# ---------------------------------------------------------------------------
# O-47 guardrail for one bound quarter
# ---------------------------------------------------------------------------
def guardrail(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str,
              year: int, quarter: int) -> DataFrame:
    """On-time rate of one quarter; the bound literals are pushed into the
    calendar before the join."""
    c = cal.filter((F.col("year") == F.lit(int(year))) & (F.col("quarter") == F.lit(int(quarter))))
    return on_time_rate(fact, c, cust, city)


# ---------------------------------------------------------------------------
# O-48 / O-49 order counts
# ---------------------------------------------------------------------------
def delivered_share(orders: DataFrame, cust: DataFrame, city: str) -> DataFrame:
    """Delivered / created orders per quarter of the *estimated* date (an
    undelivered order has no delivery date); orders without estimate dropped."""
    c = scope(cust, city).select("customer_id")
    d = F.col("order_estimated_delivery_date")
    is_del = F.when(F.col("order_status") == "delivered", F.lit(1.0)).otherwise(F.lit(0.0))
    return (orders.filter(d.isNotNull()).join(c, "customer_id", "inner")
            .groupBy(F.year(d).cast("int").alias("year"), F.quarter(d).cast("int").alias("quarter"))
            .agg(F.count(F.lit(1)).alias("orders_created"), F.avg(is_del).alias("delivered_rate")))


def orders_per_quarter(orders_q: DataFrame) -> DataFrame:
    return orders_q.groupBy(*YQ).agg(F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------------------
# O-50 / O-51 lateness and shipping profile
# ---------------------------------------------------------------------------
def avg_lateness(fact_dates: DataFrame) -> DataFrame:
    """Mean days late of late rows (flag = 0) per quarter."""
    late_days = (F.timestamp_diff("MICROSECOND", F.col("estimated_at"), F.col("delivered_at"))
                 .cast("double") / F.lit(86400e6))
    return (fact_dates.filter(F.col("on_time_flag") == 0).groupBy(*YQ)
            .agg(F.avg(late_days).alias("avg_late_days"), F.count(F.lit(1)).alias("n_late")))


def shipping_profile(fact: DataFrame, cal: DataFrame, cust: DataFrame, city: str) -> DataFrame:
    """P50 / P90 / P99 lead time and coverage (rows with a flag, i.e. with
    both delivery and estimate) per quarter."""
    ps = {"lead_time_p50": 0.5, "lead_time_p90": 0.9, "lead_time_p99": 0.99}
    g = percentiles(scoped_fact(fact, cal, cust, city), YQ, "lead_time_days", ps,
                    also={"n_rows": F.count(F.lit(1)), "n_with_estimate": F.count("on_time_flag")})
    return g.select(*YQ, *ps, "n_rows", "n_with_estimate", share("n_with_estimate", "n_rows").alias("coverage"))


# ---------------------------------------------------------------------------
# O-52 KPIs by quarter x category
# ---------------------------------------------------------------------------
MEASURES = ["revenue", "on_time_rate", "n_on_time_base", "lead_time_p50", "lead_time_p90"]


def kpi_by_category(fact: DataFrame, cal: DataFrame, cust: DataFrame, prod: DataFrame,
                    city: str, by: Sequence[str] = (*YQ, "category")) -> DataFrame:
    """Revenue, on-time rate, P50/P90 lead time per group of ``by``: any of
    year, quarter, category, and day (the delivery day's key)."""
    rows = scoped_fact(fact, cal, cust, city, prod).withColumnRenamed("calendar_sk", "day")
    return percentiles(rows, by, "lead_time_days", {"lead_time_p50": 0.5, "lead_time_p90": 0.9},
                       also={"revenue": F.sum("price"), "on_time_rate": F.avg(on_time_value()),
                             "n_on_time_base": F.count("on_time_flag")}).select(*by, *MEASURES)


def slug(name: str) -> str:
    """A column name from a group value: its words joined by underscores."""
    return "_".join(name.lower().split())


def pivoted(long: DataFrame, index: Sequence[str], on: str, values: Sequence[str],
            measures: Sequence[str]) -> DataFrame:
    """One row per ``index`` with a column ``<value>_<measure>`` for each of the
    fixed ``values`` of ``on``: no pass to find the values, the columns are known
    up front.  ``long`` has one row per (index, on); a missing one leaves NULLs;
    other values of ``on`` are left out."""
    got = long.groupBy(*index).pivot(on, list(values)).agg(*[F.first(m).alias(m) for m in measures])
    return got.select(*index, *[F.col(f"`{v}_{m}`").alias(f"{slug(v)}_{m}") for v in values for m in measures])


def unpivoted(wide: DataFrame, index: Sequence[str], on: str, values: Sequence[str],
              measures: Sequence[str]) -> DataFrame:
    """The rows that ``pivoted`` was made of; those with NULL measures only are
    no rows."""
    entries = F.array(*[F.struct(F.lit(v).alias(on), *[F.col(f"{slug(v)}_{m}").alias(m) for m in measures]) for v in values])
    rows = wide.select(*index, F.inline(entries))
    return rows.where(F.coalesce(*[F.col(m).cast("string") for m in measures]).isNotNull())
