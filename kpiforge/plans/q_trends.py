"""Registered queries: period over period, targets, concentration (O-54..O-62)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import kpis, trends
from . import oracle as O
from .catalog import CITY, present, register
from .star import Star


def _late(s: Star) -> DataFrame:
    return kpis.late_by_category(s.fact, s.cal, s.customer, s.product, CITY)


def _cat_share(s: Star) -> DataFrame:
    return kpis.category_share(s.fact, s.cal, s.customer, s.product, CITY)


def _qi(a: str) -> str:
    return f"({a}.year * 4 + {a}.quarter - 1)"


@register("late_delta_sp", O.q(f"""
SELECT {O.yq()}, category, CAST(n_orders AS BIGINT) AS n_orders,
       CAST(lag(n_orders) OVER w AS DOUBLE) AS n_orders_prev,
       {O.r6('late_rate', 'late_rate')}, {O.r6('lag(late_rate) OVER w', 'late_rate_prev')},
       {O.r6('late_orders', 'late_orders')}, {O.r6('lag(late_orders) OVER w', 'late_orders_prev')},
       {O.r6('late_orders - coalesce(lag(late_orders) OVER w, 0)', 'delta_late_orders')}
FROM category_late WINDOW w AS (PARTITION BY category ORDER BY year, quarter)
"""))
def late_delta_sp(s: Star) -> DataFrame:
    """O-54: late items by category vs the previous existing quarter (LAG)."""
    d = trends.delta_prev(_late(s), ["n_orders", "late_rate", "late_orders"], ["category"],
                          delta_of=["late_orders"])
    return present(d, ints=["year", "quarter"], longs=["n_orders"],
                   nullable_ints=["n_orders_prev"],
                   rates=["late_rate", "late_rate_prev", "late_orders", "late_orders_prev",
                          "delta_late_orders"])


_YOY_REVENUE = f"""
SELECT {O.yq('t.')}, {O.money('t.revenue_sp', 'revenue_present')},
       {O.money('b.revenue_sp', 'revenue_base')},
       {O.r6('100.0 * (CAST(t.revenue_sp AS DOUBLE) - CAST(b.revenue_sp AS DOUBLE)) / NULLIF(CAST(b.revenue_sp AS DOUBLE), 0)', 'yoy_pct')}
FROM quarter_sales t LEFT JOIN quarter_sales b ON {_qi('b')} + 4 = {_qi('t')}
"""


@register("revenue_yoy", O.q(_YOY_REVENUE))
def revenue_yoy(s: Star) -> DataFrame:
    """O-55: revenue of quarter t vs t-4, relative change in %."""
    r = kpis.revenue_by_quarter_scoped(s.fact, s.cal, s.customer, CITY)
    d = trends.yoy(r, "revenue_sp", present="revenue_present", base="revenue_base",
                   delta="yoy_pct")
    return present(d, ints=["year", "quarter"], money=["revenue_present", "revenue_base"],
                   rates=["yoy_pct"])


def _diff_sql(view: str, col: str, present_name: str, base_name: str, delta_name: str,
              scale: float) -> str:
    return f"""
SELECT {O.yq('t.')}, {O.r6(f'{scale} * t.{col}', present_name)},
       {O.r6(f'{scale} * b.{col}', base_name)},
       {O.r6(f'{scale} * (t.{col} - b.{col})', delta_name)}
FROM {view} t LEFT JOIN {view} b ON {_qi('b')} + 4 = {_qi('t')}
"""


@register("reviews_yoy_pp", O.q(_diff_sql("quarter_reviews", "share_ge4", "share_present_pct",
                                          "share_base_pct", "delta_pp", 100.0)))
def reviews_yoy_pp(s: Star) -> DataFrame:
    """O-56: review share >= 4 in t vs t-4, in percentage points."""
    oq = kpis.orders_by_quarter_rows(s.orders, s.customer, s.cal, CITY)
    d = trends.yoy(kpis.review_share(oq, s.reviews), "share_ge4", mode="diff", scale=100.0,
                   present="share_present_pct", base="share_base_pct", delta="delta_pp")
    return present(d, ints=["year", "quarter"],
                   rates=["share_present_pct", "share_base_pct", "delta_pp"])


@register("leadtime_yoy", O.q(_diff_sql("quarter_lead", "lead_time_p90", "p90_actual_days",
                                        "p90_base_days", "delta_days", 1.0)))
def leadtime_yoy(s: Star) -> DataFrame:
    """O-57: P90 lead time in t vs t-4, in days."""
    d = trends.yoy(kpis.lead_time_pctl(s.fact, s.cal, s.customer, CITY), "lead_time_p90",
                   mode="diff", present="p90_actual_days", base="p90_base_days",
                   delta="delta_days")
    return present(d, ints=["year", "quarter"],
                   rates=["p90_actual_days", "p90_base_days", "delta_days"])


@register("on_time_yoy_pp", O.q(f"""
, ot AS (
  SELECT year, quarter,
         avg(CASE WHEN on_time_flag = 1 THEN 1.0 WHEN on_time_flag = 0 THEN 0.0 END) AS on_time_rate,
         count(on_time_flag) AS coverage_n
  FROM scoped GROUP BY year, quarter)
SELECT {O.yq('t.')}, {O.r6('100.0 * t.on_time_rate', 'ontime_pct')},
       {O.r6('100.0 * b.on_time_rate', 'base_pct')},
       {O.r6('100.0 * (t.on_time_rate - b.on_time_rate)', 'delta_pp')},
       CAST(t.coverage_n AS BIGINT) AS coverage_n
FROM ot t LEFT JOIN ot b ON {_qi('b')} + 4 = {_qi('t')}
""".replace("\n, ot AS", ", ot AS", 1)))
def on_time_yoy_pp(s: Star) -> DataFrame:
    """O-58: on-time rate in t vs t-4 in pp, with the rows behind the rate."""
    rows = kpis.scoped_fact(s.fact, s.cal, s.customer, CITY)
    r = rows.groupBy(*trends.YQ).agg(F.avg(kpis.on_time_value()).alias("on_time_rate"),
                                     F.count("on_time_flag").alias("coverage_n"))
    d = trends.yoy(r, "on_time_rate", mode="diff", scale=100.0, present="ontime_pct",
                   base="base_pct", delta="delta_pp", carry=["coverage_n"])
    return present(d, ints=["year", "quarter"], longs=["coverage_n"],
                   rates=["ontime_pct", "base_pct", "delta_pp"])


_FROZEN_CTES = f"""
, top AS (
  SELECT year, quarter, category, share_cat FROM category_sales
  QUALIFY row_number() OVER (PARTITION BY year, quarter
                             ORDER BY share_cat DESC NULLS LAST, category) = 1),
qs AS (SELECT year, quarter, max(revenue_total) AS revenue_total
       FROM category_sales GROUP BY year, quarter),
frozen AS (
  SELECT qs.year, qs.quarter, top.category AS top_category, qs.revenue_total,
         top.share_cat AS base_share,
         CASE WHEN top.category IS NULL THEN NULL WHEN n.category IS NULL THEN 0.0
              ELSE n.share_cat END AS now_share
  FROM qs LEFT JOIN top ON {_qi('top')} + 4 = {_qi('qs')}
  LEFT JOIN category_sales n
         ON n.year = qs.year AND n.quarter = qs.quarter AND n.category = top.category)
"""


@register("top_category_frozen", O.q(_FROZEN_CTES + f"""
SELECT {O.yq()}, top_category, {O.r6('now_share * 100.0', 'share_pct')},
       {O.r6('base_share * 100.0', 'base_pct')},
       {O.r6('(now_share - base_share) * 100.0', 'delta_pp')},
       {O.money('revenue_total', 'revenue_total')}
FROM frozen
"""))
def top_category_frozen(s: Star) -> DataFrame:
    """O-59: share of the category that led in t-4, in t and t-4."""
    d = trends.frozen_top_category(_cat_share(s))
    return present(d, ints=["year", "quarter"], money=["revenue_total"],
                   rates=["share_pct", "base_pct", "delta_pp"])


_TARGET_CTES = _FROZEN_CTES + f"""
, rev_y AS (
  SELECT t.year, t.quarter,
         100.0 * (CAST(t.revenue_sp AS DOUBLE) - CAST(b.revenue_sp AS DOUBLE))
               / NULLIF(CAST(b.revenue_sp AS DOUBLE), 0) AS d
  FROM quarter_sales t LEFT JOIN quarter_sales b ON {_qi('b')} + 4 = {_qi('t')}),
rv_y AS (SELECT t.year, t.quarter, 100.0 * (t.share_ge4 - b.share_ge4) AS d
         FROM quarter_reviews t LEFT JOIN quarter_reviews b ON {_qi('b')} + 4 = {_qi('t')}),
lt_y AS (SELECT t.year, t.quarter, 1.0 * (t.lead_time_p90 - b.lead_time_p90) AS d
         FROM quarter_lead t LEFT JOIN quarter_lead b ON {_qi('b')} + 4 = {_qi('t')}),
ot_y AS (SELECT t.year, t.quarter, 100.0 * (t.on_time_rate - b.on_time_rate) AS d
         FROM quarter_sales t LEFT JOIN quarter_sales b ON {_qi('b')} + 4 = {_qi('t')}),
tc_y AS (SELECT year, quarter, (now_share - base_share) * 100.0 AS d FROM frozen),
all_t AS (
  SELECT 'revenue_yoy' AS kpi, year, quarter, d, 2.0 AS target, d >= 2.0 AS met FROM rev_y
  UNION ALL SELECT 'reviews_ge4_share', year, quarter, d, 2.0, d >= 2.0 FROM rv_y
  UNION ALL SELECT 'lead_time_p90', year, quarter, d, -0.2, d <= -0.2 FROM lt_y
  UNION ALL SELECT 'on_time_rate', year, quarter, d, 2.0, d >= 2.0 FROM ot_y
  UNION ALL SELECT 'top_category_share', year, quarter, d, 2.0, d >= 2.0 FROM tc_y)
"""


@register("kpi_targets", O.q(_TARGET_CTES + f"""
SELECT kpi, {O.yq()}, {O.r6('d', 'delta')}, CAST(target AS DOUBLE) AS target,
       CAST(CAST(met AS INTEGER) AS DOUBLE) AS met FROM all_t
"""))
def kpi_targets(s: Star) -> DataFrame:
    """O-60: YoY deltas of the five KPIs against their goals."""
    from ..functions.columns import quarter_index
    # revenue, P90 and on-time: one aggregate of the scoped fact, one t / t-4 join
    fk = kpis.fact_kpis(s.fact, s.cal, s.customer, CITY).checkpoint(eager=True)  # a row per quarter, read twice
    cur = fk.withColumn("_qi", quarter_index())
    base = fk.select((quarter_index() + F.lit(4)).alias("_qi"),
                     F.col("revenue_sp").alias("_b_rev"), F.col("lead_time_p90").alias("_b_lt"),
                     F.col("on_time_rate").alias("_b_ot"))
    j = cur.join(base, "_qi", "left")
    rev, brev = F.col("revenue_sp").cast("double"), F.col("_b_rev").cast("double")
    fact_wide = j.select(
        *trends.YQ,
        (F.lit(100.0) * (rev - brev) / F.nullif(brev, F.lit(0.0))).alias("revenue_yoy"),
        F.lit(True).alias("revenue_yoy__present"),
        (F.lit(1.0) * (F.col("lead_time_p90") - F.col("_b_lt"))).alias("lead_time_p90"),
        F.col("lead_time_p90").isNotNull().alias("lead_time_p90__present"),
        (F.lit(100.0) * (F.col("on_time_rate") - F.col("_b_ot"))).alias("on_time_rate"),
        F.lit(True).alias("on_time_rate__present"))
    oq = kpis.orders_by_quarter_rows(s.orders, s.customer, s.cal, CITY)
    rv = trends.yoy(kpis.review_share(oq, s.reviews), "share_ge4", mode="diff", scale=100.0,
                    delta="reviews_ge4_share").select(
        *trends.YQ, "reviews_ge4_share", F.lit(True).alias("reviews_ge4_share__present"))
    tc = trends.frozen_top_category(_cat_share(s)).select(
        *trends.YQ, F.col("delta_pp").alias("top_category_share"),
        F.lit(True).alias("top_category_share__present"))
    wide = fact_wide.join(rv, trends.YQ, "full").join(tc, trends.YQ, "full")
    d = trends.targets_long(wide).withColumn("met", F.col("met").cast("int"))
    return present(d, ints=["year", "quarter"], rates=["delta"], nullable_ints=["met"])


def _pareto_sql(by: str) -> str:
    return O.q(f"""
, seg AS (SELECT year, quarter, {by} AS segment, sum(price) AS revenue
          FROM scoped GROUP BY year, quarter, {by}),
cum AS (
  SELECT year, quarter, segment, revenue,
         row_number() OVER w AS rank,
         sum(revenue) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_revenue,
         sum(revenue) OVER (PARTITION BY year, quarter) AS revenue_total
  FROM seg WINDOW w AS (PARTITION BY year, quarter ORDER BY revenue DESC, segment))
SELECT {O.yq()}, segment, CAST(rank AS BIGINT) AS rank, {O.money('revenue', 'revenue')},
       {O.money('cum_revenue', 'cum_revenue')}, {O.money('revenue_total', 'revenue_total')},
       {O.r6('CAST(cum_revenue AS DOUBLE) / NULLIF(CAST(revenue_total AS DOUBLE), 0)', 'cum_share')},
       (cum_revenue - revenue) < revenue_total * 0.8 AS in_core
FROM cum
""".replace("\n, seg AS", ", seg AS", 1))


def _pareto(s: Star, by: str) -> DataFrame:
    rows = kpis.scoped_fact(s.fact, s.cal, s.customer, CITY, s.product, ["customer_id"])
    d = trends.pareto(rows, by)
    return present(d, ints=["year", "quarter"], longs=["rank"],
                   money=["revenue", "cum_revenue", "revenue_total"], rates=["cum_share"])


@register("pareto_category", _pareto_sql("category"))
def pareto_category(s: Star) -> DataFrame:
    """O-61: cumulative revenue curve of categories per quarter (80 % core)."""
    return _pareto(s, "category")


@register("pareto_customer", _pareto_sql("customer_id"))
def pareto_customer(s: Star) -> DataFrame:
    """O-61: cumulative revenue curve of customers per quarter (80 % core)."""
    return _pareto(s, "customer_id")


@register("purchase_interval", O.q(f"""
, o AS (
  SELECT o.customer_id, o.order_id, o.order_approved_at AS ts
  FROM orders_raw o JOIN dim_customer dc ON dc.customer_id = o.customer_id
  WHERE dc.customer_city = '{O.CITY}' AND o.order_approved_at IS NOT NULL),
l AS (SELECT ts, epoch(ts - lag(ts) OVER (PARTITION BY customer_id ORDER BY ts, order_id)) / 86400.0 AS d
      FROM o)
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
       {O.r6('avg(d)', 'avg_days_between_orders')}, count(*) AS repeat_orders
FROM l WHERE d IS NOT NULL GROUP BY 1, 2
""".replace("\n, o AS", ", o AS", 1)))
def purchase_interval(s: Star) -> DataFrame:
    """O-62: mean days between a customer's consecutive orders, per quarter."""
    c = s.customer.filter(F.col("customer_city") == CITY).select("customer_id")
    orders = s.orders.join(c, "customer_id", "inner")
    d = trends.purchase_interval_by_quarter(trends.purchase_interval(orders))
    return present(d, ints=["year", "quarter"], longs=["repeat_orders"],
                   rates=["avg_days_between_orders"])
