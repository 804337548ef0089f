"""Period-over-period and concentration operators.

O-54 delta_prev, O-55..O-58 yoy, O-59 frozen_top_category, O-60 kpi_targets,
O-61 pareto, O-62 purchase_interval.

LAG and YoY windows run over *aggregated* rows (one per quarter and
category), which are bounded by the calendar.  The Pareto curve and the
purchase interval run over per-customer rows, whose groups are unbounded:
they use the range-partitioned running total / LAG of ``keys.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import quarter_index, share
from .keys import lag_within, running_total

YQ = ["year", "quarter"]

# ---------------------------------------------------------------------------
# KPI goals stated by the reference (year over year).
# ---------------------------------------------------------------------------
TARGETS = [
    # (kpi, delta column, goal, direction)
    ("revenue_yoy", "yoy_pct", 2.0, ">="),           # revenue +2 % YoY
    ("reviews_ge4_share", "delta_pp", 2.0, ">="),    # reviews >= 4 stars +2 pp
    ("lead_time_p90", "delta_days", -0.2, "<="),     # P90 lead time <= -0.2 days
    ("on_time_rate", "delta_pp", 2.0, ">="),         # on-time rate +2 pp
    ("top_category_share", "delta_pp", 2.0, ">="),   # frozen top category +2 pp
]


# ---------------------------------------------------------------------------
# O-54 delta vs previous existing row
# ---------------------------------------------------------------------------
def delta_prev(df: DataFrame, measures: Sequence[str], part: Sequence[str],
               order: Sequence[str] = YQ, delta_of: Sequence[str] = ()) -> DataFrame:
    """``<m>_prev`` = LAG(m) over (partition by part order by order); for each
    column in ``delta_of`` also ``delta_<m>`` = m - coalesce(prev, 0).
    "Previous" is the previous *existing* row, gaps are skipped."""
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    out = df.withColumns({f"{m}_prev": F.lag(m, 1).over(w) for m in measures})
    for m in delta_of:
        out = out.withColumn(f"delta_{m}", F.col(m) - F.coalesce(F.col(f"{m}_prev"), F.lit(0)))
    return out


# ---------------------------------------------------------------------------
# O-55 .. O-58 year over year (exact quarter t-4, not LAG(4))
# ---------------------------------------------------------------------------
def yoy(df: DataFrame, value: str, keys: Sequence[str] = (), mode: str = "relative",
        scale: float = 1.0, present: str = "present", base: str = "base",
        delta: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Compare each quarter with the same quarter a year earlier.

    ``mode='relative'``: delta = 100 * (present - base) / base (NULL if base is
    0 or missing).  ``mode='diff'``: delta = scale * (present - base).  Present
    and base are multiplied by ``scale``.  A missing base quarter leaves base
    and delta NULL and keeps the row.  ``carry`` columns of the present row
    are passed through.  ``df`` has one row per quarter and ``keys``; each row
    goes out under its own quarter and under the one a year later, so it is
    computed once and one aggregate brings the pairs together.
    """
    keys = list(keys)
    both = df.select(*keys, F.struct(*YQ, F.col(value).alias("_p"), *carry).alias("_row"),
                     F.explode(F.array(F.lit(0), F.lit(4))).alias("_later"))
    both = both.withColumn("_qi", quarter_index("_row.year", "_row.quarter") + F.col("_later"))
    j = (both.groupBy("_qi", *keys)
         .agg(F.max(F.when(F.col("_later") == 0, F.col("_row"))).alias("_now"),
              F.max(F.when(F.col("_later") == 4, F.col("_row"))).alias("_then"))
         .where("_now is not null").select(*keys, "_now.*", F.col("_then._p").alias("_b")))
    p, b = F.col("_p").cast("double"), F.col("_b").cast("double")
    if mode == "relative":
        d = F.lit(100.0) * (p - b) / F.nullif(b, F.lit(0.0))
        dname = delta or "yoy_pct"
        pv, bv = F.col("_p"), F.col("_b")
    else:
        d = F.lit(float(scale)) * (p - b)
        dname = delta or "delta"
        pv, bv = p * F.lit(float(scale)), b * F.lit(float(scale))
    return j.select(*YQ, *keys, pv.alias(present), bv.alias(base), d.alias(dname), *carry)


# ---------------------------------------------------------------------------
# O-59 frozen top category
# ---------------------------------------------------------------------------
def frozen_top_category(cat_share: DataFrame) -> DataFrame:
    """C* = the category with the largest revenue share in t-4 (ties: the
    smaller name); report C*'s share in t and in t-4, the pp delta and t's
    total revenue.  C* selling nothing in t gives share 0; a quarter without
    t-4 keeps NULLs.  The shares, an aggregate, are computed once."""
    cat_share = cat_share.checkpoint(eager=True)
    rank_w = Window.partitionBy(*YQ).orderBy(F.col("share_cat").desc_nulls_last(),
                                             F.col("category").asc_nulls_last())
    top = (cat_share.withColumn("_r", F.row_number().over(rank_w)).filter(F.col("_r") == 1)
           .select((quarter_index() + F.lit(4)).alias("_qi"),
                   F.col("category").alias("top_category"),
                   F.col("share_cat").alias("_base_share")))
    quarters = (cat_share.groupBy(*YQ).agg(F.max("revenue_total").alias("revenue_total"))
                .withColumn("_qi", quarter_index()))
    t = quarters.join(top, "_qi", "left")
    now = cat_share.select(*YQ, F.col("category").alias("top_category"),
                           F.col("share_cat").alias("_now_share"), F.lit(True).alias("_seen"))
    j = t.join(now, [*YQ, "top_category"], "left")
    share_now = F.when(F.col("top_category").isNull(), F.lit(None).cast("double")).when(
        F.col("_seen").isNull(), F.lit(0.0)).otherwise(F.col("_now_share"))
    return j.select(*YQ, "top_category",
                    (share_now * 100.0).alias("share_pct"),
                    (F.col("_base_share") * 100.0).alias("base_pct"),
                    ((share_now - F.col("_base_share")) * 100.0).alias("delta_pp"),
                    "revenue_total")


# ---------------------------------------------------------------------------
# O-60 target check
# ---------------------------------------------------------------------------
def kpi_targets(deltas: dict[str, DataFrame], targets: Sequence[tuple] = TARGETS) -> DataFrame:
    """One row per (kpi, quarter): delta, goal, met (NULL when no delta)."""
    parts = []
    for kpi, col, goal, op in targets:
        if kpi not in deltas:
            continue
        d = F.col(col).cast("double")
        met = (d >= F.lit(goal)) if op == ">=" else (d <= F.lit(goal))
        parts.append(deltas[kpi].select(F.lit(kpi).alias("kpi"), *YQ, d.alias("delta"),
                                        F.lit(float(goal)).alias("target"), met.alias("met")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def targets_long(wide: DataFrame, targets: Sequence[tuple] = TARGETS) -> DataFrame:
    """The same rows as ``kpi_targets`` from ONE wide frame (year, quarter,
    ``<kpi>`` = delta, ``<kpi>__present`` = the KPI exists that quarter): one
    ``inline`` of an array of structs, no union of separate scans."""
    entries = []
    for kpi, _col, goal, op in targets:
        if kpi not in wide.columns:
            continue
        d = F.col(kpi).cast("double")
        met = (d >= F.lit(goal)) if op == ">=" else (d <= F.lit(goal))
        entries.append(F.struct(F.lit(kpi).alias("kpi"), d.alias("delta"),
                                F.lit(float(goal)).alias("target"), met.alias("met"),
                                F.coalesce(F.col(f"{kpi}__present"), F.lit(False)).alias("_on")))
    long = wide.select(*YQ, F.inline(F.array(*entries)))
    return long.filter(F.col("_on")).select("kpi", *YQ, "delta", "target", "met")


# ---------------------------------------------------------------------------
# O-61 Pareto
# ---------------------------------------------------------------------------
def pareto(rows: DataFrame, by: str, value: str = "price", cut: float = 0.8) -> DataFrame:
    """Per quarter, segments by revenue (desc, then key asc) with the
    cumulative revenue and share; ``in_core`` marks the segments up to and
    including the one that crosses ``cut``.  ``rows`` needs year, quarter,
    ``by`` and ``value``."""
    seg = rows.groupBy(*YQ, by).agg(F.sum(value).alias("revenue"))
    ranked = running_total(seg, order_by=[F.col("revenue").desc(), F.col(by).asc()],
                           partition_by=YQ, values={"cum_revenue": F.col("revenue"),
                                                    "rank": F.lit(1).cast("bigint")})
    totals = seg.groupBy(*YQ).agg(F.sum("revenue").alias("revenue_total"))
    j = ranked.join(totals, YQ, "inner")
    before = F.col("cum_revenue") - F.col("revenue")
    return j.select(*YQ, F.col(by).alias("segment"), "rank", "revenue", "cum_revenue",
                    "revenue_total", share("cum_revenue", "revenue_total").alias("cum_share"),
                    (before < F.col("revenue_total") * F.lit(cut)).alias("in_core"))


# ---------------------------------------------------------------------------
# O-62 purchase interval
# ---------------------------------------------------------------------------
def purchase_interval(orders: DataFrame, ts: str = "order_approved_at",
                      customer: str = "customer_id", order_id: str = "order_id") -> DataFrame:
    """Days since the same customer's previous order (by ``ts``, then order
    id), per order; orders without ``ts`` are left out."""
    o = orders.filter(F.col(ts).isNotNull()).select(customer, order_id, ts)
    with_prev = lag_within(o, [customer], [ts, order_id], ts, "_prev_ts")
    days = (F.timestamp_diff("MICROSECOND", F.col("_prev_ts"), F.col(ts)).cast("double")
            / F.lit(86400e6))
    return with_prev.select(customer, order_id, ts, F.col("_prev_ts").alias("prev_ts"),
                            days.alias("days_since_prev"))


def purchase_interval_by_quarter(intervals: DataFrame, ts: str = "order_approved_at") -> DataFrame:
    """Mean days between consecutive orders, per quarter of the later order."""
    d = intervals.filter(F.col("days_since_prev").isNotNull())
    return (d.groupBy(F.year(ts).cast("int").alias("year"), F.quarter(ts).cast("int").alias("quarter"))
            .agg(F.avg("days_since_prev").alias("avg_days_between_orders"),
                 F.count(F.lit(1)).alias("repeat_orders")))
