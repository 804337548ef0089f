"""Conformed dimensions: calendar, customer, product, seller, external.

O-17 calendar parts, O-18 normalization, O-27 build_calendar,
O-28 build_dim_customer, O-29 build_dim_product, O-32 build_dim_seller,
O-33 build_dim_external.  Keys come from ``keys.assign_sk`` (O-30) and new
rows are added only when absent (O-31), so re-running a build never moves an
existing key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import calendar_parts, norm_lower, norm_upper
from .keys import assign_sk, insert_absent, max_key

# A calendar holds one row per day: its size is bounded by the date span
# (36,525 rows per century), so it is safe to broadcast.
CALENDAR_MAX_BROADCAST_DAYS = 200_000


def _first_by_key(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """One row per key with the smallest attribute tuple: DISTINCT + DO NOTHING
    made deterministic.  A partial aggregate, so a hot key is combined map-side."""
    pick = F.min(F.struct(*[F.col(a) for a in attrs])).alias("_a")
    return df.groupBy(key).agg(pick).select(key, *[F.col(f"_a.{a}").alias(a) for a in attrs])


def build_calendar(orders: DataFrame, existing: DataFrame | None = None,
                   date_col: str = "order_delivered_customer_date") -> DataFrame:
    """O-27: one row per day between the first and last delivery date of all
    staged orders, with O-17 parts.  First build: sk = days since the first
    day + 1; later days (before or after) get max(sk) + rank."""
    bounds = orders.agg(F.min(F.to_date(date_col)).alias("dmin"),
                        F.max(F.to_date(date_col)).alias("dmax"))
    days = bounds.select("dmin", F.explode(
        F.sequence("dmin", "dmax", F.expr("INTERVAL 1 DAY"))).alias("date"))
    parts = calendar_parts("date")
    cols = ["date", "day_of_week", "week", "month", "quarter", "year"]
    if existing is None:
        return days.select((F.datediff("date", "dmin") + 1).cast("bigint").alias("calendar_sk"),
                           "date", *[parts[c].alias(c) for c in cols[1:]])
    new_days = days.select("date", *[parts[c].alias(c) for c in cols[1:]])
    return assign_sk(new_days, ["date"], "calendar_sk", existing)


def build_dim_customer(customers: DataFrame, existing: DataFrame | None = None,
                       deaccent: bool = False) -> DataFrame:
    """O-28: customer_id with trim(lower(city)) / trim(upper(state))."""
    norm = customers.select("customer_id",
                            norm_lower("customer_city", deaccent).alias("customer_city"),
                            norm_upper("customer_state").alias("customer_state"))
    rows = _first_by_key(norm.filter(F.col("customer_id").isNotNull()), "customer_id",
                         ["customer_city", "customer_state"])
    return assign_sk(rows, ["customer_id"], "customer_sk", existing)


def build_dim_product(products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """O-29: product_id with the English category, trim(lower())."""
    norm = products.select("product_id",
                           norm_lower("product_category_name_english").alias("product_category_name"))
    rows = _first_by_key(norm.filter(F.col("product_id").isNotNull()), "product_id",
                         ["product_category_name"])
    return assign_sk(rows, ["product_id"], "product_sk", existing)


def build_dim_seller(sellers: DataFrame, existing: DataFrame | None = None,
                     deaccent: bool = False) -> DataFrame:
    """O-32: seller_id with normalized city and state (spec-only in the reference)."""
    norm = sellers.select("seller_id",
                          norm_lower("seller_city", deaccent).alias("seller_city"),
                          norm_upper("seller_state").alias("seller_state"))
    rows = _first_by_key(norm.filter(F.col("seller_id").isNotNull()), "seller_id",
                         ["seller_city", "seller_state"])
    return assign_sk(rows, ["seller_id"], "seller_sk", existing)


def build_dim_external(holiday_days: DataFrame, weather: DataFrame,
                       existing: DataFrame | None = None) -> DataFrame:
    """O-33: one row per (date, city) from holidays and weather (full join),
    ``external_sk`` assigned in (date, city) order.  Of several weather records
    of a day the one with the highest (temp, rain) stays, unknown values last."""
    best = F.max(F.struct("temp", "rain")).alias("_w")
    weather = weather.groupBy("date", "city").agg(best).select("date", "city", "_w.temp", "_w.rain")
    holiday_days = holiday_days.groupBy("date", "city").agg(F.max("is_holiday").alias("is_holiday"))
    h = holiday_days.select("date", "city", F.col("is_holiday").cast("int").alias("is_holiday"))
    w = weather.select("date", "city", F.col("temp").alias("temp"), F.col("rain").alias("rain"))
    merged = (w.join(h, ["date", "city"], "full")
              .select("date", "city", "temp", "rain", "is_holiday"))
    return assign_sk(merged, ["date", "city"], "external_sk", existing)


def calendar_for_join(calendar: DataFrame, n_days_bound: int | None = None) -> DataFrame:
    """Broadcast hint for the calendar when its row bound is known to be small."""
    if n_days_bound is not None and n_days_bound <= CALENDAR_MAX_BROADCAST_DAYS:
        return F.broadcast(calendar)
    return calendar


__all__ = ["build_calendar", "build_dim_customer", "build_dim_product", "build_dim_seller",
           "build_dim_external", "calendar_for_join", "insert_absent", "max_key"]
