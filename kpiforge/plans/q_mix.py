"""Registered queries: top-k, trend matrix, frequencies, profile (O-63..O-69)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import accent_blind
from ..operators import kpis, mix
from ..sources.contracts import ORDERS
from . import oracle as O
from .catalog import CITY, present, register
from .star import Star, latest_items_of

TOP_K = 10
FREQ_K = 5
STATE = "ASIA"


def _cat_share(s: Star) -> DataFrame:
    return kpis.category_share(s.fact, s.cal, s.customer, s.product, CITY)


@register("top_categories", O.q(f"""
SELECT category, {O.money('sum(revenue_cat)', 'revenue')}, {O.r6('avg(share_cat)', 'avg_share')}
FROM category_sales GROUP BY category ORDER BY sum(revenue_cat) DESC, category LIMIT {TOP_K}
"""))
def top_categories(s: Star) -> DataFrame:
    """O-63: top-10 categories by revenue with their mean quarterly share."""
    return present(mix.top_categories(_cat_share(s), TOP_K), money=["revenue"],
                   rates=["avg_share"])


def _trend_sql() -> str:
    cols = ", ".join(f"(SELECT category FROM best WHERE place = {i}) AS category_{i}, "
                     f"max(v) FILTER (WHERE place = {i}) AS share_{i}" for i in range(1, TOP_K + 1))
    return f"""
, best AS (SELECT category, row_number() OVER (ORDER BY sum(revenue_cat) DESC, category) AS place
           FROM category_sales GROUP BY category),
cells AS (SELECT CAST(year AS VARCHAR) || ' Q' || CAST(quarter AS VARCHAR) AS label, place,
                 CAST(round(CAST(CAST(share_cat AS DOUBLE) AS DECIMAL(38,10)), 6) AS DOUBLE) AS v
          FROM category_sales JOIN best USING (category) WHERE place <= {TOP_K})
SELECT label, {cols} FROM cells GROUP BY label
"""


@register("category_trend", O.q(_trend_sql()))
def category_trend(s: Star) -> DataFrame:
    """O-64: quarter label x top-10 category matrix of revenue shares."""
    d = mix.category_trend(_cat_share(s), TOP_K)
    return present(d, rates=[c for c in d.columns if c.startswith("share_")])


@register("freq_status", O.q("""
SELECT order_status, count(*) AS count FROM orders_raw WHERE order_status IS NOT NULL
GROUP BY order_status
"""))
def freq_status(s: Star) -> DataFrame:
    """O-65: frequency of order status in staging."""
    return mix.value_counts(s.orders, "order_status")


@register("freq_city", O.q(f"""
SELECT customer_city, count(*) AS count FROM dim_customer WHERE customer_city IS NOT NULL
GROUP BY customer_city ORDER BY count(*) DESC, customer_city LIMIT {FREQ_K}
"""))
def freq_city(s: Star) -> DataFrame:
    """O-65: five most frequent customer cities."""
    return mix.value_counts(s.customer, "customer_city", FREQ_K)


@register("customers_by_city", O.q(f"""
SELECT customer_city, count(*) AS customers FROM dim_customer WHERE customer_state = '{STATE}'
GROUP BY customer_city
"""))
def customers_by_city(s: Star) -> DataFrame:
    """O-66: customers per city inside one state."""
    return mix.customers_by_city(s.customer, STATE)


# The customers' cities as people write them: as they are, in capitals with accents, or in small letters with one
_SPELT = """CASE CAST(customer_id AS BIGINT) % 3 WHEN 0 THEN customer_city
     WHEN 1 THEN replace(replace(upper(customer_city), 'A', 'Á'), 'O', 'Õ') ELSE replace(lower(customer_city), 'n', 'ñ') END"""


@register("city_accent_blind", O.q(f"""
SELECT u.customer_city AS city, count(*) AS customers, count(DISTINCT r.spelt) AS spellings,
       count(*) FILTER (WHERE u.customer_city = '{CITY}') AS in_scope
FROM (SELECT {_SPELT} AS spelt FROM customers_raw) r
JOIN (SELECT DISTINCT customer_city FROM dim_customer) u ON strip_accents(lower(trim(r.spelt))) = strip_accents(u.customer_city)
GROUP BY u.customer_city
"""))
def city_accent_blind(s: Star) -> DataFrame:
    """O-18 by collation: city texts in several spellings joined to the cities of
    the customer dimension without regard to case, accents and blanks."""
    spelt = s.customers.select(F.expr(_SPELT).alias("spelt"))
    cities = s.customer.select(F.col("customer_city").alias("city")).distinct()
    both = spelt.join(cities, accent_blind("spelt") == accent_blind("city"))
    here = accent_blind("spelt") == accent_blind(F.lit(CITY))
    return both.groupBy("city").agg(F.count(F.lit(1)).alias("customers"), F.count_distinct("spelt").alias("spellings"),
                                    F.count_if(here).alias("in_scope"))


def _profile_sql() -> str:
    cols = [(c, t) for c, t in ORDERS.columns] + [
        ("_ingested_at", "timestamp_ntz"), ("_source_file", "string"), ("_row_md5", "string")]
    parts = []
    for c, t in cols:
        cnt = f"count({c})" if not c.startswith("_") else "count(*)"
        parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, "
                     f"{cnt} AS non_null, count(*) - {cnt} AS nulls FROM orders_raw")
    return O.q("\n UNION ALL ".join(parts))


@register("profile_nulls", _profile_sql())
def profile_nulls(s: Star) -> DataFrame:
    """O-67: rows, non-NULL, NULL and type per column of staged orders."""
    return mix.profile(s.orders)


@register("count_reviews_ge4", O.q("""
SELECT count(*) FILTER (WHERE review_score >= 4) AS n_match, count(*) AS n_rows FROM reviews_raw
"""))
def count_reviews_ge4(s: Star) -> DataFrame:
    """O-68: conditional count of reviews with score >= 4."""
    return mix.count_where(s.reviews, F.col("review_score") >= 4)


def _rows_with(s: Star, entity: str) -> DataFrame:
    rows = s.fact.join(s.product.select("product_sk", F.col("product_category_name")
                                        .alias("category")), "product_sk", "inner")
    if entity == "seller_id":
        rows = rows.join(latest_items_of(s).select("order_id", "order_item_id", "seller_id"),
                         ["order_id", "order_item_id"], "inner")
    elif entity == "customer_id":
        rows = rows.join(s.customer.select("customer_sk", "customer_id"), "customer_sk", "inner")
    elif entity == "product_id":
        rows = rows.join(s.product.select("product_sk", "product_id"), "product_sk", "inner")
    return rows


def _mix_sql(entity: str, join: str) -> str:
    return O.q(f"""
, r AS (SELECT f.price, dp.product_category_name AS category, {join}
        FROM fact f JOIN dim_product dp ON dp.product_sk = f.product_sk {{J}}),
tot AS (SELECT {entity}, sum(price) AS entity_revenue FROM r GROUP BY {entity}
        ORDER BY entity_revenue DESC, {entity} LIMIT {TOP_K}),
m AS (SELECT {entity}, category, sum(price) AS mix_revenue FROM r
      WHERE {entity} IN (SELECT {entity} FROM tot) GROUP BY {entity}, category)
SELECT m.{entity}, {O.money('tot.entity_revenue', 'entity_revenue')}, m.category,
       {O.money('m.mix_revenue', 'mix_revenue')},
       {O.r6('CAST(m.mix_revenue AS DOUBLE) / NULLIF(CAST(tot.entity_revenue AS DOUBLE), 0)', 'mix_share')}
FROM m JOIN tot USING ({entity})
""".replace("\n, r AS", ", r AS", 1))


_SELLER_JOIN = "JOIN items i ON i.order_id = f.order_id AND i.order_item_id = f.order_item_id"
_CUST_JOIN = "JOIN dim_customer dc ON dc.customer_sk = f.customer_sk"


@register("top_sellers_mix", _mix_sql("seller_id", "i.seller_id").replace("{J}", _SELLER_JOIN))
def top_sellers_mix(s: Star) -> DataFrame:
    """O-69: top-10 sellers by revenue and the categories they sell."""
    d = mix.top_with_mix(_rows_with(s, "seller_id"), "seller_id", "category", k=TOP_K)
    return present(d, money=["entity_revenue", "mix_revenue"], rates=["mix_share"])


@register("top_customers_mix", _mix_sql("customer_id", "dc.customer_id").replace("{J}", _CUST_JOIN))
def top_customers_mix(s: Star) -> DataFrame:
    """O-69: top-10 customers by revenue and the categories they buy."""
    d = mix.top_with_mix(_rows_with(s, "customer_id"), "customer_id", "category", k=TOP_K)
    return present(d, money=["entity_revenue", "mix_revenue"], rates=["mix_share"])


@register("top_products", _mix_sql("product_id", "dp.product_id").replace("{J}", ""))
def top_products(s: Star) -> DataFrame:
    """O-69: top-10 products by revenue with their category."""
    d = mix.top_with_mix(_rows_with(s, "product_id"), "product_id", "category", k=TOP_K)
    return present(d, money=["entity_revenue", "mix_revenue"], rates=["mix_share"])
