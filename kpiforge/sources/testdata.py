"""Adapter: the driver's TPC-H-style tables -> the staging shape.

The test tables hold no marketplace files, so this module only gives rows in
the staging schema the jobs expect (orders, items, customers, products,
reviews, sellers, holidays, weather).  It does none of the jobs' work; the
same mapping prefixes every DuckDB twin in ``plans/oracle.py``.

Mapping (see SURVEY 7.3): orders from ``orders`` (+ the latest ship date of
its lines as delivery date), items from ``lineitem`` (one line may appear
more than once per key: the ship date is stamped as ``_ingested_at`` so the
latest version can be chosen), customers from ``customer`` ⋈ ``nation`` ⋈
``region`` with padded city text, products from ``part`` with a category
translation, reviews from ``events``, sellers from ``supplier``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.contracts import (CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, REVIEWS,
                                 SELLERS)
from ..sources.staging import read_products, with_lineage

# ---------------------------------------------------------------------------
# Fixed values of the adapter
# ---------------------------------------------------------------------------
LOAD_TS = "2024-06-30 00:00:00"          # load time stamped on staged rows
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "processing"}
APPROVAL_GAP_EVERY = 97                  # every 97th order key has no approval time
# days from order date to the promised delivery, by order priority
ESTIMATE_DAYS = {"1-URGENT": 500, "2-HIGH": 1000, "3-MEDIUM": 1500, "5-LOW": 2000}
# category translation (PROMO has none, so its products fall out of the fact)
CATEGORY_TRANSLATION = [
    ("ECONOMY", " Economy Goods"),
    ("LARGE", "Large Items "),
    ("MEDIUM", " MEDIUM ITEMS "),
    ("SMALL", "small items"),
    ("STANDARD", "Standard Goods"),
]
REVIEW_SCORES = 5                        # score = 1 + user_id mod 5
DEFAULT_CITY = "nation_2"                # KPI scope used by the tests
DEFAULT_STATE = "ASIA"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _load_ts() -> F.Column:
    return F.lit(LOAD_TS).cast("timestamp_ntz")


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    last_ship = (_read(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("delivered")))
    status = F.create_map(*[x for k, v in STATUS_MAP.items() for x in (F.lit(k), F.lit(v))])
    est_days = F.create_map(*[x for k, v in ESTIMATE_DAYS.items() for x in (F.lit(k), F.lit(v))])
    approved = F.when(F.col("o_orderkey") % APPROVAL_GAP_EVERY == 0,
                      F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate"))
    df = (o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
          .select(F.col("o_orderkey").cast("string").alias("order_id"),
                  F.col("o_custkey").cast("string").alias("customer_id"),
                  status[F.col("o_orderstatus")].alias("order_status"),
                  approved.cast("timestamp_ntz").alias("order_approved_at"),
                  F.col("delivered").cast("timestamp_ntz").alias("order_delivered_customer_date"),
                  F.timestamp_add("DAY", est_days[F.col("o_orderpriority")], F.col("o_orderdate"))
                  .cast("timestamp_ntz").alias("order_estimated_delivery_date")))
    return with_lineage(df, "orders.parquet", ORDERS.hash_fields, _load_ts())


def order_items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    df = li.select(F.col("l_orderkey").cast("string").alias("order_id"),
                   F.col("l_linenumber").cast("int").alias("order_item_id"),
                   F.col("l_partkey").cast("string").alias("product_id"),
                   F.col("l_suppkey").cast("string").alias("seller_id"),
                   F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                   F.round(F.col("l_quantity") * F.lit(1.5), 2).cast("decimal(12,2)")
                   .alias("freight_value"),
                   F.col("l_shipdate").cast("timestamp_ntz").alias("_shipped"))
    out = with_lineage(df, "lineitem.parquet", ORDER_ITEMS.hash_fields, F.col("_shipped"))
    return out.drop("_shipped")


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    df = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(r, n.n_regionkey == r.r_regionkey, "left")
          .select(F.col("c_custkey").cast("string").alias("customer_id"),
                  F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("customer_city"),
                  F.lower(F.col("r_name")).alias("customer_state")))
    return with_lineage(df, "customer.parquet", CUSTOMERS.hash_fields, _load_ts())


def category_translation(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_TRANSLATION,
                                 "product_category_name string, product_category_name_english string")


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category_name"))
    df = read_products(p, category_translation(spark))
    return with_lineage(df, "part.parquet", PRODUCTS.hash_fields, _load_ts())


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    score = F.when(F.col("event_type") == "error", F.lit(None).cast("int")).otherwise(
        (F.lit(1) + F.col("user_id") % REVIEW_SCORES).cast("int"))
    df = e.select(F.col("event_id").cast("string").alias("review_id"),
                  (F.floor(F.col("event_id") / 2) * 3).cast("bigint").cast("string").alias("order_id"),
                  score.alias("review_score"),
                  F.col("ts").cast("timestamp_ntz").alias("review_creation_date"))
    return with_lineage(df, "events.parquet", REVIEWS.hash_fields, _load_ts())


def sellers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    df = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
          .join(r, n.n_regionkey == r.r_regionkey, "left")
          .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                  F.col("n_name").alias("seller_city"),
                  F.col("r_name").alias("seller_state")))
    return with_lineage(df, "supplier.parquet", SELLERS.hash_fields, _load_ts())


def holidays_raw(orders: DataFrame, city: str = DEFAULT_CITY, state: str = DEFAULT_STATE) -> DataFrame:
    """Holiday file rows for every year the orders span: Jan-01 national,
    May-01 for ``state``, Jul-09 for ``city``; city text left un-normalized."""
    years = (orders.agg(F.min(F.year("order_delivered_customer_date")).alias("y0"),
                        F.max(F.year("order_delivered_customer_date")).alias("y1"))
             .select(F.explode(F.sequence("y0", "y1")).alias("y")))
    rows = [("01-01", "New Year", None, None, "national"),
            ("05-01", "State Day", None, state, "state"),
            ("07-09", "City Day", f" {city.upper()} ", state, "municipal")]
    spec = F.array(*[F.struct(F.lit(md).alias("md"), F.lit(nm).alias("holiday_name"),
                              F.lit(ct).cast("string").alias("city"),
                              F.lit(st).cast("string").alias("state"),
                              F.lit(sc).alias("scope")) for md, nm, ct, st, sc in rows])
    return (years.select("y", F.explode(spec).alias("h"))
            .select(F.to_date(F.concat(F.col("y").cast("string"), F.lit("-"), F.col("h.md"))).alias("date"),
                    "h.holiday_name", "h.city", "h.state", "h.scope"))


def weather_raw(calendar: DataFrame, city: str = DEFAULT_CITY) -> DataFrame:
    """One weather record per calendar day for ``city``: temp = day of year
    mod 40, plus 40 on every 90th day (so some readings exceed the valid 55),
    rain = day of year mod 7 mm, with a negative reading every 50th day.  Every
    30th day has a second record with a higher temperature and unknown rain."""
    doy = F.dayofyear("date")
    again = calendar.where(doy % 30 == 0).select(
        F.col("date").cast("string").alias("date"), F.lit(city.upper()).alias("city"),
        (doy % 40 + 5).cast("double").alias("temp_avg"), F.lit(None).cast("double").alias("precip_mm"),
        F.lit(None).cast("string").alias("is_holiday"))
    return again.unionByName(calendar.select(
        F.col("date").cast("string").alias("date"),
        F.lit(f" {city.title()} ").alias("city"),
        (doy % 40 + F.when(doy % 90 == 0, F.lit(40)).otherwise(F.lit(0))).cast("double").alias("temp_avg"),
        F.when(doy % 50 == 0, F.lit(-1.0)).otherwise((doy % 7).cast("double")).alias("precip_mm"),
        F.when(F.month("date") == 1, F.lit("yes")).otherwise(F.lit("no")).alias("is_holiday")))


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders_raw": orders_raw(spark, sf_dir),
        "order_items_raw": order_items_raw(spark, sf_dir),
        "customers_raw": customers_raw(spark, sf_dir),
        "products_raw": products_raw(spark, sf_dir),
        "reviews_raw": reviews_raw(spark, sf_dir),
        "sellers_raw": sellers_raw(spark, sf_dir),
    }


__all__ = ["staging", "orders_raw", "order_items_raw", "customers_raw", "products_raw",
           "reviews_raw", "sellers_raw", "holidays_raw", "weather_raw", "category_translation",
           "DEFAULT_CITY", "DEFAULT_STATE"]
