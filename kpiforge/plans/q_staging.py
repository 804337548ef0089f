"""Registered queries: sources, staging, keys and merge (O-01..O-11, O-16..O-20,
O-27..O-35)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims, kpis
from ..operators.fact import fact_rows, latest_items, upsert, upsert_counts
from ..operators.merge import BucketedFact
from ..operators.refresh import KpiTables
from ..session import scratch_path
from ..sources import staging as S
from ..sources import testdata
from ..sources.contracts import ORDERS
from . import oracle as O
from .catalog import CITY, present, register, register_raw
from .star import Star, dim_seller_of, latest_items_of, star_for

TS_FMT = "'%Y-%m-%dT%H:%M:%S'"


def _iso(c: str) -> str:
    return (f"coalesce(CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, {TS_FMT}) "
            f"ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END, '')")


def _txt(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'nan')"


_ORDERS_MD5 = ("md5(concat_ws('|', " + ", ".join(
    [_txt("order_id"), _txt("customer_id"), _txt("order_status"), _iso("order_approved_at"),
     _iso("order_delivered_customer_date"), _iso("order_estimated_delivery_date")]) + "))")
_REVIEWS_MD5 = ("md5(concat_ws('|', " + ", ".join(
    [_txt("review_id"), _txt("order_id"), _iso("review_creation_date")]) + "))")
_ITEMS_MD5 = ("md5(concat_ws('|', " + ", ".join(
    [_txt("order_id"), _txt("order_item_id"), _txt("product_id"), _txt("seller_id")]) + "))")
_LOAD_TS = f"TIMESTAMP '{testdata.LOAD_TS}'"


@register("staging_orders", O.q(f"""
SELECT *, {_LOAD_TS} AS _ingested_at, 'orders.parquet' AS _source_file, {_ORDERS_MD5} AS _row_md5
FROM orders_raw
"""))
def staging_orders(s: Star) -> DataFrame:
    """O-05 + O-19: staged orders with lineage stamps and row fingerprint."""
    return s.orders


@register("staging_reviews", O.q(f"""
SELECT review_id, order_id, CAST(review_score AS DOUBLE) AS review_score, review_creation_date,
       {_LOAD_TS} AS _ingested_at, 'events.parquet' AS _source_file, {_REVIEWS_MD5} AS _row_md5
FROM reviews_raw
"""))
def staging_reviews(s: Star) -> DataFrame:
    """O-05 + O-19: staged reviews (sub-second ISO text in the fingerprint)."""
    return present(s.reviews, nullable_ints=["review_score"])


@register("products_enriched", O.q("SELECT * FROM products_raw"))
def products_enriched(s: Star) -> DataFrame:
    """O-02: products inner-joined to the category translation."""
    return s.products.select("product_id", "product_category_name", "product_category_name_english")


@register("dedup_items", O.q("""
SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value, _ingested_at FROM items
"""))
def dedup_items(s: Star) -> DataFrame:
    """O-07: latest staged version of each item key."""
    d = latest_items(s.items).select("order_id", "order_item_id", "product_id", "seller_id",
                                     "price", "freight_value", "_ingested_at")
    return present(d, money=["price", "freight_value"])


@register("load_manifest", O.q(f"""
SELECT 'lineitem.parquet' AS source_file, count(*) AS n_rows,
       bit_xor(CAST(('0x' || substr({_ITEMS_MD5}, 1, 15)) AS BIGINT)) AS checksum,
       CAST(sum(CAST(('0x' || substr({_ITEMS_MD5}, 1, 15)) AS HUGEINT)) % 1152921504606846976 AS BIGINT) AS hash_sum
FROM items_raw
"""))
def load_manifest(s: Star) -> DataFrame:
    """O-08: rows and order-free checksums per loaded file."""
    return S.manifest(s.items)


@register("row_counts", O.q("""
SELECT 'orders_raw' AS table_name, count(*) AS n_rows FROM orders_raw
UNION ALL SELECT 'order_items_raw', count(*) FROM items_raw
UNION ALL SELECT 'customers_raw', count(*) FROM customers_raw
UNION ALL SELECT 'products_raw', count(*) FROM products_raw
UNION ALL SELECT 'reviews_raw', count(*) FROM reviews_raw
UNION ALL SELECT 'dim_calendar', count(*) FROM dim_calendar
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_product', count(*) FROM dim_product
UNION ALL SELECT 'fact_events', count(*) FROM fact
"""))
def row_counts(s: Star) -> DataFrame:
    """O-09 + O-72: post-load row counts of staging and core tables (UNION ALL)."""
    return S.row_counts({"orders_raw": s.orders, "order_items_raw": s.items,
                         "customers_raw": s.customers, "products_raw": s.products,
                         "reviews_raw": s.reviews, "dim_calendar": s.calendar,
                         "dim_customer": s.customer, "dim_product": s.product,
                         "fact_events": s.fact})


@register("row_counts_footers", O.q("""
SELECT 'order_items_raw' AS table_name, count(*) AS n_rows FROM items_raw
UNION ALL SELECT 'fact_events', count(*) FROM fact
"""))
def row_counts_footers(s: Star) -> DataFrame:
    """O-09: row counts of the two largest tables from their files' footers,
    after being saved (O-11); no column chunk is read."""
    spark, base = s.fact.sparkSession, scratch_path(s.fact.sparkSession, "counted")
    return S.footer_counts(spark, {name: S.save(df, base, "core", name, 1, view=False)
                                   for name, df in (("order_items_raw", s.items), ("fact_events", s.fact))})


_TS_COLS = ["order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"]


# every seventh customer's orders hold a text that is no date
_BAD = "CAST(customer_id AS BIGINT) % 7 = 0"


def _with_bad_dates(orders: DataFrame) -> DataFrame:
    bad = F.expr(_BAD)
    return orders.withColumns({
        "order_approved_at": F.when(bad, F.lit("soon")).otherwise(F.col("order_approved_at").cast("string")),
        "order_delivered_customer_date": F.when(bad, F.lit("2018-02-30 10:00:00")).otherwise(
            F.concat(F.lit(" "), F.col("order_delivered_customer_date").cast("string"), F.lit(" "))),
        "order_estimated_delivery_date": F.when(bad, F.lit("NaN")).otherwise(
            F.col("order_estimated_delivery_date").cast("string"))})


_GOOD_DATES = ", ".join(f"CASE WHEN {_BAD} THEN NULL ELSE {c} END AS {c}" for c in _TS_COLS)


@register("coerce_dates", O.q(f"SELECT order_id, {_GOOD_DATES} FROM orders_raw"))
def coerce_dates(s: Star) -> DataFrame:
    """O-16: timestamps held as text, some of them bad or padded, parsed in one
    projection (bad text -> NULL)."""
    as_text = _with_bad_dates(s.orders.select("order_id", "customer_id", *_TS_COLS)).drop("customer_id")
    return S.coerce_dates(as_text, _TS_COLS)


def _write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("errorifexists").option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("escape", '"').csv(path))


@register_raw("scan_contract", O.q(f"""
SELECT order_id, customer_id, CASE WHEN {_BAD} THEN NULL ELSE order_status END AS order_status, {_GOOD_DATES} FROM orders_raw
"""))
def scan_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-01: staged orders written as CSV, with an extra column of quoted text,
    NA tokens and bad dates, and read back through the orders contract."""
    s = star_for(spark, sf_dir)
    path = scratch_path(spark, "orders-csv")
    rows = _with_bad_dates(s.orders).withColumn(
        "order_status", F.when(F.expr(_BAD), F.lit("N/A")).otherwise(F.col("order_status")))
    _write_csv(rows.withColumn("note", F.lit('said "now", twice')), path)
    return S.read_source(spark, path, ORDERS)


# planted faults in the lines of the orders: a text that is no date, a field too many, two too few
_FAULT = """CASE WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN 'bad order_approved_at'
     WHEN CAST(customer_id AS BIGINT) % 11 = 0 OR CAST(customer_id AS BIGINT) % 13 = 0 THEN 'field count' END"""


def _order_lines(orders: DataFrame) -> DataFrame:
    """The orders as CSV lines, dealt to folders by ``f``, each file with a header line."""
    fault = F.expr(_FAULT)
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ORDERS.names}
    cells["order_approved_at"] = F.when(fault.startswith("bad"), F.lit("soon")).otherwise(cells["order_approved_at"])
    whole = F.concat_ws(",", *cells.values())
    line = (F.when(~(fault == "field count"), whole).when(F.expr("CAST(customer_id AS BIGINT) % 11 = 0"), F.concat(whole, F.lit(",more")))
            .when(fault == "field count", F.concat_ws(",", *list(cells.values())[:-2])).otherwise(whole))
    rows = orders.select(F.expr("CAST(CAST(customer_id AS BIGINT) % 4 AS INT)").alias("f"), F.lit(1).alias("at"), line.alias("line"))
    heads = orders.sparkSession.range(4).select(F.col("id").cast("int").alias("f"), F.lit(0), F.lit(",".join(ORDERS.names)))
    return rows.unionAll(heads).repartitionByRange(4, "f").sortWithinPartitions("f", "at").select("f", "line")


@register_raw("scan_rejects", O.q(f"""
SELECT coalesce({_FAULT}, 'kept') AS outcome, count(*) AS n_rows,
       count(DISTINCT order_id) FILTER (WHERE {_FAULT} IS NULL) AS n_orders
FROM orders_raw GROUP BY 1
"""))
def scan_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-01: lines with planted faults, read through the orders contract; each is
    kept or in the reject table with its reason."""
    s = star_for(spark, sf_dir)
    path = scratch_path(spark, "orders-lines")
    _order_lines(s.orders).write.partitionBy("f").text(path)
    got = S.read_checked(spark, f"{path}/*", ORDERS)
    rejects = scratch_path(spark, "rejects")
    got.rejected.write.partitionBy("_source_file").parquet(rejects)
    rejected = spark.read.parquet(rejects).select("reason", F.lit(None).cast("string").alias("order_id"))
    both = got.kept.select(F.lit("kept").alias("reason"), "order_id").unionAll(rejected)
    return both.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("order_id").alias("n_orders"))


@register_raw("reload_idempotent", O.q("""
SELECT 'orders_a.csv' AS source_file, count(*) AS n_rows FROM orders_raw
UNION ALL SELECT 'orders_b.csv', count(*) FROM orders_raw
"""))
def reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-06: load file A, load file A again (replaces, no duplicates), load
    files B and C (added), load C again without rows (its rows go); rows per
    source file afterwards."""
    s = star_for(spark, sf_dir)
    table = scratch_path(spark, "orders-staging")
    base = s.orders.drop("_source_file")
    a = base.withColumn("_source_file", F.lit("orders_a.csv"))
    b = base.withColumn("_source_file", F.lit("orders_b.csv"))
    S.replace_by_source(a, table, ["orders_a.csv"])
    S.replace_by_source(a, table, ["orders_a.csv"])
    c = base.withColumn("_source_file", F.lit("orders_c.csv"))
    S.replace_by_source(b.unionByName(c), table, ["orders_b.csv", "orders_c.csv"])
    S.replace_by_source(c.limit(0), table, ["orders_c.csv"])
    staged = spark.read.parquet(table)
    return (staged.groupBy(F.col("_source_file").alias("source_file"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------------------
# dimensions and keys
# ---------------------------------------------------------------------------
@register("dim_calendar", O.q("""
SELECT calendar_sk, CAST(date AS TIMESTAMP) AS date, day_of_week, week, month, quarter, year
FROM dim_calendar
"""))
def dim_calendar(s: Star) -> DataFrame:
    """O-27 + O-17: one row per day of the delivery range with its parts."""
    return present(s.calendar, dates=["date"])


@register("dim_customer", O.q("SELECT * FROM dim_customer"))
def dim_customer(s: Star) -> DataFrame:
    """O-28 + O-18 + O-30: normalized customers with dense keys."""
    return s.customer


@register("dim_product", O.q("SELECT * FROM dim_product"))
def dim_product(s: Star) -> DataFrame:
    """O-29 + O-30: products with the normalized English category."""
    return s.product


@register("dim_seller", O.q("""
SELECT CAST(row_number() OVER (ORDER BY seller_id) AS BIGINT) AS seller_sk, seller_id,
       seller_city, seller_state
FROM (SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, trim(lower(n_name)) AS seller_city,
             trim(upper(r_name)) AS seller_state
      FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                    LEFT JOIN region ON n_regionkey = r_regionkey)
"""))
def dim_seller(s: Star) -> DataFrame:
    """O-32: seller dimension with normalized city/state."""
    return dim_seller_of(s)


@register("insert_absent", O.q("""
, had AS (SELECT * FROM dim_customer WHERE customer_id IN (SELECT customer_id FROM orders_raw)),
old AS (SELECT CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_sk,
               customer_id, customer_city, customer_state FROM had),
new AS (SELECT (SELECT coalesce(max(customer_sk), 0) FROM old)
                 + CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS customer_sk,
               customer_id, customer_city, customer_state
        FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM had))
SELECT * FROM old UNION ALL SELECT * FROM new
""".replace("\n, had AS", ", had AS", 1)))
def insert_absent(s: Star) -> DataFrame:
    """O-31 + O-30: customers that placed orders are loaded first; a second
    load of all customers inserts only the absent ones, keys after max(sk)."""
    buyers = s.customers.join(s.orders.select("customer_id").distinct(), "customer_id", "left_semi")
    first = dims.build_dim_customer(buyers)
    return dims.build_dim_customer(s.customers, existing=first)


@register("fact_rows", O.q("""
SELECT event_id, order_id, order_item_id, CAST(price AS DOUBLE) AS price,
       CAST(freight_value AS DOUBLE) AS freight_value,
       CAST(round(CAST(lead_time_days AS DECIMAL(38,10)), 6) AS DOUBLE) AS lead_time_days,
       CAST(on_time_flag AS DOUBLE) AS on_time_flag, calendar_sk, customer_sk,
       product_sk, CAST(NULL AS DOUBLE) AS seller_sk, CAST(NULL AS DOUBLE) AS external_sk, _row_md5
FROM fact
"""))
def fact_rows_q(s: Star) -> DataFrame:
    """O-34 + O-20..O-22: the fact with event ids, derived metrics and content hash."""
    return present(s.fact, money=["price", "freight_value"], rates=["lead_time_days"],
                   nullable_ints=["on_time_flag", "seller_sk", "external_sk"])


CUTOFF_DAYS = 365


_UPSERT_SQL = O.q(f"""
, cut AS (SELECT max(_ingested_at) - INTERVAL {CUTOFF_DAYS} DAY AS c FROM items_raw),
items_cut AS (
  SELECT * FROM items_raw WHERE _ingested_at <= (SELECT c FROM cut)
  QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
                             ORDER BY _ingested_at DESC, price DESC, product_id DESC,
                                      seller_id DESC, freight_value DESC) = 1),
{O.sold_items('items_cut', 'f_old')},
acts AS (
  SELECT CASE WHEN o.order_id IS NULL THEN 'insert'
              WHEN o._row_md5 IS DISTINCT FROM n._row_md5 OR o.calendar_sk IS DISTINCT FROM n.calendar_sk
                OR o.customer_sk IS DISTINCT FROM n.customer_sk OR o.product_sk IS DISTINCT FROM n.product_sk
              THEN 'update' ELSE 'unchanged' END AS action
  FROM sold n LEFT JOIN f_old o USING (order_id, order_item_id))
SELECT action, count(*) AS n_rows FROM acts GROUP BY action
""".replace("\n, cut AS", ", cut AS", 1))

_UPSERT_TABLE_SQL = _UPSERT_SQL[:_UPSERT_SQL.index("acts AS (")] + """
first_load AS (
  SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS event_id, o.* REPLACE (
           CASE WHEN order_item_id = 7 THEN NULL ELSE customer_sk END AS customer_sk),
         CAST(product_sk AS DOUBLE) AS seller_sk FROM f_old o),
merged AS (
  SELECT o.event_id, order_id, order_item_id, n.price, n.lead_time_days, n.calendar_sk, n.customer_sk, n.product_sk,
         o.seller_sk, n._row_md5
  FROM sold n LEFT JOIN first_load o USING (order_id, order_item_id)
  UNION ALL SELECT event_id, order_id, order_item_id, price, lead_time_days, calendar_sk, customer_sk, product_sk, seller_sk, _row_md5
  FROM first_load ANTI JOIN sold USING (order_id, order_item_id))
SELECT coalesce(event_id, (SELECT max(event_id) FROM first_load)
                + row_number() OVER (PARTITION BY event_id IS NULL ORDER BY order_id, order_item_id)) AS event_id,
       order_id, order_item_id, CAST(price AS DOUBLE) AS price,
       CAST(round(CAST(lead_time_days AS DECIMAL(38,10)), 6) AS DOUBLE) AS lead_time_days,
       CAST(calendar_sk AS DOUBLE) AS calendar_sk, CAST(customer_sk AS DOUBLE) AS customer_sk,
       CAST(product_sk AS DOUBLE) AS product_sk, seller_sk, _row_md5
FROM merged
"""


@register("fact_upsert", _UPSERT_SQL)
def fact_upsert(s: Star) -> DataFrame:
    """O-35: the fact as of a cutoff (items staged up to a year before the
    last one), then the full staging merged into it: insert / update /
    unchanged counts."""
    old, new_rows = _two_loads(s)
    return upsert_counts(upsert(old, new_rows).actions)


def _two_loads(s: Star) -> tuple[DataFrame, DataFrame]:
    """The fact as of the cutoff (the upsert wrote its numbered rows), and the rows of the full load."""
    last = s.items.agg(F.max("_ingested_at").cast("string")).first()[0]
    cutoff = F.lit(last).cast("timestamp_ntz") - F.expr(f"INTERVAL {CUTOFF_DAYS} DAYS")
    early = s.items.filter(F.col("_ingested_at") <= cutoff)
    old = upsert(None, fact_rows(s.orders, latest_items(early), s.customer, s.product, s.cal)).table
    # the full load's latest item versions are the star's latest-items table
    return old, fact_rows(s.orders, latest_items_of(s), s.customer, s.product, s.cal)


@register("fact_upsert_table", _UPSERT_TABLE_SQL)
def fact_upsert_table(s: Star) -> DataFrame:
    """O-35: every row of the merged fact.  In the first load the customer key of
    every seventh line is NULL (the merge fills it in) and the seller key is
    filled (the merge keeps it); inserts get the next event ids."""
    old, new_rows = _two_loads(s)
    old = old.withColumn("customer_sk", F.when(F.col("order_item_id") != 7, F.col("customer_sk"))).withColumn(
        "seller_sk", F.col("product_sk"))
    d = upsert(old, new_rows).table.select("event_id", "order_id", "order_item_id", "price", "lead_time_days", "calendar_sk",
                                           "customer_sk", "product_sk", "seller_sk", "_row_md5")
    return present(d, money=["price"], rates=["lead_time_days"],
                   nullable_ints=["calendar_sk", "customer_sk", "product_sk", "seller_sk"])


def _first_load(s: Star) -> tuple[DataFrame, DataFrame]:
    """The two loads with the planted NULL customers and filled sellers of the first."""
    old, new_rows = _two_loads(s)
    old = old.withColumn("customer_sk", F.when(F.col("order_item_id") != 7, F.col("customer_sk"))).withColumn(
        "seller_sk", F.col("product_sk"))
    return old, new_rows


def _bucketed(s: Star, rows: DataFrame) -> BucketedFact:
    spark = s.fact.sparkSession
    path = scratch_path(spark, "warehouse/fact_bucketed")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketedFact(spark, "kf_fact_" + path.rsplit("-", 1)[1], path, n).create(rows)


@register("fact_merge_bucketed", _UPSERT_TABLE_SQL)
def fact_merge_bucketed(s: Star) -> DataFrame:
    """O-35 in place: the same two loads merged into a bucketed table; the
    table's rows are never shuffled, untouched buckets never read."""
    old, new_rows = _first_load(s)
    fact = _bucketed(s, old)
    fact.merge(new_rows)
    d = fact.read().select("event_id", "order_id", "order_item_id", "price", "lead_time_days", "calendar_sk",
                           "customer_sk", "product_sk", "seller_sk", "_row_md5")
    return present(d, money=["price"], rates=["lead_time_days"],
                   nullable_ints=["calendar_sk", "customer_sk", "product_sk", "seller_sk"])


_REFRESH_SQL = _UPSERT_TABLE_SQL[:_UPSERT_TABLE_SQL.index("merged AS (")] + f"""
merged AS (SELECT price, lead_time_days, on_time_flag, calendar_sk, customer_sk FROM sold
  UNION ALL SELECT price, lead_time_days, on_time_flag, calendar_sk, customer_sk FROM first_load ANTI JOIN sold USING (order_id, order_item_id))
SELECT {O.yq()}, {O.money('sum(price)', 'revenue_sp')}, {O.r6('quantile_cont(lead_time_days, 0.9)', 'lead_time_p90')},
       {O.r6('avg(CAST(on_time_flag AS DOUBLE))', 'on_time_rate')}
FROM merged JOIN dim_calendar USING (calendar_sk) JOIN dim_customer USING (customer_sk) WHERE customer_city = '{CITY}'
GROUP BY year, quarter
"""


@register("kpi_refresh", _REFRESH_SQL)
def kpi_refresh(s: Star) -> DataFrame:
    """O-46 + O-11: the quarterly KPI tables of a first load, refreshed by the
    changes of a second one; equal to the KPIs computed from the whole merged fact."""
    old, new_rows = _first_load(s)
    fact = _bucketed(s, old)
    tables = KpiTables(s.fact.sparkSession, scratch_path(s.fact.sparkSession, "kpi-tables"), s.cal, s.customer, CITY).build(fact.read())
    tables.refresh(fact.merge(new_rows))
    return present(tables.kpis(), ints=["year", "quarter"], money=["revenue_sp"], rates=["lead_time_p90", "on_time_rate"])


@register("saved_versions", O.q("""
SELECT v AS version, year, quarter, CAST(sum(price * v) AS DOUBLE) AS revenue
FROM fact JOIN dim_calendar USING (calendar_sk), (VALUES (1), (2)) t(v) GROUP BY v, year, quarter
"""))
def saved_versions(s: Star) -> DataFrame:
    """O-11: the quarterly revenue saved as version 1, a second version with
    doubled values saved next to it, and both read back."""
    base = scratch_path(s.fact.sparkSession, "saved")
    rev = kpis.revenue_by_quarter(s.fact, s.cal)
    paths = [S.save(rev.withColumn("revenue", (F.col("revenue") * v).cast("decimal(30,2)")), base, "analytics", "revenue", v)
             for v in (1, 2)]
    read = [s.fact.sparkSession.read.parquet(p).select(F.lit(v).alias("version"), "year", "quarter", "revenue")
            for v, p in enumerate(paths, 1)]
    return present(read[0].unionByName(read[1]), money=["revenue"])
