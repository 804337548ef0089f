"""Registered queries: data-quality checks and the report (O-78..O-85)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.fact import FACT_KEYS, delivered
from ..session import scratch_path
from . import oracle as O
from .catalog import present, register
from .star import Star, latest_items_of

SK_COLS = ["calendar_sk", "customer_sk", "product_sk"]


@register("dq_duplicates", O.q("""
SELECT order_id, order_item_id, count(*) AS count FROM items_raw
GROUP BY order_id, order_item_id HAVING count(*) > 1
"""))
def dq_duplicates(s: Star) -> DataFrame:
    """O-78: staged item keys that occur more than once."""
    return Q.dq_duplicates(s.items, FACT_KEYS)


@register("dq_null_sk", O.q("""
SELECT count(*) FILTER (WHERE calendar_sk IS NULL) AS null_calendar_sk,
       count(*) FILTER (WHERE customer_sk IS NULL) AS null_customer_sk,
       count(*) FILTER (WHERE product_sk IS NULL) AS null_product_sk
FROM fact
"""))
def dq_null_sk(s: Star) -> DataFrame:
    """O-79: NULL surrogate keys in the fact, per key."""
    return Q.dq_null_keys(s.fact, SK_COLS)


_RANGES_SQL = """
SELECT 'negative_price' AS "check", count(*) FILTER (WHERE price < 0) AS violations,
       count(*) AS n_rows FROM fact
UNION ALL SELECT 'negative_freight', count(*) FILTER (WHERE freight_value < 0), count(*) FROM fact
UNION ALL SELECT 'negative_lead_time', count(*) FILTER (WHERE lead_time_days < 0), count(*) FROM fact
"""


@register("dq_ranges", O.q(_RANGES_SQL))
def dq_ranges(s: Star) -> DataFrame:
    """O-80: negative price / freight / lead time, one pass over the fact."""
    return Q.dq_ranges(s.fact, Q.fact_range_rules())


@register("dq_quarantine", O.q("""
SELECT order_id, 'inverted_dates' AS reason FROM orders_raw
WHERE order_delivered_customer_date < order_approved_at
"""))
def dq_quarantine(s: Star) -> DataFrame:
    """O-81: staged orders delivered before approval, written to a quarantine
    table and read back; the load would abort at more than half of the rows."""
    sink = scratch_path(s.orders.sparkSession, "quarantine")
    for _ in range(2):  # the second run replaces what the first one put there
        Q.quarantine(s.orders, Q.order_date_rules(), sink, 0.5)
    return s.orders.sparkSession.read.parquet(sink).select("order_id", "reason")


@register("load_checked", O.q("""
SELECT coalesce(reason, 'good') AS route, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers FROM (
  SELECT customer_id, CASE WHEN order_delivered_customer_date < order_approved_at THEN 'inverted_dates'
         WHEN order_status = 'delivered' AND order_estimated_delivery_date IS NULL THEN 'null_estimated_date' END AS reason
  FROM orders_raw) GROUP BY 1
"""))
def load_checked(s: Star) -> DataFrame:
    """O-81 + O-06: staged orders loaded into a table and a quarantine by one
    scan and one write, twice; the second run leaves both as they were."""
    spark = s.orders.sparkSession
    table, sink = scratch_path(spark, "checked"), scratch_path(spark, "quarantine")
    rules = {**Q.order_date_rules(), "null_estimated_date":
             (F.col("order_status") == "delivered") & F.col("order_estimated_delivery_date").isNull()}
    for _ in range(2):
        Q.load_checked(s.orders, rules, table, sink, 0.5)
    cols = ["reason", "customer_id"]
    both = spark.read.parquet(table).withColumn("reason", F.lit("good")).select(*cols).unionAll(spark.read.parquet(sink).select(*cols))
    return both.groupBy(F.col("reason").alias("route")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("customer_id").alias("n_customers"))


_ORPHANS_SQL = """
SELECT 'calendar_sk' AS sk_column, count(*) AS violations FROM fact f
  WHERE f.calendar_sk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_calendar d WHERE d.calendar_sk = f.calendar_sk)
UNION ALL SELECT 'customer_sk', count(*) FROM fact f
  WHERE f.customer_sk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_sk = f.customer_sk)
UNION ALL SELECT 'product_sk', count(*) FROM fact f
  WHERE f.product_sk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_sk = f.product_sk)
"""


@register("dq_orphans", O.q(_ORPHANS_SQL))
def dq_orphans(s: Star) -> DataFrame:
    """O-82: fact keys missing from their dimension, by bitmaps of its keys in
    one pass over the fact."""
    return Q.dq_orphans(s.fact, {"calendar_sk": s.calendar, "customer_sk": s.customer,
                                 "product_sk": s.product})


def _expected(s: Star) -> DataFrame:
    """Staged rows the fact should hold: latest items of delivered orders."""
    return latest_items_of(s).join(delivered(s.orders).select("order_id"), "order_id", "inner")


_RECON_CTE = """
, exp AS (SELECT count(*) AS e FROM items i JOIN orders_raw o USING (order_id)
          WHERE o.order_status = 'delivered'),
ld AS (SELECT count(*) AS l FROM fact)
"""


@register("dq_reconcile", O.q(_RECON_CTE + f"""
SELECT e AS expected_rows, l AS loaded_rows,
       {O.r6('abs(e - l) / NULLIF(CAST(e AS DOUBLE), 0)', 'gap_share')},
       coalesce(abs(e - l) / NULLIF(CAST(e AS DOUBLE), 0), 0.0) <= 0.01 AS within_tolerance
FROM exp, ld
"""))
def dq_reconcile(s: Star) -> DataFrame:
    """O-83: staged vs loaded fact rows within a 1 % tolerance."""
    return present(Q.dq_reconcile(_expected(s), s.fact), rates=["gap_share"])


@register("dq_city_coverage", O.q(f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE customer_city = trim(lower(customer_city))) AS normalized_rows,
       {O.r6('avg(CASE WHEN customer_city = trim(lower(customer_city)) THEN 1.0 ELSE 0.0 END)', 'coverage')}
FROM customers_raw
"""))
def dq_city_coverage(s: Star) -> DataFrame:
    """O-84: share of staged customer cities already in normalized form."""
    return present(Q.dq_city_coverage(s.customers), rates=["coverage"])


# A fact with planted faults: line 6 again without product, line 7 again with an
# unknown customer and a negative price
_BROKEN_CTE = """
, broken AS (
  SELECT order_id, order_item_id, price, freight_value, lead_time_days, calendar_sk, customer_sk, product_sk FROM fact
  UNION ALL SELECT order_id, order_item_id, price, freight_value, lead_time_days, calendar_sk, customer_sk, NULL
    FROM fact WHERE order_item_id = 6
  UNION ALL SELECT order_id, order_item_id, -price, freight_value, lead_time_days, calendar_sk, -customer_sk, product_sk
    FROM fact WHERE order_item_id = 7),
per_item AS (SELECT order_id, order_item_id, count(*) AS n FROM broken GROUP BY ALL),
dim_keys AS (SELECT count(*) AS n FROM dim_customer GROUP BY customer_id
             UNION ALL SELECT count(*) FROM dim_product GROUP BY product_id
             UNION ALL SELECT count(*) FROM dim_calendar GROUP BY date)
"""


def broken_fact(s: Star) -> DataFrame:
    """The fact with planted faults, from one scan: lines 6 and 7 come a second time."""
    cols = ["order_id", "order_item_id", "price", "freight_value", "lead_time_days", *SK_COLS]
    line = F.col("order_item_id")
    f = s.fact.select(*cols, F.explode(F.when(line.isin(6, 7), F.array(F.lit(0), line)).otherwise(F.array(F.lit(0)))).alias("_fault"))
    return f.withColumns({
        "product_sk": F.when(F.col("_fault") != 6, F.col("product_sk")),
        "customer_sk": F.when(F.col("_fault") == 7, -F.col("customer_sk")).otherwise(F.col("customer_sk")),
        "price": F.when(F.col("_fault") == 7, -F.col("price")).otherwise(F.col("price")).cast(s.fact.schema["price"].dataType),
    }).select(*cols)


_RULES_VALUES = ", ".join(f"('{c}', {t}, '{a}', '{w}')" for c, t, a, w in Q.RULES)


@register("dq_report", O.q(_RECON_CTE + _BROKEN_CTE.replace("\n,", ",", 1) + f"""
, checks AS (
  SELECT 'duplicate_fact_key' AS "check", sum(n - 1) AS violations, sum(n) AS n_rows FROM per_item
  UNION ALL SELECT 'duplicate_dim_key', sum(n - 1), sum(n) FROM dim_keys
  UNION ALL SELECT 'null_surrogate_key',
    count(*) FILTER (WHERE calendar_sk IS NULL OR customer_sk IS NULL OR product_sk IS NULL), count(*) FROM broken
  UNION ALL SELECT 'orphan_surrogate_key',
    count(*) FILTER (WHERE calendar_sk NOT IN (SELECT calendar_sk FROM dim_calendar))
    + count(*) FILTER (WHERE customer_sk NOT IN (SELECT customer_sk FROM dim_customer))
    + count(*) FILTER (WHERE product_sk NOT IN (SELECT product_sk FROM dim_product)), count(*) FROM broken
  UNION ALL {_RANGES_SQL.strip().replace("FROM fact", "FROM broken")}
  UNION ALL SELECT 'inverted_dates',
    count(*) FILTER (WHERE order_delivered_customer_date < order_approved_at), count(*) FROM orders_raw
  UNION ALL SELECT 'null_estimated_date',
    count(*) FILTER (WHERE order_estimated_delivery_date IS NULL), count(*) FROM orders_raw
    WHERE order_status = 'delivered'
  UNION ALL SELECT 'city_not_normalized',
    count(*) FILTER (WHERE NOT (customer_city = trim(lower(customer_city)))), count(*) FROM customers_raw
  UNION ALL SELECT 'row_count_gap', abs(e - (SELECT count(*) FROM broken)), e FROM exp),
rules AS (SELECT * FROM (VALUES {_RULES_VALUES}) r("check", threshold, action_over, action_within))
SELECT c."check", CAST(c.violations AS BIGINT) AS violations, CAST(c.n_rows AS BIGINT) AS n_rows,
       {O.r6('coalesce(CAST(c.violations AS DOUBLE) / NULLIF(CAST(c.n_rows AS DOUBLE), 0), 0.0)', 'share')},
       CAST(r.threshold AS DOUBLE) AS threshold,
       CASE WHEN c.violations = 0 THEN 'OK'
            WHEN coalesce(CAST(c.violations AS DOUBLE) / NULLIF(CAST(c.n_rows AS DOUBLE), 0), 0.0) > r.threshold
            THEN r.action_over ELSE r.action_within END AS action
FROM checks c LEFT JOIN rules r USING ("check")
"""))
def dq_report(s: Star) -> DataFrame:
    """O-85 + O-78: every check, with its share, threshold and
    ABORT/QUARANTINE/WARN action, on a fact with planted faults: fact and
    dimension duplicates, NULL and orphan keys of all three dimensions, ranges,
    dates, city texts and the row count."""
    spark, path = s.fact.sparkSession, scratch_path(s.fact.sparkSession, "checked-fact")
    broken_fact(s).write.parquet(path)  # the fact is read once
    f = spark.read.parquet(path)
    dims = {"calendar_sk": s.calendar, "customer_sk": s.customer, "product_sk": s.product}
    null_sk = F.col("calendar_sk").isNull() | F.col("customer_sk").isNull() | F.col("product_sk").isNull()
    # one pass for all row-wise rules, orphan keys of the three dimensions among them; one aggregate by key
    facts = Q.dq_ranges(Q.with_orphans(f.drop("order_id", "order_item_id"), dims), {
        "null_surrogate_key": null_sk, **Q.fact_range_rules(), **{f"orphan_{sk}": F.col(f"orphan_{sk}") for sk in dims}})
    is_orphan = F.col("check").startswith("orphan_")
    facts = (facts.withColumn("check", F.when(is_orphan, F.lit("orphan_surrogate_key")).otherwise(F.col("check")))
             .groupBy("check").agg(F.sum("violations").alias("violations"), F.max("n_rows").alias("n_rows")))
    dim_keys = [Q.dq_duplicate_check(d, [k], "duplicate_dim_key") for d, k in (
        (s.customer, "customer_id"), (s.product, "product_id"), (s.calendar, "date"))]
    dim_dups = (dim_keys[0].unionByName(dim_keys[1]).unionByName(dim_keys[2]).groupBy("check")
                .agg(F.sum("violations").alias("violations"), F.sum("n_rows").alias("n_rows")))
    done = F.col("order_status") == "delivered"
    checks = [
        Q.dq_duplicate_check(f, FACT_KEYS, "duplicate_fact_key"), dim_dups, facts,
        Q.dq_ranges(s.orders, {**Q.order_date_rules(), "null_estimated_date": F.col("order_estimated_delivery_date").isNull()},
                    among={"null_estimated_date": F.coalesce(done, F.lit(False))}),
        Q.dq_ranges(s.customers, {"city_not_normalized":
                                  ~(F.col("customer_city") == F.trim(F.lower("customer_city")))}),
        Q.dq_reconcile(_expected(s), f).select(
            F.lit("row_count_gap").alias("check"),
            F.abs(F.col("expected_rows") - F.col("loaded_rows")).alias("violations"),
            F.col("expected_rows").alias("n_rows")),
    ]
    return present(Q.dq_report(checks, Q.rules_frame(s.fact.sparkSession)), rates=["share"])
