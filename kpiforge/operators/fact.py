"""Order-item fact: assembly, keyed upsert with change test, optional lookups.

O-12 delivered, O-13 scope, O-15 to_day, O-20 business hash,
O-21 lead time, O-22 on-time flag, O-34 fact_rows, O-35 upsert,
O-36 enrich_fact, O-37 fact_with_dates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import accent_blind, business_md5, is_distinct, lead_time_days, on_time_flag, to_day
from ..session import stored
from ..sources.staging import dedup_latest
from .keys import running_total

FACT_KEYS = ["order_id", "order_item_id"]
FACT_CHANGE_COLS = ["_row_md5", "calendar_sk", "customer_sk", "product_sk"]
LOOKUP_COLS = ["seller_sk", "external_sk"]


class DuplicateKeyError(ValueError):
    pass


# ---------------------------------------------------------------------------
# O-12 / O-13 / O-14 filters
# ---------------------------------------------------------------------------
def delivered(df: DataFrame, status_col: str = "order_status") -> DataFrame:
    return df.filter(F.col(status_col) == F.lit("delivered"))


def scope(df: DataFrame, city: str, city_col: str = "customer_city", blind: bool = False) -> DataFrame:
    """Rows of one normalized city.  The city text is compared as given, so the
    filter reaches the scan; or, ``blind``, without regard to case, accents and blanks
    around it, for texts that aren't normalized."""
    if blind:
        return df.filter(accent_blind(city_col) == accent_blind(F.lit(city)))
    return df.filter(F.col(city_col) == F.lit(city))


# ---------------------------------------------------------------------------
# O-34 fact assembly
# ---------------------------------------------------------------------------
def latest_items(items: DataFrame) -> DataFrame:
    """Staged items can repeat a key across loads; keep the latest version (O-07).
    The file name and the fingerprint, half of a staged row's bytes, stay in
    staging: they rank last, so versions that only they tell apart are equal here."""
    return dedup_latest(items.drop("_source_file", "_row_md5"), FACT_KEYS, by=["_ingested_at", "price"])


def fact_rows(orders: DataFrame, items: DataFrame, dim_customer: DataFrame,
              dim_product: DataFrame, dim_calendar: DataFrame) -> DataFrame:
    """Rows to merge into the fact: items of delivered orders with their
    customer, product and delivery-day keys, derived metrics and content hash.

    Inner joins keep the reference's losses: items without an order, orders
    without a delivery day, products without a translated category.  The
    order-level lookups (customer, delivery day) are joined on the orders
    side, which is several times smaller than the items, so the large
    item rows are shuffled only for the order join (and for the product
    join when the product dimension is too big to broadcast).  AQE picks
    broadcast from measured sizes; the calendar arrives hinted when its
    bound is small.
    """
    o = (delivered(orders)
         .select("order_id", "customer_id", "order_approved_at",
                 "order_delivered_customer_date", "order_estimated_delivery_date")
         .join(dim_customer.select("customer_id", "customer_sk"), "customer_id", "inner")
         .withColumn("delivered_date", to_day("order_delivered_customer_date"))
         .join(dim_calendar.select(F.col("date").alias("delivered_date"), "calendar_sk"),
               "delivered_date", "inner"))
    i = (items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
         .join(dim_product.select("product_id", "product_sk"), "product_id", "inner"))
    joined = i.join(o, "order_id", "inner")
    return joined.select(
        "order_id", "order_item_id", "price", "freight_value",
        lead_time_days().alias("lead_time_days"),
        on_time_flag().alias("on_time_flag"),
        "calendar_sk", "customer_sk", "product_sk",
        F.lit(None).cast("bigint").alias("seller_sk"),
        F.lit(None).cast("bigint").alias("external_sk"),
        business_md5().alias("_row_md5"))


# ---------------------------------------------------------------------------
# O-35 keyed upsert
# ---------------------------------------------------------------------------
@dataclass
class UpsertResult:
    table: DataFrame          # the new fact version (old rows + changes + inserts)
    actions: DataFrame        # key columns + action in insert/update/unchanged


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """ON CONFLICT DO UPDATE refuses a source that repeats a key; so do we."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"source repeats key {dup[0].asDict()}")


def merge_action(change_cols: Sequence[str]) -> Column:
    """insert / update / unchanged of a source row joined to its target row
    (columns ``_t_*`` and ``_in_target``)."""
    changed = F.lit(False)
    for c in change_cols:
        changed = changed | is_distinct(f"_t_{c}", c)
    return (F.when(F.col("_in_target").isNull(), F.lit("insert"))
            .when(changed, F.lit("update")).otherwise(F.lit("unchanged")))


def merged_values(value_cols: Sequence[str], update_cols: Sequence[str]) -> list[Column]:
    """The value columns after the row's ``action``; other actions keep the target's."""
    sets = {c: ["insert", "update"] if c in update_cols else ["insert"] for c in value_cols}
    return [F.when(F.col("action").isin(*sets[c]), F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c) for c in value_cols]


def upsert(target: DataFrame | None, src: DataFrame, keys: Sequence[str] = FACT_KEYS,
           change_cols: Sequence[str] = FACT_CHANGE_COLS, id_col: str = "event_id",
           check_unique: bool = True,
           update_cols: Sequence[str] | None = None) -> UpsertResult:
    """Insert new keys, update a row only when one of ``change_cols`` is
    distinct (NULL-safe), leave the rest unchanged; ``id_col`` is kept for
    existing rows and assigned densely (max + rank by key) to new ones.  An
    update sets ``update_cols`` (default: all columns but the optional lookups
    ``LOOKUP_COLS``, which keep what an earlier step filled in).

    Rows of the target with no source row stay (the reference never
    deletes).  ``actions`` holds one row per source row.
    """
    keys = list(keys)
    value_cols = [c for c in src.columns if c not in keys]
    if target is None:
        # First load: dense ids in key order (positional running count on the
        # range-partitioned, written rows), then a keys-only uniqueness
        # test -- it shuffles the key columns, not the whole rows.
        numbered = running_total(src, order_by=keys, out="_rank")
        if check_unique:
            assert_unique(numbered.select(*keys), keys)
        table = numbered.select(F.col("_rank").cast("bigint").alias(id_col), *keys, *value_cols)
        return UpsertResult(table, table.select(*keys, F.lit("insert").alias("action")))

    # The batch is read by the uniqueness test, both key filters and the
    # merge: materialize it once (batch-sized) instead of re-deriving it.
    src = stored(src, "upsert-batch")
    if check_unique:
        assert_unique(src, keys)
    start = target.agg(F.max(id_col)).first()[0] or 0
    # Only target rows whose key is in the batch take part in the merge; the
    # rest pass through.  AQE picks the join from the batch's measured size.
    src_keys = src.select(*keys)
    untouched = target.join(src_keys, keys, "left_anti")
    touched = target.join(src_keys, keys, "left_semi")
    t = touched.select(id_col, *keys, *[F.col(c).alias(f"_t_{c}") for c in value_cols],
                       F.lit(True).alias("_in_target"))
    j = src.join(t, keys, "left")
    j = j.withColumn("action", merge_action(change_cols))
    if update_cols is None:
        update_cols = [c for c in value_cols if c not in LOOKUP_COLS]
    merged = j.select(id_col, *keys, "action", *merged_values(value_cols, update_cols))
    merged = stored(merged, "upsert-merged")  # batch-sized; the table and the actions read it
    inserts = merged.filter(F.col("action") == "insert").drop(id_col)
    numbered = running_total(inserts, order_by=keys, out="_rank")
    new_rows = numbered.select((F.col("_rank") + F.lit(start)).cast("bigint").alias(id_col),
                               *keys, *value_cols, "action")
    kept = merged.filter(F.col("action") != "insert").select(id_col, *keys, *value_cols, "action")
    batch = kept.unionByName(new_rows)
    table = untouched.select(id_col, *keys, *value_cols).unionByName(
        batch.select(id_col, *keys, *value_cols))
    return UpsertResult(table, batch.select(*keys, "action"))


def upsert_counts(actions: DataFrame) -> DataFrame:
    """inserted / updated / unchanged counts of one upsert."""
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def build_fact(orders: DataFrame, items: DataFrame, dim_customer: DataFrame,
               dim_product: DataFrame, dim_calendar: DataFrame,
               existing: DataFrame | None = None) -> UpsertResult:
    rows = fact_rows(orders, latest_items(items), dim_customer, dim_product, dim_calendar)
    return upsert(existing, rows)


# ---------------------------------------------------------------------------
# O-36 optional lookups
# ---------------------------------------------------------------------------
def enrich_fact(fact: DataFrame, items: DataFrame, dim_seller: DataFrame,
                dim_external: DataFrame, dim_customer: DataFrame,
                dim_calendar: DataFrame, check_unique: bool = True) -> DataFrame:
    """Fill ``seller_sk`` (the item's seller) and ``external_sk`` (delivery day
    x customer city) with left lookups; misses stay NULL.

    One chain of joins on the fact rows: the item lookup is the only join on
    the fact's own keys (``items`` must hold one row per key, e.g. the latest
    versions; a repeated key is an error, unless ``check_unique`` is off for items that are known
    to be deduplicated); the dimension lookups are left to AQE (broadcast by measured
    size, shuffle otherwise)."""
    cols = fact.columns
    seller_of = items.select(*FACT_KEYS, "seller_id")
    if check_unique:
        assert_unique(seller_of, FACT_KEYS)
    j = (fact.drop("seller_sk", "external_sk")
         .join(seller_of, FACT_KEYS, "left")
         .join(dim_seller.select("seller_id", "seller_sk"), "seller_id", "left")
         .join(dim_calendar.select("calendar_sk", "date"), "calendar_sk", "left")
         .join(dim_customer.select("customer_sk", F.col("customer_city").alias("city")),
               "customer_sk", "left")
         .join(dim_external.select("date", "city", "external_sk"), ["date", "city"], "left"))
    return j.select(*cols)


# ---------------------------------------------------------------------------
# O-37 fact with raw dates
# ---------------------------------------------------------------------------
def fact_with_dates(fact: DataFrame, dim_calendar: DataFrame, dim_customer: DataFrame,
                    orders: DataFrame, city: str) -> DataFrame:
    cust = scope(dim_customer, city).select("customer_sk", "customer_city")
    return (fact.join(cust, "customer_sk", "inner")
            .join(dim_calendar.select("calendar_sk", "year", "quarter"), "calendar_sk", "inner")
            .join(orders.select("order_id",
                                F.col("order_approved_at").alias("approved_at"),
                                F.col("order_delivered_customer_date").alias("delivered_at"),
                                F.col("order_estimated_delivery_date").alias("estimated_at")),
                  "order_id", "inner")
            .select("event_id", "order_id", "order_item_id", "price", "freight_value",
                    "lead_time_days", "on_time_flag", "year", "quarter", "approved_at",
                    "delivered_at", "estimated_at", "customer_city"))
