"""Fact assembly and the keyed upsert (FIXTURES 5: fact losses, upsert)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiforge.operators.dims import build_calendar, build_dim_customer, build_dim_product
from kpiforge.operators.fact import DuplicateKeyError, fact_rows, latest_items, upsert, upsert_counts

T = dt.datetime.fromisoformat


@pytest.fixture(scope="module")
def stage(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", T("2018-01-01 00:00:00"), T("2018-01-03 00:00:00"), T("2018-01-05 00:00:00")),
        ("o2", "c1", "delivered", T("2018-01-01 00:00:00"), None, T("2018-01-05 00:00:00")),
        ("o3", "c2", "canceled", T("2018-01-01 00:00:00"), T("2018-01-02 00:00:00"), None),
        ("o4", "c2", "delivered", None, T("2018-02-10 00:00:00"), T("2018-02-01 00:00:00")),
    ], "order_id string, customer_id string, order_status string, order_approved_at timestamp_ntz, "
       "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    items = spark.createDataFrame([
        ("o1", 1, "p1", 10.0, 1.0), ("o1", 2, "p2", 5.0, 1.0),   # p2: no translation -> lost
        ("o2", 1, "p1", 7.0, 1.0),                                 # no delivery date -> lost
        ("o3", 1, "p1", 3.0, 1.0),                                 # canceled -> lost
        ("o4", 1, "p1", 4.0, 0.5),
        ("o9", 1, "p1", 1.0, 0.1),                                 # no order -> lost
    ], "order_id string, order_item_id int, product_id string, price double, freight_value double")
    items = items.withColumn("price", F.col("price").cast("decimal(12,2)")).withColumn(
        "freight_value", F.col("freight_value").cast("decimal(12,2)"))
    customers = spark.createDataFrame([("c1", " Sao Paulo ", "sp"), ("c2", "RIO", "rj")],
                                      "customer_id string, customer_city string, customer_state string")
    products = spark.createDataFrame([("p1", "x", " Toys ")],
                                     "product_id string, product_category_name string, "
                                     "product_category_name_english string")
    cal = build_calendar(orders)
    cust = build_dim_customer(customers)
    prod = build_dim_product(products)
    return orders, items, cust, prod, cal


def test_fact_losses_and_metrics(stage):
    orders, items, cust, prod, cal = stage
    f = {(r["order_id"], r["order_item_id"]): r for r in fact_rows(orders, items, cust, prod, cal).collect()}
    assert set(f) == {("o1", 1), ("o4", 1)}
    assert f[("o1", 1)]["lead_time_days"] == 2.0 and f[("o1", 1)]["on_time_flag"] == 1
    assert f[("o4", 1)]["lead_time_days"] is None and f[("o4", 1)]["on_time_flag"] == 0


def test_upsert_actions(stage, spark):
    orders, items, cust, prod, cal = stage
    src = fact_rows(orders, items, cust, prod, cal)
    first = upsert(None, src)
    t1 = first.table.checkpoint()
    ids1 = {(r["order_id"], r["order_item_id"]): r["event_id"] for r in t1.collect()}
    assert sorted(ids1.values()) == [1, 2]

    again = upsert(t1, src)                                   # identical rerun
    assert dict(upsert_counts(again.actions).collect()) == {"unchanged": 2}

    changed = src.withColumn("price", F.when(F.col("order_id") == "o1", F.col("price") + 1)
                             .otherwise(F.col("price")))
    changed = changed.withColumn("_row_md5", F.when(F.col("order_id") == "o1", F.lit("new"))
                                 .otherwise(F.col("_row_md5")))
    sk_only = changed.withColumn("customer_sk", F.when(F.col("order_id") == "o4", F.lit(99))
                                 .otherwise(F.col("customer_sk")))
    extra = sk_only.filter(F.col("order_id") == "o4").withColumn("order_item_id", F.lit(2))
    res = upsert(t1, sk_only.unionByName(extra))
    assert dict(upsert_counts(res.actions).collect()) == {"update": 2, "insert": 1}
    t2 = {(r["order_id"], r["order_item_id"]): r for r in res.table.collect()}
    assert t2[("o1", 1)]["event_id"] == ids1[("o1", 1)]        # event_id kept
    assert t2[("o4", 1)]["customer_sk"] == 99
    assert t2[("o4", 2)]["event_id"] == 3                      # new key after max


def test_upsert_rejects_duplicate_source_key(stage):
    orders, items, cust, prod, cal = stage
    src = fact_rows(orders, items, cust, prod, cal)
    with pytest.raises(DuplicateKeyError):
        upsert(None, src.unionByName(src))


def test_upsert_keeps_target_rows_missing_from_source(stage):
    orders, items, cust, prod, cal = stage
    src = fact_rows(orders, items, cust, prod, cal)
    t1 = upsert(None, src).table.checkpoint()
    res = upsert(t1, src.filter(F.col("order_id") == "o1"))
    assert res.table.count() == 2
    assert dict(upsert_counts(res.actions).collect()) == {"unchanged": 1}


def test_single_day_calendar(spark):
    o = spark.createDataFrame([(T("2018-03-04 10:00:00"),), (T("2018-03-04 23:00:00"),)],
                              "order_delivered_customer_date timestamp_ntz")
    cal = build_calendar(o).collect()
    assert len(cal) == 1 and cal[0]["calendar_sk"] == 1 and cal[0]["day_of_week"] == 0
    more = spark.createDataFrame([(T("2018-03-02 10:00:00"),), (T("2018-03-05 10:00:00"),)],
                                 "order_delivered_customer_date timestamp_ntz")
    grown = build_calendar(more, existing=build_calendar(o))
    got = sorted((r["date"].day, r["calendar_sk"]) for r in grown.collect())
    assert got == [(2, 2), (3, 3), (4, 1), (5, 4)]          # old key kept, new days after max


def test_build_fact_dedups_then_merges(stage):
    from kpiforge.operators.fact import build_fact
    orders, items, cust, prod, cal = stage
    staged = items.withColumn("_ingested_at", F.lit(T("2018-01-01 00:00:00")).cast("timestamp_ntz"))
    twice = staged.unionByName(staged.withColumn(
        "_ingested_at", F.lit(T("2018-01-02 00:00:00")).cast("timestamp_ntz")).withColumn(
        "price", F.col("price") + F.lit(1)))
    res = build_fact(orders, twice, cust, prod, cal)
    got = {(r["order_id"], r["order_item_id"]): float(r["price"]) for r in res.table.collect()}
    assert got == {("o1", 1): 11.0, ("o4", 1): 5.0}            # later version wins


def test_latest_items_leave_the_lineage_in_staging(spark):
    rows = [("o1", 1, "p1", "s1", 1, "b"), ("o1", 1, "p2", "s1", 1, "a"), ("o1", 1, "p0", "s9", 0, "c"), (None, 2, "p1", None, 1, "a")]
    staged = spark.createDataFrame(rows, "order_id string, order_item_id int, product_id string, seller_id string, price int, _row_md5 string")
    staged = staged.withColumns({"freight_value": F.lit(1), "_ingested_at": F.lit(0), "_source_file": F.lit("f")})
    got = latest_items(staged.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
                                     "_ingested_at", "_source_file", "_row_md5"))
    assert "_row_md5" not in got.columns and "_source_file" not in got.columns
    assert sorted((r["order_id"] or "", r["product_id"], r["seller_id"]) for r in got.collect()) == [("", "p1", None), ("o1", "p2", "s1")]


def test_upsert_reads_only_the_columns_it_needs(spark):
    rows = spark.range(50).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit(1).alias("order_item_id"), F.lit("x").alias("v"))
    table = upsert(None, rows, change_cols=["v"]).table
    assert table.inputFiles() and "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in table.orderBy("order_id").select("event_id").collect()] == list(range(1, 51))
