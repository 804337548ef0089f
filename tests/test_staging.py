"""Contracted CSV scan, dedup, idempotent per-file loads, manifest, counts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kpiforge.sources import staging as S
from kpiforge.sources.contracts import ORDERS, REVIEWS, Contract


def _csv(text):
    d = tempfile.mkdtemp(prefix="kpiforge-test-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_source_contract(spark):
    p = _csv("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
             "order_delivered_customer_date,order_estimated_delivery_date,extra\n"
             "o1,c1,delivered,2017-01-01 00:00:00,2017-01-02 10:00:00,2017-01-05 10:00:00,NA,x\n"
             "o2,c2,canceled,,not a date,,2017-02-01 00:00:00,y\n")
    df = S.read_source(spark, p, ORDERS)
    assert df.columns == ORDERS.names
    r = {x["order_id"]: x for x in df.collect()}
    assert r["o1"]["order_estimated_delivery_date"] is None          # NA token
    assert r["o2"]["order_approved_at"] is None                      # bad text
    assert str(r["o1"]["order_approved_at"]) == "2017-01-02 10:00:00"
    assert dict(df.dtypes)["order_approved_at"] == "timestamp_ntz"


def test_read_reviews_with_quotes_and_line_breaks(spark):
    p = _csv("review_id,order_id,review_score,review_comment_message,review_creation_date\n"
             'r1,o1,5,"two\nlines, ""good"" ones",2018-01-01 00:00:00\n'
             "r2,o2,3.0,x,2018-01-02 00:00:00\nr3,o3,3.7,,\nr4,o4,9007199254740993,,\n")
    got = {r["review_id"]: r for r in S.read_source(spark, p, REVIEWS).collect()}
    assert set(got) == {"r1", "r2", "r3", "r4"}
    assert [got[k]["review_score"] for k in ("r1", "r2", "r3", "r4")] == [5, 3, None, None]


def test_read_source_missing_column(spark):
    p = _csv("order_id,customer_id\n1,2\n")
    with pytest.raises(S.ContractError):
        S.read_source(spark, p, ORDERS)


def test_read_products_rejects_blank_keys(spark):
    products = spark.createDataFrame([("p1", "a"), ("p2", None), ("p3", "zz")],
                                     "product_id string, product_category_name string")
    tr = spark.createDataFrame([("a", "A"), (None, "blank")],
                               "product_category_name string, product_category_name_english string")
    got = S.read_products(products, tr).collect()
    assert [(r["product_id"], r["product_category_name_english"]) for r in got] == [("p1", "A")]


def test_dedup_latest_hot_key(spark):
    rows = [("k", i, float(i)) for i in range(300)] + [("j", 1, 5.0), ("j", 2, 1.0)]
    df = spark.createDataFrame(rows, "key string, ts int, v double")
    got = {r["key"]: (r["ts"], r["v"]) for r in S.dedup_latest(df, ["key"], ["ts"]).collect()}
    assert got == {"k": (299, 299.0), "j": (2, 1.0)}
    first = {r["key"]: r["ts"] for r in S.dedup_latest(df, ["key"], ["ts"], latest=False).collect()}
    assert first == {"k": 0, "j": 1}


def test_replace_by_source_idempotent(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="kpiforge-test-stg-"), "orders")
    a = spark.createDataFrame([(i, "a.csv") for i in range(5)], "id int, _source_file string")
    b = spark.createDataFrame([(i, "b.csv") for i in range(3)], "id int, _source_file string")
    S.replace_by_source(a, table, ["a.csv"])
    S.replace_by_source(a, table, ["a.csv"])
    assert spark.read.parquet(table).count() == 5            # same file twice: same rows
    S.replace_by_source(b, table, ["b.csv"])
    counts = dict(spark.read.parquet(table).groupBy("_source_file").count().collect())
    assert counts == {"a.csv": 5, "b.csv": 3}                 # second file added
    with pytest.raises(ValueError):
        S.replace_by_source(a.unionByName(b), table, ["a.csv"])  # a file that isn't listed
    assert dict(spark.read.parquet(table).groupBy("_source_file").count().collect()) == counts
    empty = a.limit(0)
    S.replace_by_source(empty, table, ["a.csv"])              # empty file empties its slice
    counts = dict(spark.read.parquet(table).groupBy("_source_file").count().collect())
    assert counts == {"b.csv": 3}


def test_manifest_order_free(spark):
    df = spark.createDataFrame([("f", "0123456789abcdef0123"), ("f", "fedcba9876543210aaaa")],
                               "_source_file string, _row_md5 string")
    r = S.manifest(df).first()
    want = int("0123456789abcde", 16) ^ int("fedcba987654321", 16)
    assert (r["n_rows"], r["checksum"]) == (2, want)
    r2 = S.manifest(df.orderBy(F.col("_row_md5").desc())).first()
    assert r2["checksum"] == want


def test_row_counts(spark):
    a = spark.range(3)
    b = spark.range(5)
    got = dict(S.row_counts({"a": a, "b": b}).collect())
    assert got == {"a": 3, "b": 5}


def test_coerce_dates(spark):
    df = spark.createDataFrame([("2018-01-01 10:00:00",), ("garbage",), (None,)], "t string")
    got = [r[0] for r in S.coerce_dates(df, ["t"]).collect()]
    assert str(got[0]) == "2018-01-01 10:00:00" and got[1] is None and got[2] is None


def test_contract_names():
    c = Contract(table="t", columns=(("a", "string"), ("b", "timestamp_ntz")))
    assert c.names == ["a", "b"] and c.timestamp_columns == ["b"]


def test_save_writes_a_new_version_and_view(spark):
    base = tempfile.mkdtemp(prefix="kpiforge-test-save-")
    df = spark.createDataFrame([(2018, 1, 5.0)], "year int, quarter int, revenue double")
    p1 = S.save(df, base, "analytics", "kpi", 1)
    p2 = S.save(df.withColumn("revenue", F.lit(6.0)), base, "analytics", "kpi", 2)
    assert p1 != p2 and spark.read.parquet(p1).first()["revenue"] == 5.0
    assert spark.table("analytics_kpi").first()["revenue"] == 6.0
    with pytest.raises(Exception):
        S.save(df, base, "analytics", "kpi", 2)                 # never overwrite a version


def test_manifest_sees_a_replaced_pair_of_equal_rows(spark):
    def sums(md5s):
        r = S.manifest(spark.createDataFrame([("f", m) for m in md5s], "_source_file string, _row_md5 string")).first()
        return r["n_rows"], r["checksum"], r["hash_sum"]
    a, b = "f" * 32, "0123456789abcdef" * 2
    assert sums([a, a])[:2] == sums([b, b])[:2] and sums([a, a])[2] != sums([b, b])[2]
    assert sums([a] * 40)[2] == int("f" * 15, 16) * 40 % (1 << 60)


def test_a_load_is_written_once(spark, tmp_path):
    seen = []
    real = spark.range(6).select("id", F.concat(F.lit("a/b="), (F.col("id") % 2).cast("string")).alias("_source_file"))
    table = str(tmp_path / "t")
    acc = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame(real.rdd.map(lambda r: acc.add(1) or r), real.schema)
    S.replace_by_source(rows, table, ["a/b=0", "a/b=1"])
    assert acc.value == 6 and not seen
    S.replace_by_source(real.where("_source_file = 'a/b=1' and id > 1"), table, ["a/b=1"])
    got = sorted(map(tuple, spark.read.parquet(table).collect()))
    assert got == [(0, "a/b=0"), (2, "a/b=0"), (3, "a/b=1"), (4, "a/b=0"), (5, "a/b=1")]
    assert [p for p in os.listdir(table) if p.startswith("_staged")] == []


REJECT = """order_id,customer_id,order_status,order_approved_at,order_delivered_customer_date,order_estimated_delivery_date,note
o1,c1,delivered,2018-01-01 10:00:00,2018-01-03 00:00:00,2018-01-10 00:00:00,"fine, quoted"
o2,c1,delivered,soon,2018-01-03 00:00:00,2018-01-10 00:00:00,x
o3,c1,delivered,N/A,,2018-01-10 00:00:00,missing ones are no fault
o4,c1,delivered

o5,c1,delivered,2018-01-01 10:00:00,2018-01-03 00:00:00,2018-01-10 00:00:00,x,one,two
o6,c1,delivered,2018-02-30 10:00:00,never,2018-01-10 00:00:00,first fault counts
"""


def test_rejected_records_are_kept_with_their_reason(spark):
    got = S.read_checked(spark, _csv(REJECT), ORDERS)
    assert [r["order_id"] for r in got.kept.orderBy("order_id").collect()] == ["o1", "o3"]
    assert got.kept.columns == [*ORDERS.names, "_source_file"]
    rejected = {r["record"][:2]: r for r in got.rejected.collect()}
    assert {k: r["reason"] for k, r in rejected.items()} == {
        "o2": "bad order_approved_at", "o4": "field count", "o5": "field count", "o6": "bad order_approved_at"}
    assert rejected["o5"]["record"].endswith(",x,one,two") and rejected["o4"]["record"] == "o4,c1,delivered"
    lines = [line for line in REJECT.splitlines()[1:] if line]
    assert got.kept.count() + got.rejected.count() == len(lines)
    assert got.rows.groupBy("_reason").count().count() == 3  # few columns asked for: the same verdicts
    assert {r["_source_file"] for r in got.rows.collect()} == {"f.csv"}
    with pytest.raises(S.ContractError):
        S.read_checked(spark, _csv("a,b\n1,2\n"), ORDERS)


def test_counts_from_footers(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(1000).select("id", F.when(F.col("id") > 9, F.col("id")).alias("x")).repartition(3).write.parquet(p)
    assert S.footer_counts(spark, {"t": p}).collect() == [("t", 1000)]
    assert S.from_footers(spark, p, F.count(F.lit(1)), F.count("x"), F.min("x"), F.max("id"))[:] == (1000, 990, 10, 999)
    plan = S.footer_plan(spark, p, F.count(F.lit(1)))
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint>" in plan
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the setting is put back
