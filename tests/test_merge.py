"""The bucketed merge against the upsert, its plans, and KPI tables that follow its changes."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from kpiforge.operators import kpis
from kpiforge.operators.fact import DuplicateKeyError, upsert, upsert_counts
from kpiforge.operators.merge import BucketedFact
from kpiforge.operators.refresh import KpiTables, StateError, signed_rows
from kpiforge.session import scratch_path

COLS = ["event_id", "order_id", "order_item_id", "price", "lead_time_days", "on_time_flag", "calendar_sk", "customer_sk",
        "product_sk", "seller_sk", "_row_md5"]


def items(spark, start, stop, price=1, day=0):
    """Items of two lines an order; days cover four quarters."""
    return spark.range(start, stop).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("order_item_id"),
        (F.col("id") % 13 * price).cast("decimal(12,2)").alias("price"), (F.col("id") % 17 / 3 + price).alias("lead_time_days"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 2).cast("int")).alias("on_time_flag"),
        ((F.col("id") + day) % 360 + 1).alias("calendar_sk"), (F.col("id") % 7).alias("customer_sk"), F.lit(3).cast("bigint").alias("product_sk"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("seller_sk"),
        F.md5(F.concat_ws("|", "id", F.lit(price))).alias("_row_md5"))


@pytest.fixture
def fact(spark):
    made = []

    def build(rows, buckets=8):
        f = BucketedFact(spark, f"kf_test_{len(made)}_{os.getpid()}", scratch_path(spark, "bucketed"), buckets).create(rows)
        made.append(f)
        return f

    yield build
    for f in made:
        f.drop()


def same(a, b):
    return sorted(map(str, a.select(*COLS).collect())) == sorted(map(str, b.select(*COLS).collect()))


def test_merges_like_the_upsert(spark, fact):
    old = upsert(None, items(spark, 0, 300)).table.checkpoint()
    src = items(spark, 290, 310, price=2).unionByName(items(spark, 5, 9))
    f, want = fact(old), upsert(old, src)
    changes = f.merge(src)
    assert same(f.read(), want.table)
    assert dict(upsert_counts(changes).collect()) == dict(upsert_counts(want.actions).collect()) == {"insert": 20, "update": 20, "unchanged": 8}
    assert dict(upsert_counts(f.merge(src)).collect()) == {"unchanged": 48}
    assert same(f.read(), want.table)


def test_nulls_lookups_and_a_new_table(spark, fact):
    old = upsert(None, items(spark, 0, 20)).table.withColumn("customer_sk", F.when(F.col("order_item_id") == 1, F.col("customer_sk"))).checkpoint()
    f = fact(old)
    src = items(spark, 0, 20).withColumn("seller_sk", F.lit(None).cast("bigint"))
    f.merge(src)
    assert same(f.read(), upsert(old, src).table)  # keys filled in, sellers kept
    empty = fact(old.limit(0))
    empty.merge(items(spark, 0, 5))
    assert empty.read().agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()[:] == (1, 10, 10)
    empty.merge(items(spark, 0, 0))
    assert empty.read().count() == 10 and empty.touched == ()


def test_a_repeated_key_is_an_error(spark, fact):
    f = fact(upsert(None, items(spark, 0, 5)).table)
    with pytest.raises(DuplicateKeyError):
        f.merge(items(spark, 0, 2).unionByName(items(spark, 1, 3)))


def test_only_touched_buckets_are_written(spark, fact):
    f = fact(upsert(None, items(spark, 0, 200)).table)
    files = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(f.path.replace("file:", "") + "/_bucket=*/*.parquet")}
    before = files()
    f.merge(items(spark, 7, 8, price=9))
    after = files()
    touched = {f"_bucket={b}" for b in f.touched}
    assert 1 <= len(touched) <= 2
    assert {p.split("/")[-2] for p in set(before) ^ set(after)} == touched
    assert glob.glob(f.path.replace("file:", "") + "/_staged*") == []


def test_a_stopped_merge_is_run_again(spark, fact, monkeypatch):
    from kpiforge.operators import merge
    old = upsert(None, items(spark, 0, 50)).table.checkpoint()
    f, src = fact(old), items(spark, 40, 60, price=3)
    with monkeypatch.context() as m:
        m.setattr(merge, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            f.merge(src)
    assert same(f.read(), old)
    f.merge(src)
    assert same(f.read(), upsert(old, src).table)


@pytest.mark.parametrize("how", ["left", "full"])
def test_the_table_is_not_exchanged(spark, fact, how):
    f = fact(upsert(None, items(spark, 0, 50)).table)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = f.against(items(spark, 0, 5), ["event_id"], how, range(3))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line)
    above = plan.splitlines()[:scan]
    join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    table_side = [line for line in above[join + 1:] if line.startswith("      +-") or line.startswith("       ")]
    assert plan.count("Exchange") == 1 and not any("Exchange" in line for line in table_side)
    assert "Bucketed: true" in plan and "PartitionFilters: [_bucket" in plan


@pytest.fixture(scope="module")
def dims(spark):
    cal = spark.range(1, 361).select(F.col("id").alias("calendar_sk"), F.lit(2020).alias("year"), ((F.col("id") - 1) / 90 + 1).cast("int").alias("quarter"))
    cust = spark.range(7).select(F.col("id").alias("customer_sk"), F.when(F.col("id") < 5, "here").otherwise("there").alias("customer_city"))
    return cal.checkpoint(), cust.checkpoint()


def kpi_rows(df):
    return sorted((r["year"], r["quarter"], r["revenue_sp"], round(r["lead_time_p90"], 9), round(r["on_time_rate"], 9)) for r in df.collect())


def test_refreshed_kpis_equal_the_full_ones(spark, fact, dims, tmp_path):
    cal, cust = dims
    f = fact(upsert(None, items(spark, 0, 700)).table)
    t = KpiTables(spark, str(tmp_path), cal, cust, "here").build(f.read())
    assert kpi_rows(t.kpis()) == kpi_rows(kpis.fact_kpis(f.read(), cal, cust, "here"))
    for load in (items(spark, 650, 800, price=2), items(spark, 0, 40, price=3, day=200), items(spark, 650, 800, price=2)):
        t.refresh(f.merge(load))
        assert kpi_rows(t.kpis()) == kpi_rows(kpis.fact_kpis(f.read(), cal, cust, "here"))
    assert t.touched == ()  # the last load changed nothing


def test_untouched_quarters_are_left_alone(spark, fact, dims, tmp_path):
    cal, cust = dims
    f = fact(upsert(None, items(spark, 0, 360)).table)
    t = KpiTables(spark, str(tmp_path), cal, cust, "here").build(f.read())
    files = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(str(tmp_path / "*/year=*/quarter=*/*.parquet"))}
    before = files()
    changes = f.merge(items(spark, 100, 110, price=4))
    for p in before:  # nothing but the touched quarter can be read
        if "quarter=2" not in p:
            os.rename(p, p + ".away")
    t.refresh(changes)
    for p in before:
        if "quarter=2" not in p:
            os.rename(p + ".away", p)
    assert t.touched == ((2020, 2),)
    assert {p.split("quarter=")[1][0] for p in set(before) ^ set(files())} == {"2"}
    assert kpi_rows(t.kpis()) == kpi_rows(kpis.fact_kpis(f.read(), cal, cust, "here"))


def test_a_quarter_that_loses_all_items_goes(spark, fact, dims, tmp_path):
    cal, cust = dims
    f = fact(upsert(None, items(spark, 0, 5)).table)
    t = KpiTables(spark, str(tmp_path), cal, cust, "here").build(f.read())
    t.refresh(f.merge(items(spark, 0, 5, price=2, day=100)))
    assert [(r["year"], r["quarter"]) for r in t.kpis().collect()] == [(2020, 2)]


def test_changes_of_another_fact_are_refused(spark, fact, dims, tmp_path):
    cal, cust = dims
    f = fact(upsert(None, items(spark, 0, 30)).table)
    t = KpiTables(spark, str(tmp_path), cal, cust, "here").build(items(spark, 101, 102))
    before = kpi_rows(t.kpis())
    with pytest.raises(StateError):
        t.refresh(f.merge(items(spark, 0, 30, price=2, day=90)))
    assert kpi_rows(t.kpis()) == before


def test_signed_rows(spark, fact):
    f = fact(upsert(None, items(spark, 0, 3)).table)
    got = signed_rows(f.merge(items(spark, 1, 4, price=2)), ["price"])
    assert got.groupBy("_sign").count().orderBy("_sign").collect() == [(-1, 4), (1, 6)]


def test_a_merge_deals_its_rows_once(spark, fact, monkeypatch):
    f = fact(upsert(None, items(spark, 0, 60)).table)
    plans, write = [], BucketedFact._write
    monkeypatch.setattr(BucketedFact, "_write", lambda self, rows, name, path, dealt=False: (
        plans.append((dealt, rows)), write(self, rows, name, path, dealt))[1])
    want = upsert(f.read(), items(spark, 30, 70, price=2)).table.checkpoint()
    f.merge(items(spark, 30, 70, price=2))
    assert plans[0][0]  # written as joined, not repartitioned again
    assert same(f.read(), want)
    assert all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in glob.glob(f"{f.path.removeprefix('file:')}/_bucket=*"))


def test_buckets_of_another_number_than_partitions(spark, fact):
    old = upsert(None, items(spark, 0, 60)).table
    f, want = fact(old, 5), upsert(old, items(spark, 30, 70, price=2)).table
    f.merge(items(spark, 30, 70, price=2))
    assert same(f.read(), want)


def test_sums_and_leads_come_from_one_pass(spark, fact, dims, tmp_path, monkeypatch):
    cal, cust = dims
    kept, store = [], KpiTables._store
    monkeypatch.setattr(KpiTables, "_store", lambda self, name, df: (kept.append(name), store(self, name, df))[1])
    t = KpiTables(spark, str(tmp_path), cal, cust, "here")
    rows = items(spark, 0, 200).withColumn("lead_time_days", F.when(F.col("order_item_id") == 1, F.col("lead_time_days")))
    t.build(rows)
    assert kept == ["by-lead"]
    assert kpi_rows(t.kpis()) == kpi_rows(kpis.fact_kpis(rows, cal, cust, "here"))
