"""Quality checks, quarantine split and the rule report (FIXTURES 5: quarantine)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiforge.operators import quality as Q

T = dt.datetime.fromisoformat


def test_quarantine_split_is_complete(spark):
    rows = [("o1", T("2018-01-01 00:00:00"), T("2018-01-03 00:00:00")),
            ("o2", T("2018-01-05 00:00:00"), T("2018-01-03 00:00:00")),
            ("o3", None, T("2018-01-03 00:00:00"))]
    df = spark.createDataFrame(rows, "order_id string, order_approved_at timestamp_ntz, "
                                     "order_delivered_customer_date timestamp_ntz")
    split = Q.split_quarantine(df, Q.order_date_rules())
    assert split.good.count() + split.quarantine.count() == df.count()
    assert [r["order_id"] for r in split.quarantine.collect()] == ["o2"]
    c = split.counts.first()
    assert (c["check"], c["violations"], c["n_rows"]) == ("inverted_dates", 1, 3)


def test_quarantine_sink_and_abort(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 2, F.lit(-1)).otherwise(F.lit(1)).alias("v"))
    rules, sink = {"negative": F.col("v") < 0}, str(tmp_path / "quarantine")
    split = Q.quarantine(df, rules, sink, 0.02)
    assert split.good.count() == 98
    assert sorted(map(tuple, spark.read.parquet(sink).collect())) == [(0, -1, "negative"), (1, -1, "negative")]
    with pytest.raises(Q.QuarantineAbort):
        Q.quarantine(df, rules, sink, {"negative": 0.01})
    assert spark.read.parquet(sink).count() == 2


def test_report_actions(spark):
    checks = [spark.createDataFrame([("inverted_dates", 50, 100)], Q.CHECK_SCHEMA),
              spark.createDataFrame([("negative_price", 0, 100)], Q.CHECK_SCHEMA),
              spark.createDataFrame([("null_estimated_date", 1, 1000)], Q.CHECK_SCHEMA)]
    got = {r["check"]: r["action"] for r in Q.dq_report(checks, Q.rules_frame(spark)).collect()}
    assert got == {"inverted_dates": "ABORT", "negative_price": "OK", "null_estimated_date": "WARN"}


def test_duplicates_orphans_ranges_coverage_reconcile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert [tuple(r) for r in Q.dq_duplicates(df, ["k"]).collect()] == [("a", 2)]
    assert Q.dq_duplicate_check(df, ["k"], "dup").first()["violations"] == 1
    fact = spark.createDataFrame([(1, -1.0, 1.0, 2.0), (9, 2.0, 1.0, -0.5)],
                                 "customer_sk int, price double, freight_value double, lead_time_days double")
    dim = spark.createDataFrame([(1,)], "customer_sk int")
    assert Q.dq_orphans(fact, {"customer_sk": dim}).first()["violations"] == 1
    rng = {r["check"]: r["violations"] for r in Q.dq_ranges(fact, Q.fact_range_rules()).collect()}
    assert rng == {"negative_price": 1, "negative_freight": 0, "negative_lead_time": 1}
    cities = spark.createDataFrame([("sao paulo",), (" SAO paulo",)], "customer_city string")
    assert Q.dq_city_coverage(cities).first()["coverage"] == 0.5
    rec = Q.dq_reconcile(spark.range(100), spark.range(99)).first()
    assert (rec["expected_rows"], rec["loaded_rows"], rec["within_tolerance"]) == (100, 99, True)
    assert Q.dq_null_keys(fact.withColumn("x", F.lit(None)), ["x"]).first()[0] == 2


def _load(spark, name, values):
    return spark.createDataFrame([(i, v, name) for i, v in enumerate(values)], "id int, v int, _source_file string")



def rules():
    return {"negative": F.col("v") < 0, "large": F.col("v") > 100}


def test_a_second_run_replaces_its_load_s_quarantine(spark, tmp_path):
    sink = str(tmp_path / "q")
    got = lambda: sorted((r["_source_file"], r["id"], r["reason"]) for r in spark.read.parquet(sink).collect())
    for _ in range(2):
        split = Q.quarantine(_load(spark, "a", [1, -1, 200]), rules(), sink, 0.5)
    assert {r["check"]: (r["violations"], r["n_rows"]) for r in split.counts.collect()} == {"negative": (1, 3), "large": (1, 3)}
    Q.quarantine(_load(spark, "b", [-5, 2, 3]), rules(), sink, 0.5)
    assert got() == [("a", 1, "negative"), ("a", 2, "large"), ("b", 0, "negative")]
    Q.quarantine(_load(spark, "a", [1, 2, 3]), rules(), sink, 0.5)  # mended
    assert got() == [("b", 0, "negative")]
    with pytest.raises(Q.QuarantineAbort):
        Q.quarantine(_load(spark, "b", [-5, -2, 3]), rules(), sink, 0.5)
    assert got() == [("b", 0, "negative")]


def test_load_checked_routes_and_replaces(spark, tmp_path):
    table, sink = str(tmp_path / "t"), str(tmp_path / "q")

    def ids(path):
        return sorted((r["_source_file"], r["id"]) for r in spark.read.schema("id int, v int, _source_file string").parquet(path).collect())

    for _ in range(2):
        got = Q.load_checked(_load(spark, "a", [1, -1, None, 200]), rules(), table, sink, 0.5)
    Q.load_checked(_load(spark, "b", [1]), rules(), table, sink)
    assert got == {"_rows": 4, "negative": 1, "large": 1}
    assert ids(table) == [("a", 0), ("a", 2), ("b", 0)] and ids(sink) == [("a", 1), ("a", 3)]
    assert {r["reason"] for r in spark.read.parquet(sink).collect()} == {"negative", "large"}
    with pytest.raises(Q.QuarantineAbort):
        Q.load_checked(_load(spark, "a", [-1]), rules(), table, sink, {"negative": 0.2})
    assert ids(table) == [("a", 0), ("a", 2), ("b", 0)] and ids(sink) == [("a", 1), ("a", 3)]
    Q.load_checked(_load(spark, "b", [-1]), rules(), table, sink, 1.0)  # a load without good rows
    assert ids(table) == [("a", 0), ("a", 2)] and ids(sink) == [("a", 1), ("a", 3), ("b", 0)]


def test_a_checked_load_scans_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    df = _load(spark, "a", range(50))
    counted = spark.createDataFrame(df.rdd.map(lambda r: seen.add(1) or r), df.schema)
    Q.load_checked(counted, rules(), str(tmp_path / "t"), str(tmp_path / "q"), 1.0)
    assert seen.value == 50
    Q.quarantine(counted, rules(), str(tmp_path / "q2"), 1.0)
    assert seen.value == 100


@pytest.mark.parametrize("limit", [16_384, 0])
def test_orphans_by_bitmaps(spark, monkeypatch, limit):
    """Keys across bitmap and word edges, NULL, zero and negative ones; both ways of looking them up."""
    monkeypatch.setattr(Q, "BROADCAST_BITMAPS", limit)
    dim = spark.range(1, 70_000).where("id % 3 != 0").select(F.col("id").alias("a_sk"), F.lit(1))
    other = spark.createDataFrame([(5,), (64,)], "b_sk int")
    keys = [None, 0, -5, 1, 2, 3, 63, 64, 65, 32767, 32768, 32769, 32770, 65536, 65537, 69999, 70000, 10**12]
    fact = spark.createDataFrame([(k, i % 7 * 5 or None) for i, k in enumerate(keys)], "a_sk long, b_sk int")
    got = {r["sk_column"]: r["violations"] for r in Q.dq_orphans(fact, {"a_sk": dim, "b_sk": other}).collect()}
    have = {i for i in range(1, 70_000) if i % 3}
    assert got == {"a_sk": sum(k is not None and k not in have for k in keys),
                   "b_sk": sum(b is not None and b not in (5, 64) for b in (i % 7 * 5 or None for i in range(len(keys))))}


def test_orphans_leave_the_fact_in_place(spark):
    dim = spark.range(1, 100).select(F.col("id").alias("a_sk"))
    plan = Q.with_orphans(spark.range(50).select(F.col("id").alias("a_sk")), {"a_sk": dim})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
