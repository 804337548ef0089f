"""Percentiles against the built-in one: hot and NULL groups, fractional values,
brackets that miss, both ways of summing counts, and the sketch's rank error."""

import random

import pytest
from pyspark.sql import functions as F

from kpiforge.operators import kpis, percentiles as P
from kpiforge.operators.percentiles import percentiles

PS = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.999, "p100": 1.0}


def like_built_in(df, got, ps=PS):
    want = df.where("v is not null").groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in ps.items()])
    key = lambda r: str(r["g"])
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert a["g"] == b["g"]
        assert all(abs(a[n] - b[n]) <= 1e-9 * max(1, abs(b[n])) for n in ps), (a, b)


def random_rows(spark, n=900):
    rnd = random.Random(4)
    rows = [(None if i % 3 == 0 else rnd.choice("ab"), rnd.choice([None, rnd.random(), rnd.randint(0, 5) / 2])) for i in range(n)]
    rows += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("empty", None)]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.fixture(scope="module")
def large(spark):
    """A hot group of fractional values, one of few values, a NULL one, a small one."""
    return spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "ties").when(F.col("id") < 500, "small").alias("g"),
        F.when(F.col("id") % 3 == 1, F.floor(F.rand(1) * 7)).otherwise(F.exp(F.randn(2) * 3)).alias("v")).checkpoint()


def test_like_the_built_in(spark):
    df = random_rows(spark)
    like_built_in(df, percentiles(df, ["g"], "v", PS))


def test_brackets_of_large_groups(large):
    like_built_in(large, percentiles(large, ["g"], "v", PS))


def test_counts_hold_few_of_a_group_s_values(large, monkeypatch):
    seen = []
    real = P.percentiles_of_counts
    monkeypatch.setattr(P, "percentiles_of_counts", lambda counts, *a, **k: seen.append(counts.groupBy("g").count().collect()) or real(counts, *a, **k))
    percentiles(large, ["g"], "v", {"p90": 0.9}).collect()
    n = {r["g"]: r["count"] for r in seen[0]}
    assert n["hot"] < 20_000 * 0.06 and n["ties"] <= 7


def test_a_bracket_that_misses_is_counted_in_full(large, monkeypatch):
    monkeypatch.setattr(P, "BRACKET", -0.01)  # no rank is inside
    like_built_in(large, percentiles(large, ["g"], "v", PS))


def test_distributed_sums_and_joins(spark, large, monkeypatch):
    monkeypatch.setattr(P, "WINDOW_COUNTS", 0)
    monkeypatch.setattr(P, "BROADCAST_GROUPS", 0)
    like_built_in(large, percentiles(large, ["g"], "v", PS))
    df = random_rows(spark)
    like_built_in(df, percentiles(df, ["g"], "v", PS))


def test_further_aggregates_come_along(spark):
    df = random_rows(spark)
    got = percentiles(df, ["g"], "v", PS, also={"n": F.count(F.lit(1)), "s": F.sum("v")})
    assert got.columns == ["g", "n", "s", *PS]
    empty = got.where("g = 'empty'").first()
    assert empty["n"] == 1 and empty["s"] is None and empty["p50"] is None
    like_built_in(df, got.where("g is null or g != 'empty'"))


def test_no_rows(spark):
    assert percentiles(random_rows(spark).limit(0), ["g"], "v", PS).collect() == []


def test_the_sketch_s_rank_error(large):
    got = P.percentiles_approx(large, ["g"], "v", {"e": 0.9}).checkpoint()
    ranks = P.rank_shares(large.where("g is not null"), ["g"], "v", got, "e").collect()
    assert {r["g"] for r in got.collect()} == {"hot", "ties", "small", None} and len(ranks) == 3
    assert all(r["below"] - P.SKETCH_ERROR <= 0.9 <= r["upto"] + P.SKETCH_ERROR for r in ranks)


def test_the_rows_are_not_shuffled(spark, large):
    """Pass 2 aggregates in its tasks: its only exchange holds the partial counts."""
    groups = large.groupBy("g").agg(F.count("v").alias("_n"), P.quantile_sketch("v").alias("_sketch"))
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_") > plan.index("Exchange")


def test_pivot_round_trip(spark):
    rows = [(2020, 1, "large items", 5.0, 0.5), (2020, 1, "small items", 1.0, None), (2020, 2, "large items", None, 0.25), (2020, 3, "other", 1.0, 1.0)]
    long = spark.createDataFrame(rows, "year int, quarter int, category string, revenue double, rate double")
    values = ["large items", "small items"]
    wide = kpis.pivoted(long, kpis.YQ, "category", values, ["revenue", "rate"])
    assert wide.columns == ["year", "quarter", "large_items_revenue", "large_items_rate", "small_items_revenue", "small_items_rate"]
    back = kpis.unpivoted(wide, kpis.YQ, "category", values, ["revenue", "rate"])
    assert sorted(map(tuple, back.collect())) == sorted(r for r in rows if r[2] != "other")
    assert wide.count() == 3
