"""Distributed running totals, surrogate keys and LAG against brute force,
with one hot group holding a third of the rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiforge.operators.keys import assign_sk, insert_absent, lag_within, running_total


def _hot_rows(n=600, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"
        out.append((g, i, rnd.randint(1, 1000)))
    return out


def test_running_total_matches_brute_force(spark):
    data = _hot_rows()
    df = spark.createDataFrame(data, "g string, k int, v int")
    got = running_total(df, order_by=["k"], partition_by=["g"],
                        values={"cum": F.col("v").cast("bigint"), "rank": F.lit(1).cast("bigint")},
                        num_partitions=8)
    got = {(r["g"], r["k"]): (r["cum"], r["rank"]) for r in got.collect()}
    want = {}
    for g in {d[0] for d in data}:
        acc, rank = 0, 0
        for _, k, v in sorted(d for d in data if d[0] == g):
            acc += v
            rank += 1
            want[(g, k)] = (acc, rank)
    assert got == want


def test_running_total_descending_order(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 1), (4, 9)], "k int, v int")
    got = running_total(df, order_by=[F.col("v").desc(), F.col("k").asc()], out="n")
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [(1, 3), (2, 1), (3, 4), (4, 2)]


def _null_rows(n=600, seed=5):
    """A third of the rows in the NULL group."""
    rnd = random.Random(seed)
    return [(None if i % 3 == 0 else rnd.choice("abcd"), i, rnd.choice([None, 1, 5, 9])) for i in range(n)]


def test_null_group_like_a_plain_window(spark):
    data = _null_rows()
    df = spark.createDataFrame(data, "g string, k int, v int")
    w = Window.partitionBy("g").orderBy("k")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("g", "k", F.row_number().over(w).alias("rank"),
                     F.sum(F.coalesce("v", F.lit(0))).over(upto).alias("cum"), F.lag("v", 1).over(w).alias("prev"))
    ranks = running_total(df, order_by=["k"], partition_by=["g"], out="rank", num_partitions=8)
    cums = running_total(df, order_by=["k"], partition_by=["g"], out="cum", num_partitions=8,
                         value=F.coalesce("v", F.lit(0)).cast("bigint"))
    lags = lag_within(df, ["g"], ["k"], "v", "prev", num_partitions=8)
    for got, col in ((ranks, "rank"), (cums, "cum"), (lags, "prev")):
        assert {(r["k"], r[col]) for r in got.collect()} == {(r["k"], r[col]) for r in want.collect()}


def test_assign_sk_dense_and_stable(spark):
    first = spark.createDataFrame([("b",), ("d",), ("a",)], "id string")
    dim1 = assign_sk(first, ["id"], "sk")
    assert sorted((r["sk"], r["id"]) for r in dim1.collect()) == [(1, "a"), (2, "b"), (3, "d")]
    more = spark.createDataFrame([("c",), ("a",), ("e",), ("d",)], "id string")
    dim2 = assign_sk(more, ["id"], "sk", existing=dim1)
    assert sorted((r["sk"], r["id"]) for r in dim2.collect()) == [
        (1, "a"), (2, "b"), (3, "d"), (4, "c"), (5, "e")]


def test_insert_absent(spark):
    t = spark.createDataFrame([("a",), ("b",)], "id string")
    s = spark.createDataFrame([("b",), ("c",)], "id string")
    assert [r["id"] for r in insert_absent(t, s, ["id"]).collect()] == ["c"]


def test_lag_within_matches_brute_force(spark):
    data = _hot_rows(900, seed=3)
    df = spark.createDataFrame(data, "g string, k int, v int")
    dist = lag_within(df, ["g"], ["k"], "v", "prev", num_partitions=8)
    got = {(r["g"], r["k"]): r["prev"] for r in dist.collect()}
    want = {}
    for g in {d[0] for d in data}:
        prev = None
        for _, k, v in sorted(d for d in data if d[0] == g):
            want[(g, k)] = prev
            prev = v
    assert got == want


def test_running_count_per_group_positional_path(spark):
    data = _hot_rows(700, seed=11)
    df = spark.createDataFrame(data, "g string, k int, v int")
    got = running_total(df, order_by=["k"], partition_by=["g"], out="rank", num_partitions=8)
    got = {(r["g"], r["k"]): r["rank"] for r in got.collect()}
    want = {}
    for g in {d[0] for d in data}:
        for rank, (_, k, _) in enumerate(sorted(d for d in data if d[0] == g), start=1):
            want[(g, k)] = rank
    assert got == want
