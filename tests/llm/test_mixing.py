"""Budget tree against a plain recursive fill; the whole mixture against its SQL."""

import random

import duckdb
import pytest
from kpiforge.llm import mixing
from kpiforge.llm import queries as Q
from pyspark.sql import functions as F


def fill(budget, children):
    """{name: quota} of [(name, cap, weight)]: give shares, close the full ones, again."""
    open_, out, left = [c for c in children if c[1] > 0 and c[2] > 0], {}, budget
    while open_:
        total = sum(w for _, _, w in open_)
        full = [c for c in open_ if c[1] * total <= c[2] * left]
        if not full:
            return out | {n: min(c, w * left // total) for n, c, w in open_}
        for n, c, _ in full:
            out[n] = c
        left -= sum(c for _, c, _ in full)
        open_ = [c for c in open_ if c not in full]
    return out


def tree_fill(budget, leaves, weight, epochs):
    """Quotas of {(domain, lang, source): tokens}, level by level."""
    def down(path, quota):
        k = len(path)
        if k == 3:
            return {path: quota}
        kids = sorted({leaf[k] for leaf in leaves if leaf[:k] == path}, key=str)
        caps = {c: sum(t for leaf, t in leaves.items() if leaf[:k + 1] == (*path, c)) * epochs for c in kids}
        got = fill(quota, [(c, caps[c], weight(k, c)) for c in kids])
        return {x: q for c, part in got.items() for x, q in down((*path, c), part).items()}
    return down((), budget)


@pytest.mark.parametrize("share", [0.1, 0.6, 1.5, 3.9])
def test_quotas(spark, share):
    rnd = random.Random(share)
    leaves = {(d, l, s): rnd.choice([0, 3, 50, 1000, 90_000]) for d in "ab" for l in ("en", None, "de") for s in ("s1", "s2", "s3")
              if rnd.random() < 0.8}
    budget = int(sum(leaves.values()) * share)
    frame = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    weights = [F.expr("case domain when 'a' then 3 else 1 end"), F.expr("case when lang is null then 5 when lang = 'de' then 0 else 2 end"),
               F.expr("case source when 's1' then 7 else 1 end")]
    plain = lambda k, c: [{"a": 3}.get(c, 1), {None: 5, "de": 0}.get(c, 2), {"s1": 7}.get(c, 1)][k]
    got = {(r["domain"], r["lang"], r["source"]): r["quota"] for r in mixing.leaf_quotas(frame, budget, weights, 4).collect()}
    want = tree_fill(budget, leaves, plain, 4)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    frame = spark.createDataFrame([("a", "en", "s", 10), ("a", "de", "s", 10_000), ("b", "en", "s", 10_000)],
                                  "domain string, lang string, source string, tokens long")
    got = {r["domain"] + r["lang"]: r["quota"] for r in mixing.leaf_quotas(frame, 1000, [F.lit(1)] * 3, 1).collect()}
    assert got == {"aen": 10, "ade": 490, "ben": 500}


def take(spark, rows, budget, epochs=4, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, n long, domain string")
    return mixing.mix(docs, F.coalesce("domain", F.lit("none")), F.col("n"), [F.lit(1)] * 3, budget, epochs, **kw)


def test_prefix_of_an_epoch(spark):
    rows = [(k, "en", "s", 1 + k % 5, "a") for k in range(200)]
    got = take(spark, rows, 1000).collect()
    assert got[0].asDict().keys() >= {"doc_id", "lang", "source", "n", "domain", "_epoch"}
    total = sum(r[3] for r in rows)
    by_epoch = {}
    for r in got:
        by_epoch.setdefault(r["_epoch"], set()).add(r["doc_id"])
    whole, rest = divmod(1000, total)
    assert all(len(by_epoch[e]) == 200 for e in range(1, whole + 1))
    last = sum(r[3] for r in rows if r[0] in by_epoch[whole + 1])
    assert rest <= last < rest + 5
    again = take(spark, rows, 1000).collect()
    other = take(spark, rows, 1000, seed=18).collect()
    key = lambda rs: sorted((r["doc_id"], r["_epoch"]) for r in rs)
    assert key(got) == key(again) != key(other)


def test_edge_rows(spark):
    rows = [(1, None, None, 5, None), (1, None, None, 5, None), (None, "en", "s", 3, "a"), (2, "en", "s", 0, "a"), (3, "", "", 7, "a")]
    got = take(spark, rows, 1.0, 1)
    assert got.count() == 5  # all there is, once
    assert take(spark, rows, 1000, 2).groupBy("_epoch").count().collect().__len__() == 2
    assert take(spark, [], 0.5).collect() == [] and take(spark, rows, 0).collect() == []


def test_columns_with_the_names_of_the_job(spark):
    names = ("_id", "_Domain", "_tokens", "_leaf", "_epoch", "c0", "a.b")
    rows = [(k, "en", "s", 2, *(f"{c}{k}" for c in names)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, n long, " + ", ".join(f"`{c}` string" for c in names))
    got = mixing.mix(docs, F.lit("d"), F.col("n"), [F.lit(1)] * 3, 1.0, 1)
    assert got.columns == docs.columns + ["__domain", "__tokens", "__epoch"]
    assert sorted(map(tuple, got.collect())) == sorted((*r, "d", 2, 1) for r in rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = con.sql(Q.oracle_sql()["op3_mixing"])
    got = Q.op3_mixing(spark, d)
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want.fetchall(), key=str)
