"""Rollups against a recount of the final state after every batch."""

import random

import pytest
from kpiforge.llm import queries as Q
from kpiforge.llm import token_rollup as T
from kpiforge.session import scratch_path


def apply(state, changes):
    for seq, op, doc, tok, src, lang, n in sorted(changes, key=lambda c: c[0]):
        if op == "delete":
            state.pop((doc, tok), None)
        elif op in ("insert", "revise") and doc is not None:
            state[(doc, tok)] = (src, lang, n or 0)


def totals(state):
    out = {}
    for (_, tok), (src, lang, n) in state.items():
        d, t = out.get((src, lang, tok), (0, 0))
        out[(src, lang, tok)] = (d + 1, t + n)
    return out


def read(store):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}


def frame(spark, changes):
    return spark.createDataFrame(changes, T.CHANGES)


def test_batches_replays_and_restarts(spark):
    rnd = random.Random(1)
    path = scratch_path(spark, "rollup")
    store, state = T.Rollup(spark, path).create(), {}
    assert read(store) == {}
    for batch in range(1, 5):
        changes = [(k, rnd.choice(["insert", "delete", "revise"]), rnd.randrange(40), rnd.choice(["t1", "t2", None]),
                    rnd.choice(["s", None]), rnd.choice(["en", "de"]), rnd.choice([None, 0, rnd.randrange(1000)])) for k in range(60)]
        changes += [(99, "other", 1, "t1", "s", "en", 5), (99, "insert", None, "t1", "s", "en", 5)]
        assert store.commit(batch, frame(spark, changes))
        apply(state, changes)
        assert read(store) == totals(state)
        assert not store.commit(batch, frame(spark, changes))  # delivered again
        store = T.Rollup(spark, path).create()  # a new driver
        assert read(store) == totals(state) and store.committed() == list(range(batch + 1))
    with pytest.raises(ValueError):
        (spark.createDataFrame([(0,)], "n_changes long").write.parquet(f"{path}/commits/batch=9"))
        store.commit(6, frame(spark, []))


def test_a_batch_that_broke_off_is_not_read(spark):
    path = scratch_path(spark, "rollup")
    store = T.Rollup(spark, path).create()
    store.commit(1, frame(spark, [(0, "insert", 1, "t", "s", "en", 10)]))
    # files of a batch without its commit row
    spark.sql("select 's' source, 'en' lang, 't' tokenizer, 7L n_docs, 7L n_tokens").write.parquet(f"{path}/deltas/batch=2")
    assert read(store) == {("s", "en", "t"): (1, 10)}
    store.commit(2, frame(spark, [(0, "revise", 1, "t", "s2", "en", 4), (0, "insert", 2, "t", "s", "en", 1)]))
    assert read(store) == {("s2", "en", "t"): (1, 4), ("s", "en", "t"): (1, 1)}
    store.commit(3, frame(spark, [(0, "delete", 1, "t", None, None, None), (0, "delete", 77, "t", None, None, None)]))
    assert read(store) == {("s", "en", "t"): (1, 1)}
    store.commit(4, frame(spark, []))
    assert read(store) == {("s", "en", "t"): (1, 1)}


def test_counter(spark):
    ranks = T.ranks_of(Q.RANKS["byte_bpe_50k"])
    enc = T._encoding(ranks, Q.CUT)
    texts = ["Hello world", None, "", "<|endoftext|>", "é " * 40_000]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = got.select("k", T.Counter(spark, ranks, Q.CUT)("text").alias("n")).collect()
    assert {r["k"]: r["n"] for r in got} == {k: len(enc.encode_ordinary(t or "")) for k, t in enumerate(texts)}


def test_query(spark):
    d = "/root/testdata/sf0.001"
    state, enc = {}, {v: T._encoding(T.ranks_of(p), Q.CUT) for v, p in Q.RANKS.items()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    bad = {r["doc_id"] for r in spark.read.parquet(f"{d}/labels.parquet").where("quality = 0").collect()}
    first, second = Q.RANKS
    for r in docs:
        if r["doc_id"] not in bad:
            state[(r["doc_id"], first)] = (r["source"], r["lang"], len(enc[first].encode_ordinary(r["text"].replace("\n", " "))))
        state[(r["doc_id"], second)] = (r["source"], r["lang"], len(enc[second].encode_ordinary(r["text"])))
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in Q.op4_token_rollup(spark, d).collect()}
    assert got == totals(state)
