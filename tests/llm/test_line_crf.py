"""Forward-backward against all labellings, its gradient use, and held-out accuracy."""

import itertools
import tracemalloc

import numpy as np
import pytest
from kpiforge.llm import line_crf as C
from kpiforge.llm.queries import op5_quality_crf


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 2, 5, 4])
    node, edge = rng.normal(size=(4, 5)) * 3, rng.normal(size=(2, 2))
    good, pairs, log_z = C.forward_backward(node, lengths, edge)
    for c, n in enumerate(lengths):
        total, marg, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            p = np.exp(sum(node[c, t] * y[t] for t in range(n)) + sum(edge[a, b] for a, b in itertools.pairwise(y)))
            total += p
            marg += p * np.array(y)
            for a, b in itertools.pairwise(y):
                pair[a, b] += p
        np.testing.assert_allclose(good[c, :n], marg / total, rtol=1e-9)
        np.testing.assert_allclose(pairs[c], pair / total, rtol=1e-9)
        np.testing.assert_allclose(log_z[c], np.log(total), rtol=1e-9)
        assert not good[c, n:].any()


def test_extreme_scores_stay_finite():
    good, _, log_z = C.forward_backward(np.array([[800.0, -800.0, 0.0]]), np.array([3]), np.array([[2.0, -9.0], [-9.0, 2.0]]))
    assert np.isfinite(good).all() and np.isfinite(log_z).all()


def test_learns_lines_from_document_labels():
    prose = b"Some plain words stand in this line of text and end here."
    junk = b"BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!"
    good = [C.line_features(b"\n".join([prose] * k))[0] for k in (1, 2, 3, 4)] * 5
    bad = [C.line_features(b"\n".join([junk] * k))[0] for k in (1, 2, 3, 4)] * 5
    field = C.fit_field(good + bad, [np.ones(len(f)) for f in good] + [np.zeros(len(f)) for f in bad])
    w = np.array(field.node)
    clean, mixed, dirty = (C.goodness(field, [C.text_scores(t, w)])[0] for t in (prose, prose + b"\n" + junk, junk))
    assert clean > 0.9 > mixed > 0.1 > dirty


def test_features():
    f, size = C.line_features(b"one one two\n\none one two")
    assert f.shape == (3, C.N_LINE) and size.tolist() == [12, 1, 12]
    assert f[0, 10] == 0 and f[2, 10] == 1 and f[1, 11] == 1
    assert C.line_features(b"")[0].shape == (1, C.N_LINE)


def beside(f, w):
    """Line, line before and line after, laid side by side, times the weights."""
    zero = np.zeros((1, C.N_LINE))
    return np.hstack([f, np.vstack([zero, f[:-1]]), np.vstack([f[1:], zero])]) @ w


def test_node_scores_of_lines_and_their_neighbours(monkeypatch):
    w = np.random.default_rng(2).normal(size=C.N_NODE)
    text = b"\n".join([b"one two", b"", b"Three!! 4", b"one two", b"x | y", b"", b"one two"])
    want = beside(C.line_features(text)[0], w)
    np.testing.assert_allclose(C.node_scores(C.line_features(text)[0], w), want, rtol=1e-6)
    for segment in (1, 2, 3, 7):  # a repeated line is seen across segments
        monkeypatch.setattr(C, "SEGMENT", segment)
        got, size = C.text_scores(text, w)
        np.testing.assert_allclose(got, want, rtol=1e-6)
        assert size.tolist() == C.line_features(text)[1].tolist()


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_a_chain_by_itself_equals_the_block(monkeypatch, segment):
    monkeypatch.setattr(C, "SEGMENT", segment)
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 65):
        node, edge = rng.normal(size=n) * 20, rng.normal(size=(2, 2)) * 3
        good, _, _ = C.forward_backward(node[None], np.array([n]), edge)
        np.testing.assert_allclose(C.chain_marginals(node, edge), good[0], rtol=1e-9, atol=1e-300)


def test_long_and_short_chains_together(monkeypatch):
    field = C.Field(tuple(np.random.default_rng(4).normal(size=C.N_NODE).tolist()), ((0.3, -0.2), (-0.4, 0.5)))
    rng = np.random.default_rng(5)
    node = [rng.normal(size=n) for n in (3, 40, 1, 12, 90, 5, 12)]
    whole = C.marginals(field, node)
    monkeypatch.setattr(C, "LONG_LINES", 10)
    monkeypatch.setattr(C, "CELLS", 12)
    for a, b in zip(whole, C.marginals(field, node), strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_blocks_are_bounded_by_padded_lines(monkeypatch):
    monkeypatch.setattr(C, "CELLS", 20)
    lengths = np.array([5, 1, 30, 1, 6, 2, 19])
    blocks = list(C._blocks(lengths))
    assert sorted(np.concatenate(blocks).tolist()) == list(range(7))
    assert all(len(b) == 1 or len(b) * lengths[b].max() <= 20 for b in blocks)
    assert list(C._blocks(np.zeros(0, int))) == []


def test_memory_of_texts_with_very_many_lines():
    each = C._setup(C.Field((0.1,) * C.N_NODE))
    # among short texts one of 120,000 empty lines; and 150,000 short lines
    for texts in ([b"a few words"] * 255 + [b"\n" * 120_000], [b"ab cd\n" * 150_000]):
        tracemalloc.start()
        got = each(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == len(texts) and peak < 300e6


def test_edge_rows(spark):
    field = C.Field(tuple([0.5] + [0.0] * (C.N_NODE - 1)), ((0.1, 0.0), (0.0, 0.1)), 1.0, 0.0)
    texts = [None, "", "\n\n", "a\n" * 30_000, "word " * 100_000, "x"]
    docs = spark.createDataFrame([(k, t, 3.0) for k, t in enumerate(texts)] + [(0, None, 1.0), (None, "x", 1.0)],
                                 "doc_id long, text string, score double")
    got = C.score(docs, field).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[0]["score"] == by[1]["score"] and by[5]["score"] == by[None]["score"]
    assert by[3]["n_lines"] == 30_001
    assert C.score(docs.limit(0), field).collect() == []


def test_one_class_teaches_nothing(spark):
    rows = spark.createDataFrame([(1, "a", 1, 1.0), (2, "b", 1, 1.0)], "doc_id long, text string, label int, weight double")
    assert C.learn(rows) is None


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = op5_quality_crf(spark, d)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.count() == 10_000
    both = got.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(both) > 400
    for y in (0, 1):
        own = [r for r in both if r["quality"] == y]
        assert sum(r["predicted"] == y for r in own) >= 0.95 * len(own)
    bad, good = ([r["score"] for r in both if r["quality"] == y] for y in (0, 1))
    assert np.mean([a < b for a in bad for b in good]) > 0.99  # area under the curve


def test_long_documents_are_learned_from(spark):
    at = C._fit_lines(1000)
    assert len(set(at.tolist())) == C.MAX_FIT_LINES and at[0] == 0 and at[-1] == 999 and C._fit_lines(256).tolist() == list(range(256))
    prose, junk = "Some plain words stand in this line of text and end here.", "BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!"
    rows = [("\n".join([prose] * (2 + k)), 1, 1.0) for k in range(20)] + [("\n".join([junk] * (300 + k)), 0, 1.0) for k in range(20)]
    field = C.learn(spark.createDataFrame(rows, "text string, label int, weight double"))
    assert field is not None  # the bad ones are all over MAX_FIT_LINES
    docs = spark.createDataFrame([(1, prose), (0, junk), (2, "\n".join([junk] * 400))], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in C.score(docs, field).collect()}
    assert score[1] > 0.5 > max(score[0], score[2])
