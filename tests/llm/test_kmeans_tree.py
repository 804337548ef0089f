"""The search against all inner products; the traversal against sorting."""

import math

import numpy as np
import pytest
from kpiforge.llm import kmeans_tree as K
from kpiforge.llm.queries import op1_kmeans_tree


def exact(rows, asked, k):
    """(query_id, rank, vec_id, score) of all candidates, ties to the smaller id."""
    out = []
    for i, v in rows:
        if asked(i):
            near = sorted((-math.fsum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in rows if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def search(spark, rows, cond, **kw):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    return sorted(map(tuple, K.search(frame, cond, **kw).collect()))


def as_float(rows):
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def test_all_leaves_give_the_exact_answer(spark):
    rng = np.random.default_rng(0)
    rows = as_float([(i, rng.normal(size=6).tolist()) for i in range(400)])
    assert search(spark, rows, "vec_id % 20 = 0", recall=2.0) == exact(rows, lambda i: i % 20 == 0, 20)


def test_equal_vectors_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 16)
    rng = np.random.default_rng(1)
    hot = [1.0, 2.0, -1.0]
    rows = [(i, hot) for i in range(0, 300, 2)] + as_float([(i, rng.integers(-2, 3, 3).tolist()) for i in range(1, 300, 2)])
    rows = [(i, v) for i, v in rows if any(v)]
    assert search(spark, rows, "vec_id % 20 = 0", recall=2.0) == exact(rows, lambda i: i % 20 == 0, 20)


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [0.5, 0.5]), (8, [-0.0, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    got = search(spark, rows, "vec_id % 4 = 0", k=20)
    assert got == [(0, 1, 7, 0.5), (0, 2, 8, 0.0), (8, 1, 7, 0.5), (8, 2, 0, 0.0)]
    assert search(spark, [], "true") == [] and search(spark, [(1, None)], "true") == []
    assert search(spark, [(1, [1.0])], "true") == []


def test_best_bin_first_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 5))
    tree = K.build(x)
    q = rng.normal(size=5)
    order = K.visit_order(tree, q, tree.n_leaves)
    assert sorted(order) == list(range(tree.n_leaves)) and K.visit_order(tree, q, 3) == order[:3]
    # a plain search: always open the branch of the largest inner product
    open_, want = [0], []
    while open_:
        node = max(open_, key=lambda n: (tree.centres[n] @ q, -n))
        open_.remove(node)
        want += [tree.leaf_of[node]] if tree.leaf_of[node] >= 0 else []
        open_ += tree.children[node]
    assert order == want
    assert set(K.leaves_of(tree, x)) <= set(range(tree.n_leaves))


def test_visits_go_on_until_the_leaves_hold_enough():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 5))
    tree = K.build(x)
    held = dict(zip(*(a.tolist() for a in np.unique(K.leaves_of(tree, x), return_counts=True)), strict=True))
    order = K.visit_order(tree, x[0], tree.n_leaves)
    got = K.visit_order(tree, x[0], 1, held, 150)
    assert got == order[:len(got)] and sum(held.get(v, 0) for v in got) >= 150 > sum(held.get(v, 0) for v in got[:-1])
    assert K.visit_order(tree, x[0], 3, held, 1) == order[:3]
    assert K.visit_order(tree, x[0], 1, held, 10_000) == order


def test_every_query_gets_a_whole_list(spark):
    # tight groups that fill their own leaves, and vectors far off in leaves of a few
    rng = np.random.default_rng(4)
    rows = [c * 10 + rng.normal(size=8) * 0.01 for c in rng.normal(size=(32, 8)) for _ in range(60)]
    rows = as_float(list(enumerate([*(r.tolist() for r in rows), *(rng.normal(size=(32, 8)) * 200).tolist()])))
    got = {}
    for q, *_ in search(spark, rows, "vec_id % 5 = 0", recall=0.5):
        got[q] = got.get(q, 0) + 1
    assert got == {i: 20 for i, _ in rows if i % 5 == 0}


def test_equal_vectors_make_one_leaf():
    assert K.build(np.ones((500, 3))).n_leaves == 1


def test_blocks_cover_leaves(monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 10)
    assert K.blocks_of({0: 4, 1: 5, 2: 3, 3: 25, 5: 2}, 6) == [(0, 1), (0, 1), (1, 1), (2, 3), (4, 1), (5, 1)]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {}
    for r in op1_kmeans_tree(spark, d).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    rows = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    hit = 0
    for i, found in got.items():
        s = x @ x[ids == i][0]
        s[ids == i] = -np.inf
        true = np.lexsort((ids, -s))[:20]
        hit += len(set(ids[true].tolist()) & {j for j, _ in found})
        assert len(found) == 20 and i not in [j for j, _ in found]
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        np.testing.assert_allclose([v for _, v in found], [s[ids == j][0] for j, _ in found], rtol=1e-12)
    assert hit >= 0.9 * 20 * len(got)
