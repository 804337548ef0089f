"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample: every node splits its vectors by
k-means until leaves are small.  All distinct vectors are then sent down to their
leaves.  A query goes through the tree best bin first: a priority queue holds
the open branches by the inner product with their centres, and leaves come off
it in the order in which they are visited.

How many leaves a query visits is calibrated: some queries are answered exactly
against all vectors, and the visits are widened until the leaves hold the wanted
share of the true neighbours.  A query whose leaves hold too few candidates for a whole list
goes on through its own queue until they hold enough.

Leaves that are neighbours in the tree are scanned together, in blocks of
bounded size, for the queries that visit any of them; a leaf with a third of all
rows, and a block that very many queries visit, is cut into many blocks.  Equal vectors are one
entry with its smallest ids: no list of k can hold more of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

K = 20
BRANCH = 8
FIT_ROWS = 20_000  # sample of the tree
LEAF_ROWS = 64  # sampled vectors in a leaf, at most
CALIBRATION = 64  # queries answered exactly
RECALL = 0.95  # wanted of them, so that 0.9 holds for others
BLOCK = 4096  # vectors, and queries, of a task's block


@dataclass(frozen=True)
class Tree:
    """centres[i] of node i, children[i] its nodes (none: a leaf)."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf_of: tuple[int, ...]  # the number of a leaf node, -1 for others

    @property
    def n_leaves(self) -> int:
        return max(self.leaf_of, default=-1) + 1


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """The cluster of each row, by Lloyd's rounds from spread-out starts."""
    centres = x[rng.choice(len(x), 1)]
    dist = ((x - centres[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = dist.sum()
        if total <= 0:
            break
        centres = np.vstack([centres, x[rng.choice(len(x), p=dist / total)]])
        dist = np.minimum(dist, ((x - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        own = (((centres ** 2).sum(1) - 2 * x @ centres.T)).argmin(1)
        centres = np.stack([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
    return own


def build(sample: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, seed: int = 5) -> Tree:
    """The tree of a sample; rows that are all equal make one leaf."""
    rng = np.random.default_rng(seed)
    centres, children, leaf_of, leaves = [sample.mean(0)], [()], [-1], 0
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        own = _kmeans(sample[rows], branch, rng) if len(rows) > leaf_rows else np.zeros(len(rows), int)
        groups = [rows[own == c] for c in np.unique(own)]
        if len(groups) < 2:
            leaf_of[node], leaves = leaves, leaves + 1
            continue
        ids = []
        for g in groups:
            ids.append(len(centres))
            centres.append(sample[g].mean(0))
            children.append(())
            leaf_of.append(-1)
            todo.append((ids[-1], g))
        children[node] = tuple(ids)
    return Tree(np.array(centres), tuple(children), tuple(leaf_of))


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of every row: down the nearest centres."""
    out = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        kids = tree.children[node]
        if not kids:
            out[rows] = tree.leaf_of[node]
        elif len(rows):
            c = tree.centres[list(kids)]
            own = ((c ** 2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
            todo += [(kid, rows[own == k]) for k, kid in enumerate(kids)]
    return out


def visit_order(tree: Tree, q: np.ndarray, visits: int, counts: dict[int, int] | None = None, need: int = 0) -> list[int]:
    """The first leaves of a query, best bin first; more than ``visits`` as long
    as those so far hold fewer than ``need`` entries (``counts`` by leaf)."""
    near = tree.centres @ q
    heap, out, held = [(-near[0], 0)], [], 0
    while heap and (len(out) < visits or held < need):
        _, node = heapq.heappop(heap)
        if tree.leaf_of[node] >= 0:
            out.append(tree.leaf_of[node])
            held += counts.get(out[-1], 0) if counts else 0
        for kid in tree.children[node]:
            heapq.heappush(heap, (-near[kid], kid))
    return out


# -- rows

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, doubles as bytes) of the vectors that take part."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i is None or not v or None in v:
                continue
            a = np.array(v, np.float64) + 0.0  # no negative zeros: equal vectors have equal bytes
            if np.isfinite(a).all() and a.any():
                ids.append(i)
                out.append(a.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "v"])


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col)).reshape(len(col), -1)


def exact_dot(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, rounded once: the same whatever the order of work."""
    return math.fsum((a * b).tolist())


def _best(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int,
          seen: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, list[float]]]:
    """Per query its k best rows of x by (exact score, smallest id), of those it has seen."""
    rough = q @ x.T
    scale = 1e-12 * np.maximum(1.0, np.abs(rough).max(1))
    if seen is not None:
        rough[~seen] = -np.inf
    for i, r in enumerate(rough):
        near = np.flatnonzero(r >= np.partition(r, -k)[-k] - scale[i]) if len(r) > k else np.arange(len(r))
        near = near[r[near] > -np.inf]
        s = np.array([exact_dot(q[i], x[j]) for j in near])
        top = np.lexsort((first[near], -s))[:k]
        yield i, near[top], s[top].tolist()


def _scan(k: int):
    """One block of vectors against one block of queries, each with the leaves it visits."""
    def scan(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        q, rep, score = [], [], []
        if len(vectors) and len(queries):
            x, first = _matrix(vectors["v"]), vectors["rep"].to_numpy()
            leaves, own = np.unique(vectors["leaf"].to_numpy(), return_inverse=True)
            for at in range(0, len(queries), 256):
                part = queries.iloc[at:at + 256]
                ids, open_ = part["q"].to_numpy(), np.stack([np.isin(leaves, v) for v in part["leaves"]])
                for i, rows, scores in _best(_matrix(part["qv"]), x, first, k, open_[:, own]):
                    q += [ids[i]] * len(rows)
                    rep += first[rows].tolist()
                    score += scores
        return pd.DataFrame({"q": np.array(q, np.int64), "rep": np.array(rep, np.int64), "score": np.array(score, float)})
    return scan


def blocks_of(counts: dict[int, int], n_leaves: int) -> list[tuple[int, int]]:
    """For each leaf its first block and its number of blocks: small leaves
    that follow each other share one, large ones are cut."""
    out, block, held = [], -1, BLOCK
    for leaf in range(n_leaves):
        n = counts.get(leaf, 0)
        if n > BLOCK:
            parts = -(-n // BLOCK)
            out.append((block + 1, parts))
            block, held = block + parts, BLOCK
            continue
        if held + n > BLOCK:
            block, held = block + 1, 0
        held += n
        out.append((block, 1))
    return out


def _top(df: DataFrame, by: str, k: int, *order) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def search(vectors: DataFrame, queries: str, k: int = K, recall: float = RECALL, fit_rows: int = FIT_ROWS,
           vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query, nearest first: query_id, rank,
    vec_id, score.  ``queries`` is a condition on ``vec_id``.

    Nearness is the inner product of the original vectors, in doubles; ties go
    to the smaller id.  A query is no candidate of its own.  Every query gets ``k``
    rows, or all candidates if they are fewer.  Null and zero vectors
    and those with null or non-finite components take no part, nor do rows without
    id or of another length than most vectors (of equal counts the longer).  Rows
    that share an id are candidates each by their own vector.  No vectors, no rows."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    rows = written(rows.mapInArrow(_packed, "vec_id long, v binary"), "vectors")
    size = rows.groupBy(F.length("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.length("v") == size["n"])
    # equal vectors: one entry, with the ids that a list of k besides the query can hold
    entries = written(_top(rows.distinct(), "v", k + 1, "vec_id").groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")).select("v", "ids", F.col("ids")[0].alias("rep")), "entries")
    n = entries.count()
    asked = rows.where(queries).join(entries.select("v", "rep"), "v").select(F.col("vec_id").alias("query_id"), "rep", "v")
    asked = written(asked, "queries")
    distinct = asked.groupBy(F.col("rep").alias("q")).agg(F.first("v").alias("qv"))

    by_hash = F.xxhash64("rep", F.lit(3))
    sample = entries.where(F.pmod(by_hash, F.lit(1_000_000)) < 1_000_000 * min(1.0, fit_rows / n)).select("v", "rep")
    picked = sample.toArrow().sort_by("rep").column("v").to_pylist() or [entries.orderBy("rep").first()["v"]]
    tree = build(_matrix(picked))
    sent = vectors.sparkSession.sparkContext.broadcast(tree)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = leaves_of(sent.value, _matrix(b.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], ["v", "rep", "leaf"])

    index = written(entries.select("v", "rep").mapInArrow(placed, "v binary, rep long, leaf long"), "index")
    visits = calibrate(index, distinct, tree, k, recall)

    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # at most the tree's leaves
    blocks = blocks_of(counts, tree.n_leaves)
    need = k + 1  # entries in a query's leaves, its own among them

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, qs, at, leaves = [], [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_block: dict[int, list[int]] = {}
                for leaf in visit_order(sent.value, np.frombuffer(v), visits, counts, need):
                    first, n = blocks[leaf]
                    for block in range(first, first + n):
                        by_block.setdefault(block, []).append(leaf)
                for block, found in by_block.items():
                    ids.append(i)
                    qs.append(v)
                    at.append(block)
                    leaves.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(qs, pa.binary()), pa.array(at, pa.int64()),
                                              pa.array(leaves, pa.list_(pa.int64()))], ["q", "qv", "block", "leaves"])

    going = written(distinct.select("q", "qv").mapInArrow(visiting, "q long, qv binary, block long, leaves array<long>"), "visits")
    leaf_rows = vectors.sparkSession.createDataFrame([(leaf, *x) for leaf, x in enumerate(blocks)], "leaf long, first long, n long")
    x = (index.join(F.broadcast(leaf_rows), "leaf")
         .withColumn("block", F.col("first") + F.pmod(F.xxhash64("rep"), F.col("n"))).drop("first", "n"))
    # as many query blocks as the queries of a block need
    asked_of = going.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("qs"))
    x = x.join(asked_of, "block").withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs") - 1)))
    q = going.join(asked_of, "block").withColumn("qb", F.pmod(F.xxhash64("q"), F.col("qs")))
    found = (x.select("block", "qb", "rep", "v", "leaf").groupBy("block", "qb")
             .cogroup(q.select("block", "qb", "q", "qv", "leaves").groupBy("block", "qb"))
             .applyInPandas(_scan(k + 1), "q long, rep long, score double"))
    best = _top(found, "q", k + 1, F.desc("score"), "rep")
    lists = best.join(entries.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    lists = written(_top(lists, "q", k + 1, F.desc("score"), "vec_id").groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l")), "found")
    got = asked.join(lists, asked["rep"] == lists["q"]).select(
        "query_id", F.slice(F.filter("l", lambda e: e["vec_id"] != F.col("query_id")), 1, k).alias("l"))
    return got.select("query_id", F.posexplode("l").alias("p", "e")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"),
        (-F.col("e.s")).alias("score"))


def calibrate(index: DataFrame, queries: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """The visits at which the leaves hold the wanted share of the true
    neighbours of CALIBRATION queries, found exactly in blocks of all vectors."""
    some = queries.orderBy(F.xxhash64("q", F.lit(11)), "q").limit(CALIBRATION).toArrow().to_pydict()
    if not some["q"]:
        return 1
    ids, qv = np.array(some["q"]), _matrix(some["qv"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, rep, leaf = _matrix(b.column(0).to_pylist()), b.column(1).to_numpy(), b.column(2).to_numpy()
                got = [(ids[i], s, rep[r], leaf[r]) for i, rows, scores in _best(qv, x, rep, k + 1)
                       for r, s in zip(rows, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*got, strict=True), (pa.int64(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                    ["q", "score", "rep", "leaf"])

    true = _top(index.mapInArrow(exact, "q long, score double, rep long, leaf long").where("q <> rep"), "q", k,
                F.desc("score"), "rep").toArrow().to_pydict()  # CALIBRATION * k rows
    places = {i: {leaf: p for p, leaf in enumerate(visit_order(tree, v, tree.n_leaves))} for i, v in zip(ids, qv, strict=True)}
    at = np.array([places[i][leaf] for i, leaf in zip(true["q"], true["leaf"], strict=True)])
    visits = 1
    while visits < tree.n_leaves and len(at) and (at < visits).mean() < recall:
        visits += max(1, visits // 8)
    return min(visits, tree.n_leaves)
