"""Merkle manifest of a data set: a SHA midstate tree over each source.

Leaves are digests of whole rows.  In every source they stand in doc_id order;
runs of three nodes are hashed to a parent until one node, the subroot, remains,
and the subroots, in source order, are hashed to the root in the same way.

A parent keeps a copy of its hash state from before each child slot.  Folding a
replaced node takes the copy of its slot and adds the replacement and the
siblings to its right only; what stands to the left is in the state already.

A tree is cut into blocks of 3^7 nodes.  A block is hashed in one task, which
holds its states; the block roots are the nodes of the next, 2187 times smaller
table, until a source has one node.  On the way back down every block gets one
row, the path above its root, ahead of its own nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running
from .storage import written

FAN, DEPTH = 3, 7
BLOCK = FAN ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:string,right:string>>"
NODES = "grp string, idx long, key string, digest string, revised string"
UNDER = f"grp string, idx long, key string, digest string, folded string, top string, path {PATH}"
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


# -- rows to leaves

def field(value: Column) -> Column:
    """A value as hashed: its UTF-8 byte count, a colon and itself; ``-`` for null."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*values: Column) -> Column:
    """SHA-256, in lowercase hex, of the values' fields."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


# -- one block

class Block:
    """A subtree held in a task: every level's nodes, and before each of them
    the hash state of its parent."""

    def __init__(self, nodes: list[bytes], levels: int):
        self.levels: list[tuple[list[bytes], list]] = []
        for _ in range(levels):
            states, parents = [], []
            for at in range(0, len(nodes), FAN):
                parent = sha256()
                for child in nodes[at:at + FAN]:
                    states.append(parent.copy())
                    parent.update(child)
                parents.append(parent.hexdigest().encode())
            self.levels.append((nodes, states))
            nodes = parents
        self.root = nodes[0]

    def path(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """The siblings before and after node ``at`` and each node above it, joined."""
        for nodes, _ in self.levels:
            first = at - at % FAN
            yield b"".join(nodes[first:at]), b"".join(nodes[at + 1:first + FAN])
            at //= FAN

    def fold(self, at: int, node: bytes) -> bytes:
        """The block's root with ``node`` in place ``at``."""
        for nodes, states in self.levels:
            parent = states[at].copy()
            parent.update(node)
            for sibling in nodes[at + 1:at - at % FAN + FAN]:
                parent.update(sibling)
            node = parent.hexdigest().encode()
            at //= FAN
        return node


class Above:
    """The path over a block's root: the states before the path's slots, made
    once for the block, and the siblings that follow."""

    def __init__(self, path: list[tuple[bytes, bytes]]):
        self.path = path
        self.steps = [(sha256(left), right) for left, right in path]

    def fold(self, node: bytes) -> bytes:
        for state, right in self.steps:
            parent = state.copy()
            parent.update(node)
            parent.update(right)
            node = parent.hexdigest().encode()
        return node


def block_levels(block: int, n: int) -> int:
    """Levels to hash a block of ``n`` nodes: all, unless it is the only block
    of its tree, which ends as soon as one node remains."""
    if block:
        return DEPTH
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


# -- tables of blocks

def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[tuple]]]:
    """The rows of each (grp, block), which come in order and are at most a block and its path."""
    now, rows = None, []
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        for row in zip(*cols):
            if (key := row[:2]) != now:
                if rows:
                    yield *now, rows
                now, rows = key, []
            rows.append(row[2:])
    if rows:
        yield *now, rows


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["grp", "idx", "key", "digest", "revised"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for grp, block, rows in _runs(batches):
        tree = Block([r[1].encode() for r in rows], block_levels(block, len(rows)))
        out.append((grp, block, None, tree.root.decode(), None))
        if len(out) == 4096:
            yield batch()
            out = []
    if out:
        yield batch()


def _under(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for grp, block, rows in _runs(batches):
        (_, _, _, _, top, path), nodes = rows[0], rows[1:]
        above = Above([(s["left"].encode(), s["right"].encode()) for s in path])
        tree = Block([r[2].encode() for r in nodes], block_levels(block, len(nodes)))
        folded, steps, ends = [], [], [0]
        for at, (_, _, digest, revised, _, _) in enumerate(nodes):
            folded.append(above.fold(tree.fold(at, (revised or digest).encode())).decode())
            steps.extend(chain(tree.path(at), above.path))
            ends.append(len(steps))
        pairs = pa.StructArray.from_arrays([pa.array([s[k].decode() for s in steps], pa.string()) for k in (0, 1)], fields=list(_STEP))
        text = [pa.array([r[k] for r in nodes], pa.string()) for k in (1, 2)]
        n = len(nodes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([grp] * n), pa.array([r[0] for r in nodes], pa.int64()), *text, pa.array(folded),
             pa.array([top] * n, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)],
            names=["grp", "idx", "key", "digest", "folded", "top", "path"])


def _block(idx: str = "idx") -> Column:
    return F.expr(f"{idx} div {BLOCK}").alias("block")


def _laid(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")


def grow(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The tables of a forest: ``leaves`` (columns of NODES, idx counted from 0
    in each grp), the roots of its blocks, theirs, and so on to one node a grp."""
    tables = [leaves]
    n = (leaves.agg(F.max("idx")).first()[0] or 0) + 1
    while n > 1 or len(tables) == 1:
        rows = _laid(tables[-1].select("grp", _block(), "key", "digest", "idx")).select("grp", "block", "key", "digest")
        tables.append(written(rows.mapInArrow(_roots, NODES), name))
        n = -(-n // BLOCK)
    return tables


def descend(tables: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """The leaves of a forest with the paths to what lies above its trees, and
    what each, or its revision, folds to.  ``tops``: grp, top, path of each tree."""
    heads = tops.select("grp", F.lit(0).cast("long").alias("idx"), "top", "path")
    for nodes in reversed(tables[:-1]):
        none = F.lit(None).cast("string")
        rows = nodes.select("grp", _block(), "idx", "key", "digest", "revised", none.alias("top"), F.lit(None).cast(PATH).alias("path"))
        rows = rows.unionAll(heads.select("grp", F.col("idx").alias("block"), F.lit(-1).cast("long"), none, none, none, "top", "path"))
        heads = written(_laid(rows).mapInArrow(_under, UNDER), name)
    return heads


def seal(docs: DataFrame, revised: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, proof, folded_root.

    ``proof`` lists, from the leaf to the root, the joined digests of the
    siblings before and after; ``folded_root`` is what the leaf leads to by
    it, with ``revised``, a text column, in place of the text if one is given.
    A null doc_id, source or field is a value of its own (it comes first);
    rows that share a doc_id stand in the order of their leaves; equal rows are leaves of
    their own.  An empty table gives no rows.  Texts are hashed whole where they
    are read and not moved.  Other columns are ignored, whatever their names."""
    docs = docs.select(*FIELDS, (F.col("text") if revised is None else revised).alias("_new"))
    leaf = leaf_digest(*(F.col(c) for c in FIELDS))
    new = leaf_digest(*(F.col(c) for c in FIELDS[:-1]), F.col("_new"))
    rows = docs.select(
        # '' for null, so it sorts first and apart from the empty source
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf.alias("digest"), F.when(~F.col("_new").eqNullSafe(F.col("text")), new).alias("revised"), F.lit(1).alias("one"),
        F.monotonically_increasing_id().alias("salt"))  # splits a run of equal rows
    ranked = running(rows, ["doc_id", "digest", "salt"], "one", "grp", "merkle-leaves")
    leaves = written(ranked.select("grp", F.col("_row").alias("idx"), F.col("doc_id").cast("string").alias("key"),
                                   "digest", "revised"), "merkle-ranked")
    trees = grow(leaves, "merkle-nodes")
    ranked = running(trees[-1].select("grp", "digest", F.lit(1).alias("one")), ["grp"], "one", name="merkle-sources")
    sources = ranked.select(F.lit("").alias("grp"), F.col("_row").alias("idx"), F.col("grp").alias("key"), "digest",
                            F.lit(None).cast("string").alias("revised"))
    over = grow(written(sources, "merkle-subroots"), "merkle-over")
    root = over[-1].first()
    root = F.lit(root["digest"] if root else None).cast("string")
    tops = over[-1].select("grp", root.alias("top"), F.expr(f"cast(array() as {PATH})").alias("path"))
    subroots = descend(over, tops, "merkle-tops").select(F.col("key").alias("grp"), F.col("digest").alias("top"), "path")
    under = descend(trees, subroots, "merkle-proofs")
    return under.select(F.col("key").cast("long").alias("doc_id"), F.expr("substr(grp, 2)").alias("_s"), "grp",
                        F.col("digest").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"),
                        F.col("path").alias("proof"), F.col("folded").alias("folded_root")).select(
        "doc_id", F.when(F.col("grp") != "", F.col("_s")).alias("source"), "leaf", "subroot", "root", "proof", "folded_root")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
