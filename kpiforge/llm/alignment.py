"""Alignment of two tokenizers on the same texts, each distinct text once.

Documents are shuffled by their whole text and a text that many share is one
row with its multiplicity.  Both tokenizers cut the text's bytes; the offsets at
which tokens of both end cut it into groups, and the tokens of a group are
linked.  A text's distinct linked id pairs are counted with its multiplicity,
which gives in how many documents a pair is linked.  The most frequent pairs, a
fixed number, are broadcast to look up nearly all links where they are; the
links of rarer pairs are joined to their counts.  The measures of a text are
joined to the ids of its documents by SHA-256; those of a text that a
thousandth of all documents share, a thousand texts at most, are broadcast.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encoder, per_slice
from .storage import written

# Pairs broadcast with their counts at most, and the share of all documents from which a text counts as hot
HOT_PAIRS, HOT_SHARE = 200_000, 1000
# Linked occurrences expanded at a time
STEP = 1 << 21

ALIGNED = "struct<n_a:long,n_b:long,n_groups:long,n_links:long,groups:string,links:array<struct<pair:long,n:long>>>"
_LINK = pa.struct([("pair", pa.int64()), ("n", pa.int64())])
_ALIGNED = pa.struct([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("groups", pa.string()), ("links", pa.list_(_LINK))])
SHIFT = 32


# -- the two tokenizers

def load(path: str) -> bytes:
    """The content of a piece model file that the driver can open."""
    with open(path, "rb") as f:
        return f.read()


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece: a byte piece's byte, else its text with
    U+2581 as space."""
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]


@cache
def _aligner(bpe: str, model: bytes) -> Aligner:
    return Aligner(bpe, model)


class Aligner:
    """Tokens, groups and links of texts under a byte-level BPE file's content
    (A) and a piece model's (B)."""

    def __init__(self, bpe: str, model: bytes):
        self._a, self._b = encoder(bpe), sentencepiece.SentencePieceProcessor(model_proto=model)
        self._bytes = self._a.token_bytes, piece_bytes(self._b)
        self._lengths = [np.array([len(b) for b in t], np.int64) for t in self._bytes]
        # an id's decimal text before the next one of its side, of the other side, and of the next group
        self._text = [np.array([f"{i}{mark}" for i in range(len(t)) for mark in marks], object)
                      for t, marks in zip(self._bytes, (",|", ",;"))]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A and B ids of a space and the text; none where they don't spell it."""
        a = self._a.encode([" " + t for t in texts])
        b = self._b.encode(texts, num_threads=1)
        out = []
        for text, pair in zip(texts, zip(a, b)):
            whole = b" " + text.encode()
            if not text or any(b"".join(map(table.__getitem__, ids)) != whole for table, ids in zip(self._bytes, pair)):
                pair = [], []
            out.append(tuple(np.array(ids, np.int64) for ids in pair))
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> dict:
        """Groups and links of one text's ids: the groups as text, and how
        often each distinct pair (A's id shifted, plus B's) is linked."""
        if not len(a):
            return {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "links": []}
        ends = [np.cumsum(t[ids]) for t, ids in zip(self._lengths, (a, b))]
        common = np.intersect1d(*ends, assume_unique=True)
        ga, gb = (np.searchsorted(common, e) for e in ends)
        na, nb = (np.bincount(g, minlength=len(common)) for g in (ga, gb))
        pairs, times = linked(a, b, na, nb)
        return {"n_a": len(a), "n_b": len(b), "n_groups": len(common), "n_links": int((na * nb).sum()),
                "groups": self._groups(a, b, ga, gb, na, nb), "links": (pairs, times)}

    def _groups(self, a, b, ga, gb, na, nb) -> str:
        """a1,a2|b1;a3|b2,b3"""
        out = np.empty(len(a) + len(b), object)
        before_a, before_b = np.cumsum(na), np.cumsum(nb) - nb
        last_a, last_b = np.append(ga[1:] != ga[:-1], True), np.append(gb[1:] != gb[:-1], True)
        out[np.arange(len(a)) + before_b[ga]] = self._text[0][2 * a + last_a]
        out[np.arange(len(b)) + before_a[gb]] = self._text[1][2 * b + last_b]
        return "".join(out.tolist())[:-1]

    def __call__(self, texts: list[str]) -> pa.Array:
        got = [self.align(a, b) for a, b in self.encode(texts)]
        cols = [pa.array([g[f.name] for g in got], f.type) for f in list(_ALIGNED)[:5]]
        flat = [np.concatenate([g["links"][k] for g in got if g["n_a"]] or [np.zeros(0, np.int64)]) for k in (0, 1)]
        ends = np.cumsum([0] + [len(g["links"][0]) if g["n_a"] else 0 for g in got])
        links = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(f, pa.int64()) for f in flat], fields=list(_LINK)))
        return pa.StructArray.from_arrays([*cols, links], fields=list(_ALIGNED))


def linked(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs that groups of ``na`` and ``nb`` tokens link, and
    how often each is.  Groups are expanded in steps of bounded size; a large
    one by its distinct ids."""
    size, start_a, start_b = na * nb, np.cumsum(na) - na, np.cumsum(nb) - nb
    pairs, times = [], []

    def add(p: np.ndarray, n: np.ndarray) -> None:
        keys, at = np.unique(p, return_inverse=True)
        pairs.append(keys)
        times.append(np.bincount(at, n).astype(np.int64) if len(keys) else np.zeros(0, np.int64))

    for g in np.flatnonzero(size > STEP).tolist():
        ids_a, n_a = np.unique(a[start_a[g]:start_a[g] + na[g]], return_counts=True)
        ids_b, n_b = np.unique(b[start_b[g]:start_b[g] + nb[g]], return_counts=True)
        pairs.append(((ids_a << SHIFT)[:, None] + ids_b).ravel())
        times.append((n_a[:, None] * n_b).ravel())
    rest = np.flatnonzero(size <= STEP)
    steps = np.cumsum(size[rest]) // STEP
    for groups in np.split(rest, np.flatnonzero(steps[1:] != steps[:-1]) + 1):
        n, m = na[groups], nb[groups]
        # each A token of the groups, once for each B token of its group
        tokens = np.repeat(start_a[groups] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        times_b, from_b = np.repeat(m, n), np.repeat(start_b[groups], n)
        left = np.repeat(a[tokens], times_b)
        right = b[np.repeat(from_b - (np.cumsum(times_b) - times_b), times_b) + np.arange(times_b.sum())]
        p = (left << SHIFT) + right
        add(p, np.ones(len(p)))
    if len(pairs) > 1:
        p, n = np.concatenate(pairs), np.concatenate(times)
        keys, at = np.unique(p, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, n)
        return keys, total
    return pairs[0], times[0]


def aligned(spark: SparkSession, bpe: str, model: bytes):
    """A column function: ALIGNED of a text.  Both files' contents are
    broadcast; their sizes are those of the vocabularies."""
    sent = spark.sparkContext.broadcast((bpe, model))
    return per_slice(lambda: _aligner(*sent.value), ALIGNED)


# -- the corpus

def distinct_texts(docs: DataFrame) -> DataFrame:
    """text, n_docs of every distinct text, null and empty ones left out."""
    return docs.where(F.col("text") != "").groupBy("text").agg(F.count(F.lit(1)).alias("n_docs"))


def align_texts(docs: DataFrame, bpe: str, model: bytes, with_groups: bool = False) -> DataFrame:
    """A written row per distinct text: tid, digest (SHA-256 of the text),
    n_docs, n_a, n_b, n_groups, n_links, groups_sha256, links; with the groups'
    text as well if asked for.  Texts that the tokens don't spell have none."""
    align = aligned(docs.sparkSession, bpe, model)
    rows = distinct_texts(docs).select("text", "n_docs", align(F.col("text")).alias("g"))
    return written(rows.select(
        F.monotonically_increasing_id().alias("tid"), F.sha2("text", 256).alias("digest"), "n_docs", "g.n_a", "g.n_b", "g.n_groups",
        "g.n_links", F.when(F.col("g.groups") != "", F.sha2("g.groups", 256)).otherwise("").alias("groups_sha256"),
        *(["g.groups"] if with_groups else []), "g.links"), "aligned-texts")


def pair_counts(texts: DataFrame) -> DataFrame:
    """A written row per linked pair: pair, count (documents that link it),
    and whether that is the highest of its A id."""
    counts = texts.select("n_docs", F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.sum("n_docs").alias("count"))
    counts = written(counts, "pair-counts")
    id_a = F.shiftright("pair", SHIFT)
    # at most one row per id of the vocabulary
    best = counts.groupBy(id_a.alias("a")).agg(F.max("count").alias("most"))
    return written(counts.join(F.broadcast(best), id_a == F.col("a"))
                   .select("pair", "count", (F.col("count") == F.col("most")).alias("is_best")), "pair-table")


def link_sums(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """tid, n_best, count_sum of every text with links."""
    # classes of counts, a few hundred at most; the highest ones that hold HOT_PAIRS pairs at most
    rank = F.floor(F.log2("count") * 8)
    held, cut = 0, None
    for row in pairs.groupBy(rank.alias("rank")).count().orderBy(F.col("rank").desc()).collect():
        if held + row["count"] > HOT_PAIRS:
            break
        held, cut = held + row["count"], row["rank"]
    is_hot = F.lit(False) if cut is None else rank >= cut
    links = texts.select("tid", F.inline("links")).join(F.broadcast(pairs.where(is_hot)), "pair", "left")
    sums = [F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    known = links.where(F.col("count").isNotNull()).groupBy("tid").agg(*sums)
    rare = pairs.where(~is_hot)
    if rare.isEmpty():
        return known
    other = links.where(F.col("count").isNull()).select("tid", "pair", "n").join(rare, "pair").groupBy("tid").agg(*sums)
    return known.unionAll(other).groupBy("tid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, bpe: str, model: bytes) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    Null and empty texts, and those whose tokens don't spell them, have zeros and
    ''.  Long texts are taken whole.  Rows that repeat a doc_id or a text are documents
    each; a null doc_id is kept; ties for an id's highest count all count; an
    empty table gives no rows; other columns are ignored, whatever their names."""
    texts = align_texts(docs, bpe, model)
    sums = link_sums(texts, pair_counts(texts))
    zero = F.lit(0).cast("long")
    measures = written(texts.drop("links").join(sums, "tid", "left").select(
        "digest", "n_docs", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"), "text-measures")
    ids = written(docs.select("doc_id", F.when(F.col("text") != "", F.sha2("text", 256)).alias("digest")), "doc-digests")
    shared = (measures.agg(F.sum("n_docs")).first()[0] or 0) / HOT_SHARE
    names = [c for c in measures.columns if c not in ("digest", "n_docs")]
    is_hot = F.col("n_docs") > shared  # fewer than HOT_SHARE texts
    hot = F.broadcast(measures.where(is_hot).drop("n_docs").withColumn("_hot", F.lit(True)))
    near = ids.join(hot, "digest", "left")
    rest = near.where(F.col("_hot").isNull()).select("doc_id", "digest")
    # documents without a text have no digest: kept out of the shuffle's keys
    bare = rest.where(F.col("digest").isNull())
    far = rest.where(F.col("digest").isNotNull()).join(measures.where(~is_hot).drop("n_docs"), "digest")
    empty = [F.lit("").alias(c) if c == "groups_sha256" else zero.alias(c) for c in names]
    return (near.where("_hot").select("doc_id", *names).unionAll(far.select("doc_id", *names))
            .unionAll(bare.select("doc_id", *empty)))
