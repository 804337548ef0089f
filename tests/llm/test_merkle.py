"""The Merkle manifest against a plain recursion, and folding against rebuilding."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from kpiforge.llm import merkle
from kpiforge.llm.queries import op12_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc):
    i, text, lang, source, n = doc
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def climb(nodes):
    """The root over ``nodes`` and every node's list of (left, right) siblings."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, place):
            first = at - at % 3
            path.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])))
        nodes = [h(*nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
        place = [at // 3 for at in place]
    return nodes[0], paths


def brute(docs, lost=lambda doc: doc):
    groups = {}
    for doc in docs:
        groups.setdefault(doc[3], []).append(doc)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        rows = sorted(groups[name], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[name] = rows, *climb([leaf(d) for d in rows])
    root, over = climb([trees[n][1] for n in names]) if names else (None, [])
    out = []
    for name, above in zip(names, over):
        rows, subroot, paths = trees[name]
        for doc, path in zip(rows, paths):
            path, folded = path + above, leaf(lost(doc))
            for left, right in path:
                folded = h(left, folded, right)
            out.append((doc[0], leaf(doc), subroot, root, h(*(x for p in path for x in p)), folded, folded == root))
    return sorted(out, key=str)


def tamper(doc):
    i, text, *rest = doc
    if i is None or text is None or zlib.crc32(str(i).encode()) % 2:
        return doc
    return i, text.replace("\n", ""), *rest


def digest_rows(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")), "folded_root",
        F.col("folded_root") == F.col("root")).collect()), key=str)


def check(spark, docs, tampered=False):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(docs)], SCHEMA + ", grp long")
    lost = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    assert digest_rows(merkle.seal(df, lost if tampered else None)) == brute(docs, tamper if tampered else lambda d: d)


def test_several_blocks_levels_and_sources(spark, monkeypatch):
    rnd = random.Random(5)
    docs = [(i, f"text {i}\n" * rnd.randint(0, 3), "en", f"s{min(rnd.randint(0, 40), rnd.randint(0, 40), rnd.randint(0, 40))}", i) for i in range(5000)]
    docs += [(i, "one source\nin three blocks", "de", "hot", 1) for i in range(5000, 10_000)]
    check(spark, docs, tampered=True)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 2186, 2187, 2188])
def test_sizes_at_the_edges_of_a_block(spark, n):
    check(spark, [(i, "x", None, "a", None) for i in range(n)])


def test_nulls_empty_ties_and_repeated_rows(spark):
    docs = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (1, None, "", "", 0), (1, "b\n", "en", None, 2),
            (2, "é\n" * 50_000, "fr", "ü", 3), (2, "é\n" * 50_000, "fr", "ü", 3), (3, "x", "en", "None", -1), (-4, "y\ny", "en", "z", 5)]
    check(spark, docs, tampered=True)


def test_a_third_of_all_rows_equal(spark):
    check(spark, [(7, "same", "en", "s", 4)] * 700 + [(i, "t", "en", "s", 1) for i in range(1400)])


def test_no_rows(spark):
    got = merkle.seal(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof", "folded_root"]


def test_folding_resumes_the_state_of_a_slot():
    nodes = [h(str(i)).encode() for i in range(20)]
    tree = merkle.Block(nodes, merkle.block_levels(0, 20))
    for at in range(20):
        changed = nodes[:at] + [b"0" * 64] + nodes[at + 1:]
        assert tree.fold(at, b"0" * 64) == merkle.Block(changed, merkle.block_levels(0, 20)).root
        assert tree.fold(at, nodes[at]) == tree.root


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = op12_merkle(spark, d)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, tamper)
