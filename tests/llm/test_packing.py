"""Packing: every piece whole and once, few sequences, and the genetic steps."""

import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpiforge.llm import packing
from kpiforge.llm.byte_bpe import load
from kpiforge.llm.queries import BYTE_FILE, op13_packing


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE_FILE)
    t.encode_special_tokens = True
    return t


def check_pieces(docs, rows, library, capacity):
    """Each document's pieces are its ids in order, only the first one short."""
    want = []
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or min(len(ids), capacity)
        cut = [ids[:first]] + [ids[k:k + capacity] for k in range(first, len(ids), capacity)]
        at = 0
        for k, piece in enumerate(cut):
            want.append((doc_id, k, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
            at += len(piece)
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)


def check_sequences(rows, capacity):
    """Sequences are gapless from 0 and within the capacity; their number."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        spans.sort()
        ends = np.cumsum([n for _, n in spans])
        assert [o for o, _ in spans] == [0, *ends[:-1]] and ends[-1] <= capacity
    return len(by)


def pack_lengths(spark, lengths, capacity):
    cut = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    rows = packing.pack(cut, capacity).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == list(enumerate(lengths))
    return check_sequences(rows, capacity)


def test_query(spark, library):
    d = "/root/testdata/sf0.01"
    got = op13_packing(spark, d)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    check_pieces([tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()], rows, library, 2048)
    lengths = np.array([r["length"] for r in rows])
    assert check_sequences(rows, 2048) == packing.least_bins(lengths, np.ones(len(lengths), np.int64), 2048)


def test_nulls_empty_long_and_repeated_rows(spark, library):
    docs = [(None, None), (1, ""), (1, ""), (2, "word " * 30_000), (3, None), (4, "<|endoftext|> é🎉\n"), (5, "a" * 20_000), (5, "b"), (None, "b")]
    df = spark.createDataFrame([(i, t, 9, "x") for i, t in docs], "doc_id long, text string, length int, bin string")
    rows = packing.pack_documents(df, load(BYTE_FILE), 64).collect()
    check_pieces(docs, rows, library, 64)
    check_sequences(rows, 64)
    assert packing.pack_documents(df.limit(0), load(BYTE_FILE)).collect() == []


def test_ids_equal_the_library_on_every_kind_of_text(library):
    from kpiforge.llm.byte_bpe import encoder
    rnd = random.Random(2)
    kinds = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isprintable() or c.isspace()]
    texts = ["".join(rnd.choices(kinds, k=60)) for _ in range(300)] + ["", " ", "a  b \n\t c", "'s don't 'LL we'll", "<|endoftext|>x"]
    texts += ["".join(rnd.choices("etaoin shrdlu\n .,'", k=300)) for _ in range(300)]
    bpe = encoder(load(BYTE_FILE))
    ids = bpe.encode(texts)
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [b"".join(bpe.token_bytes[i] for i in x) for x in ids] == [t.encode() for t in texts]


def test_a_file_whose_merges_are_out_of_order_is_encoded_by_its_library():
    import json
    from kpiforge.llm.byte_bpe import ByteBpe
    letters = {c: i for i, c in enumerate("abc")}
    file = {"version": "1.0", "added_tokens": [], "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
            "model": {"type": "BPE", "vocab": letters | {"ab": 4, "bc": 3}, "merges": [["a", "b"], ["b", "c"]]}}
    bpe = ByteBpe(json.dumps(file))
    assert bpe.encode(["abc", "bca"]) == [[4, 2], [3, 0]]


def test_ids_as_arrays_and_runs_of_whitespace(library):
    from kpiforge.llm.byte_bpe import NO_TOKEN, encoder
    rnd = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u2003", "\x1c", "\x85", "a", "é", "1", "'s", "'ll", "'LL", "...", NO_TOKEN, "<|endoftext|>"]
    texts = ["".join(rnd.choices(parts, k=40)) for _ in range(3000)] + ["", NO_TOKEN, "é" + NO_TOKEN * 3, " " * 50_000 + "x", "\n " * 20_000]
    bpe = encoder(load(BYTE_FILE))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    got = list(bpe.arrays(texts))
    assert all(a.dtype == np.uint32 for a in got) and [a.tolist() for a in got] == want == bpe.encode(texts)


def triplets(n, capacity, rnd):
    """Lengths of three to a bin that fill n bins exactly."""
    out = []
    for _ in range(n):
        a = rnd.randint(capacity * 2 // 5, capacity // 2 - 1)
        b = rnd.randint(capacity // 4, (capacity - a) // 2 + 1)
        out += [a, b, capacity - a - b]
    return out


def test_evolution_beats_best_fit_decreasing():
    rnd, won = random.Random(4), 0
    for seed in range(3):
        sizes = np.array(sorted(triplets(60, 1000, rnd), reverse=True))
        start = packing.first_packing(sizes, 1000)
        elite = []
        for epoch in range(6):
            elite = packing.evolve(sizes, elite, 60, 1000, random.Random(f"{seed}{epoch}"))
        assert (packing.fills(sizes, elite[0]) <= 1000).all() and len(elite[0]) == len(sizes)
        won += start.max() - elite[0].max()
    assert won >= 3


def test_a_child_is_a_packing_that_keeps_injected_bins():
    rnd = random.Random(1)
    sizes = np.array(sorted((rnd.randint(1, 400) for _ in range(300)), reverse=True))
    one, other = packing.first_packing(sizes, 1000), packing.first_packing(sizes, 1000, np.arange(300)[::-1])
    for seed in range(30):
        child = packing.crossover(sizes, one, other, 1000, random.Random(seed))
        fill = packing.fills(sizes, child)
        assert (fill > 0).all() and (fill <= 1000).all() and len(child) == 300
        bins = lambda p: {tuple(np.flatnonzero(p == k)) for k in range(p.max() + 1)}
        assert bins(child) & bins(other)


def test_lower_bound_against_all_packings():
    def fewest(items, room):
        if not items:
            return len(room)
        best = fewest(items[1:], room + [10 - items[0]])
        for k in {r: k for k, r in enumerate(room) if r >= items[0]}.values():
            best = min(best, fewest(items[1:], room[:k] + [room[k] - items[0]] + room[k + 1:]))
        return best

    rnd = random.Random(8)
    for _ in range(60):
        items = sorted((rnd.randint(1, 10) for _ in range(rnd.randint(1, 7))), reverse=True)
        bound = packing.least_bins(np.array(items), np.ones(len(items), np.int64), 10)
        assert -(-sum(items) // 10) <= bound <= fewest(items, [])


def test_several_buckets_reach_nearly_the_fewest_sequences(spark):
    rnd = random.Random(6)
    lengths = [rnd.randint(1, 700) for _ in range(9000)]
    assert pack_lengths(spark, lengths, 1000) <= -(-sum(lengths) // 1000) + 2


@pytest.fixture
def epochs(monkeypatch):
    """For each epoch of islands that ran: its tasks, and the buckets and islands it wrote."""
    seen, written = [], packing.written

    def watch(df, name):
        out = written(df, name)
        if name == "pack-islands":
            seen.append((df.rdd.getNumPartitions(), out.select("bucket", "island", "bins", "bound").collect()))
        return out

    monkeypatch.setattr(packing, "written", watch)
    return seen


def test_buckets_at_their_bound_start_no_islands(spark, epochs):
    assert pack_lengths(spark, [500] * 9000, 1000) == 4500
    assert epochs == []


def test_an_epoch_has_tasks_for_the_buckets_that_go_on_only(spark, epochs, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 30)
    monkeypatch.setattr(packing, "PASSES", 1)
    rnd = random.Random(12)
    # eight buckets: each has every eighth item by length
    pack_lengths(spark, [rnd.randint(150, 480) for _ in range(240)], 1000)
    assert epochs
    for at, (tasks, rows) in enumerate(epochs):
        buckets = {r["bucket"] for r in rows}
        if at:
            best = {}
            for r in epochs[at - 1][1]:
                best[r["bucket"]] = min(best.get(r["bucket"], r["bins"]), r["bins"])
            bound = {r["bucket"]: r["bound"] for r in epochs[at - 1][1]}
            assert buckets == {b for b, n in best.items() if n > bound[b]}
        assert len(buckets) < 8 and tasks == len(rows) == len(buckets) * packing.ISLANDS


def test_one_length_holds_all_rows(spark):
    assert pack_lengths(spark, [400] * 5000 + [1000] * 50, 1000) == 2550


def test_over_long_pieces_are_an_error(spark):
    with pytest.raises(ValueError):
        pack_lengths(spark, [5, 11], 10)


def test_sequences_hold_the_ids(spark, library):
    docs = spark.createDataFrame([(i, f"document number {i} " * (i % 9)) for i in range(40)], "doc_id long, text string")
    packed = packing.pack_documents(docs, load(BYTE_FILE), 32)
    made = {r["sequence_id"]: r["ids"] for r in packing.sequences(docs, packed, load(BYTE_FILE), 32).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in packed.collect():
        ids = (library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [0])[r["start"]:r["start"] + r["length"]]
        assert made[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids
    assert all(len(x) <= 32 for x in made.values())
