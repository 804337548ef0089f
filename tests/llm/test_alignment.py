"""Alignment of two tokenizers against a plain count over all documents."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kpiforge.llm import alignment
from kpiforge.llm.byte_bpe import load
from kpiforge.llm.queries import BYTE_FILE, PIECE_MODEL, op11_alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def files():
    return load(BYTE_FILE), alignment.load(PIECE_MODEL)


@pytest.fixture(scope="module")
def tokens():
    a, b = Tokenizer.from_file(BYTE_FILE), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    a.encode_special_tokens = True

    def byte_of():
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in keep]
        return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(rest)}
    byte = byte_of()

    def both(text):
        x = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            y.append((i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        return x, y
    return both


def groups_of(text, tokens):
    if not text:
        return []
    x, y = tokens(text)
    whole = (" " + text).encode()
    if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
        return []
    out, a, b, at_a, at_b = [], [], [], 0, 0
    x, y = list(x), list(y)
    while x or y:
        if at_a <= at_b:
            i, t = x.pop(0)
            a.append(i)
            at_a += len(t)
        else:
            i, t = y.pop(0)
            b.append(i)
            at_b += len(t)
        if at_a == at_b:
            out.append((a, b))
            a, b = [], []
    return out


def brute(docs, tokens):
    cut = [(i, groups_of(t, tokens)) for i, t in docs]
    counts, best = Counter(), {}
    for _, groups in cut:
        counts.update({(x, y) for a, b in groups for x in a for y in b})
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, groups in cut:
        links = [(x, y) for a, b in groups for x in a for y in b]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    sha256(said.encode()).hexdigest() if said else ""))
    return sorted(out, key=str)


def check(spark, docs, files, tokens):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, pair int, digest string")
    got = alignment.align(df, *files)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, tokens)


ODD = [(None, None), (1, ""), (2, " "), (3, "a  b\n\n c\t"), (4, "▁ is not a space"), (5, "你好 🎉 naïve ﬁ"), (6, "</s> <unk> <0x41> <|endoftext|>"),
       (7, "same text"), (7, "same text"), (8, "same text"), (None, "same text"), (9, "\x00\x01"), (10, "the cat sat " * 400), (11, None)]


def test_odd_rows(spark, files, tokens):
    check(spark, ODD, files, tokens)


def test_rare_pairs_take_the_join(spark, files, tokens, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_PAIRS", 5)
    rnd = random.Random(3)
    docs = [(i, " ".join(rnd.choices(["alpha", "beta", "Überzeugung", "x1", "l'été", "the", "of"], k=rnd.randint(0, 30)))) for i in range(200)]
    check(spark, docs, files, tokens)
    monkeypatch.setattr(alignment, "HOT_PAIRS", 0)
    check(spark, ODD, files, tokens)


def test_no_text_is_hot_and_one_is(spark, files, tokens, monkeypatch):
    docs = [(i, f"document number {i} of many") for i in range(60)] + [(i, "a copy") for i in range(60, 120)]
    check(spark, docs, files, tokens)
    monkeypatch.setattr(alignment, "HOT_SHARE", 3)
    check(spark, docs, files, tokens)


def test_no_rows(spark, files):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), *files).collect() == []


def test_links_in_steps_and_of_large_groups(monkeypatch):
    rnd = np.random.default_rng(1)
    na, nb = rnd.integers(1, 9, 200), rnd.integers(1, 9, 200)
    na[50] = nb[50] = 60
    a, b = rnd.integers(0, 30, na.sum()), rnd.integers(0, 30, nb.sum())
    want, i, j = Counter(), 0, 0
    for n, m in zip(na, nb):
        want.update((int(x) << 32) + int(y) for x in a[i:i + n] for y in b[j:j + m])
        i, j = i + n, j + m
    for step in (1 << 21, 500, 70):
        monkeypatch.setattr(alignment, "STEP", step)
        pairs, times = alignment.linked(a, b, na, nb)
        assert dict(zip(pairs.tolist(), times.tolist())) == want


def test_a_text_of_one_long_group(files):
    aligner = alignment.Aligner(*files)
    a, b = np.arange(20_000) % 7, np.arange(30_000) % 11
    pairs, times = alignment.linked(a, b, np.array([20_000]), np.array([30_000]))
    assert len(pairs) == 77 and times.sum() == 600_000_000
    (x, y), = aligner.encode(["y" * 200_000])
    got = aligner.align(x, y)
    assert got["n_links"] == got["links"][1].sum() and got["n_a"] == len(x)


def test_query(spark, tokens):
    d = "/root/testdata/sf0.01"
    got = op11_alignment(spark, d)
    assert got.columns == COLUMNS
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, tokens)


def test_groups_are_given_as_text(spark, files):
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row, = alignment.align_texts(docs, *files, with_groups=True).collect()
    assert sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count(";") == row["n_groups"] - 1
