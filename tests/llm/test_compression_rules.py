"""Base counts against regular expressions, bands against plain compression."""

import math
import random
import re
from collections import Counter

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiforge.llm import compression_rules as R
from kpiforge.llm.queries import op9_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text)
    seen, covered, dup, lines = Counter(zip(w, w[1:], w[2:])), set(), 0, set()
    for k in range(len(w) - 2):
        if seen[tuple(w[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x0b\x1c\x85\xa0", max_size=60))
def test_counts(text):
    assert R.base_counts(text.encode()) == brute(text)


def ratio(b):
    return len(zstandard.ZstdCompressor(level=R.LEVEL, write_content_size=False, write_checksum=False).compress(b)) / len(b)


def plain_bands(texts):
    """Quartiles and fences of each half octave, from sorted lists."""
    by = {}
    for b in {t.encode() for t in texts if len(t.encode()) >= 128}:
        by.setdefault(math.floor(2 * math.log2(len(b))), []).append(round(1000 * ratio(b)))
    out = []
    for c in range(14, 2 + max([*by, 28])):
        start, x = math.ceil(2 ** (c / 2)), sorted(by.get(c, []))
        low, high = [b for b in R.BANDS if b[0] <= start][-1][1:]
        if len(x) >= 50:
            q1, q2, q3 = (x[math.ceil(q * len(x) / 4) - 1] for q in (1, 2, 3))
            spread = max(q3 - q1, 0.03 * q2)
            low, high = (q1 - 1.5 * spread) / 1000, (q3 + 3.0 * spread) / 1000
        out.append((start, low, high))
    return out


def verdict(text, bands=None):
    """The rules written out plainly."""
    b = text.encode()

    def fits(x):
        band = [band for band in bands or plain_bands([]) if band[0] <= len(x)]
        return not band or band[-1][1] <= ratio(x) <= band[-1][2]

    parts = [b[k:k + R.CHUNK_BYTES] for k in range(0, len(b), R.CHUNK_BYTES)]
    judged = [p for p in parts if len(p) >= R.BANDS[0][0]]
    bad = sum(len(p) for p in judged if not fits(p))
    n, _, _, _, rep = brute(text)
    failed = n < 50 or 100 * rep > 50 * n
    return failed, not failed and fits(b) and (not judged or bad / sum(map(len, judged)) <= R.MAX_BAD_CHUNKS)


def samples():
    rnd = random.Random(2)
    word = lambda k: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    vocabulary = [word(rnd.randint(2, 9)) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    noise = "".join(chr(rnd.randint(0x100, 0x2000)) + " " * (k % 9 == 0) for k in range(9000))
    return [prose(60), prose(400), prose(5000), "same words again " * 300, "x" * 200_000, noise,
            prose(300) + "\n" + " ".join(f"{k:03d}" for k in range(1000)), " ".join(["ab"] * 30 + [prose(70)]), ""]


def test_query_form(spark):
    texts = samples()
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(99, None, "y"), (99, None, "y"), (None, texts[1], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = R.judge(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for k, t, _ in rows:
        r, t = by[k], t or ""
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(t)
        assert (r["base_failed"], r["kept"]) == verdict(t)
    assert by[1]["kept"] and by[2]["kept"] and not by[3]["kept"] and not by[4]["kept"] and not by[5]["kept"]
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)
    assert R.judge(docs.limit(0)).collect() == []


def test_noise_is_rejected_by_the_bands(spark):
    rnd = random.Random(4)
    text = " ".join("".join(chr(rnd.randint(0x4E00, 0x9F00)) for _ in range(4)) for _ in range(600))
    r = R.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not r["base_failed"] and r["kept"] == verdict(text)[1]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = op9_quality_rules(spark, d).collect()
    assert len(got) == len(docs)
    bands = plain_bands(docs.values())
    for r in got[::10]:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(docs[r["doc_id"]])
        assert (r["base_failed"], r["kept"]) == verdict(docs[r["doc_id"]], bands)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    passed = [r for r in got if not r["base_failed"]]
    good, bad = ([r["kept"] for r in passed if quality.get(r["doc_id"]) == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_bands_are_learned_from_distinct_texts(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(400)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(60, 900))) for _ in range(600)] + [None, "", "short"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = plain_bands([t for t in texts if t])
    assert [tuple(b) for b in R.learn_bands(docs)] == want
    phrase = " ".join(rnd.choices(words, k=40))
    copies = spark.range(2000).select("id", F.lit(" ".join([phrase] * 6)).alias("text"))
    both = docs.unionAll(copies)
    learned = R.learn_bands(both)
    assert learned == tuple(plain_bands([t for t in texts if t] + [" ".join([phrase] * 6)]))
    kept = {r["doc_id"]: r["kept"] for r in R.judge(docs, bands=learned).collect()}
    assert sum(kept[i] for i in range(600)) >= 590
    r = R.judge(copies.limit(1).withColumnRenamed("id", "doc_id"), bands=learned).first()
    assert not r["kept"]
    assert R.learn_bands(docs.limit(0)) == tuple(plain_bands([]))
