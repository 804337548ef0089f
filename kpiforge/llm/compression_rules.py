"""Quality rules with compression bands.

A base rule rejects short and repetitive texts by word counts.  The others go
through two zstandard ratios (compressed over plain bytes): that of the whole
text and that of each fixed chunk.  A ratio under its band means repetition,
one over it means noise that does not compress; the bands depend on the length,
since short inputs compress less.

The bands come from the corpus itself, without labels: for each half octave of
length the quartiles of the ratio over all distinct texts, and fences at some
interquartile ranges outside them.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import per_text, text_bytes

# (from this many bytes, lowest ratio, highest ratio); shorter inputs are not judged.  Wide
# bands for length classes of which a corpus has too few texts.
BANDS = (
    (128, 0.36, 1.05),
    (256, 0.34, 0.90),
    (512, 0.30, 0.80),
    (1024, 0.27, 0.74),
    (2048, 0.25, 0.70),
    (4096, 0.23, 0.68),
    (16384, 0.20, 0.66),
)
CHUNK_BYTES = 1024
# Fences: interquartile ranges below the first and above the third quartile (text that compresses
# less than its fellows is rarer and less suspect); a range counts as LEAST_SPREAD of the median at least
BELOW, ABOVE, LEAST_SPREAD = 1.5, 3.0, 0.03
LEAST_TEXTS = 50  # distinct texts of a length class from which its band is learned
MAX_BAD_CHUNKS = 0.5  # share of the judged chunk bytes that may lie outside their band
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FEATURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "ratio double, bad_chunk_share double, base_failed boolean, kept boolean")

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, n)
    v = len(code)
    if v < 2_000_000:
        grams = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # too many words to number three of them in 64 bits
        pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        grams = pairs[:-1] * v + ids[2:]
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.  Words
    are runs of bytes other than space and \\t\\n\\v\\f\\r."""
    words = text.split()
    at = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = at[:128].sum() + at[192:].sum()  # all bytes but those that continue a code point
    blanks = at[9:14].sum() + at[32]
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), int(points - blanks), int(at[_SYMBOLS].sum()), len(lines) - len(set(lines)),
            repeated_words(words))


def _setup(bands: Sequence[tuple[int, float, float]], chunk: int, max_bad: float, level: int):
    starts = [b[0] for b in bands]
    zip_ = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)

    def judged(part: bytes) -> tuple[float | None, bool]:
        """The ratio (none if the input is too short to judge), and whether it is in its band."""
        k = bisect_right(starts, len(part)) - 1
        if k < 0:
            return None, True
        r = len(zip_.compress(part)) / len(part)
        return r, bands[k][1] <= r <= bands[k][2]

    def verdict(text: bytes) -> tuple[float | None, float, bool]:
        ratio, ok = judged(text)
        bad = total = 0
        for at in range(0, len(text), chunk):
            part = text[at:at + chunk]
            r, fine = (ratio, ok) if len(part) == len(text) else judged(part)
            if r is not None:
                total += len(part)
                bad += 0 if fine else len(part)
        share = bad / total if total else 0.0
        return ratio, share, ok and share <= max_bad

    def each(texts: list[bytes]) -> pa.Array:
        out = []
        for t in texts:
            n, chars, symbols, dup, rep = base_counts(t)
            failed = n < MIN_WORDS or 100 * rep > MAX_REPEAT_PERCENT * n
            ratio, share, ok = verdict(t)
            out.append((n, chars, symbols, dup, rep, ratio, share, failed, not failed and ok))
        kinds = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
        names = [f.split()[0] for f in FEATURES.split(", ")]
        cols = list(zip(*out, strict=True)) if out else [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    return each


def length_class(n: int) -> int:
    """The half octave of a byte length."""
    return math.floor(2 * math.log2(n))


def _ratio_setup(level: int):
    zip_ = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)

    def each(texts: list[bytes]) -> pa.Array:
        got = [[{"length_class": length_class(len(t)), "permille": round(1000 * len(zip_.compress(t)) / len(t))}]
               if len(t) >= BANDS[0][0] else [] for t in texts]
        return pa.array(got, pa.list_(pa.struct([("length_class", pa.int32()), ("permille", pa.int32())])))

    return each


def fences(counts: dict[int, int]) -> tuple[float, float] | None:
    """Lowest and highest ratio of a class, from its counts by thousandths;
    none for a class of few texts."""
    n = sum(counts.values())
    if n < LEAST_TEXTS:
        return None
    values = np.array(sorted(counts))
    upto = np.cumsum([counts[v] for v in values.tolist()])
    first, middle, third = (int(values[np.searchsorted(upto, q * n / 4)]) for q in (1, 2, 3))
    spread = max(third - first, LEAST_SPREAD * middle)
    return (first - BELOW * spread) / 1000, (third + ABOVE * spread) / 1000


def learn_bands(docs: DataFrame, level: int = LEVEL) -> tuple[tuple[int, float, float], ...]:
    """Bands from all texts of ``docs``, each distinct one (by its 64-bit hash)
    once, so copies don't pull a band to themselves.  The counts that reach
    the driver are bounded: at most 60 length classes by some thousand ratios."""
    text = text_bytes(F.col("text"))
    # no or one entry a text: a filter on a nullable result would be evaluated by a second Python worker
    ratios = per_text(lambda: _ratio_setup(level), "array<struct<length_class:int,permille:int>>")(text)
    rows = docs.select(F.xxhash64(text).alias("h"), F.inline(ratios)).groupBy("h").agg(
        F.first("length_class").alias("length_class"), F.first("permille").alias("permille"))
    classes = defaultdict(dict)
    for r in rows.groupBy("length_class", "permille").count().collect():
        classes[r["length_class"]][r["permille"]] = r["count"]
    starts, out = [b[0] for b in BANDS], []
    for c in range(length_class(starts[0]), 2 + max([*classes, length_class(starts[-1])])):
        start = math.ceil(2 ** (c / 2))
        found = fences(classes[c]) if c in classes else None
        out.append((start, *(found or BANDS[bisect_right(starts, start) - 1][1:])))
    return tuple(out)


def rules(text: Column, bands: Sequence[tuple[int, float, float]] = BANDS, chunk_bytes: int = CHUNK_BYTES,
          max_bad_chunks: float = MAX_BAD_CHUNKS, level: int = LEVEL) -> Column:
    """Struct ``FEATURES`` of a text.  Null and empty texts have no words,
    so the base rule rejects them; ``ratio`` is null for texts shorter than the
    first band, which pass the bands."""
    return per_text(lambda: _setup(tuple(bands), chunk_bytes, max_bad_chunks, level), FEATURES)(text_bytes(text))


def judge(docs: DataFrame, bands: Sequence[tuple[int, float, float]] | None = None, **params) -> DataFrame:
    """doc_id and the ``FEATURES`` of every document, one row per input row
    (repeated rows stay, other columns are ignored, no rows for no rows).  The
    bands are learned from ``docs`` unless they are given."""
    params["bands"] = learn_bands(docs) if bands is None else bands
    return docs.select("doc_id", rules(F.col("text"), **params).alias("_f")).select("doc_id", "_f.*")


def keep_good(docs: DataFrame, bands: Sequence[tuple[int, float, float]] | None = None, **params) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns; bands as for ``judge``."""
    params["bands"] = learn_bands(docs) if bands is None else bands
    return docs.where(rules(F.col("text"), **params)["kept"])
