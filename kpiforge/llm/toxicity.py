"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits used as letters) and one
Aho-Corasick automaton finds the lexicon's stems at word starts.  A hit inside
an exception phrase doesn't count.  The hit weights, normalised by the length
of the text, give a score between 0 and 1.

``learn`` takes the lexicon from labelled documents.  A stem is a word start
that toxic documents use and others don't; it is made as long as it can be
without losing the documents it was seen in, so inflected forms are caught.  Its
weight is its log-odds.  It must occur between different neighbours: words that
merely come along in copies of a toxic text don't get in.  A stem that passes
with equal texts counted once stays, however often they are copied.  Words and
word pairs around a stem that several clean documents and no toxic ones use
become exception phrases.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import fit_sigmoid
from .storage import written
from .texts import per_text, text_bytes, trim

# Letters of other scripts that look like Latin ones
_CYRILLIC = dict(zip("абвеёзикмнорстухіјѕһԁԛԝү", "abbeeznkmhopctyxijshdqwy", strict=True))
_GREEK = dict(zip("αβεηικνορτυχω", "abenikvoptuxw", strict=True))
# Digits and signs written for letters
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}

MIN_STEM, MAX_STEM = 4, 16
COUNT_ENTRIES = 100_000  # entries that a task counts at a time
_LETTERS = re.compile(r"[^\W\d_]+")
_BEFORE = re.compile(r"([^\W\d_]+) $")
_AFTER = re.compile(r" ([^\W\d_]+)")


def _fold_table() -> dict[int, str]:
    """Accented and full-width letters by their Unicode decomposition, then the lists above."""
    out = {}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)).lower()
        if base and base != chr(c):
            out[c] = base
    out |= {ord(k): v for k, v in (_CYRILLIC | _GREEK | _LEET).items()}
    # folded characters that are signs again
    return {k: "".join(_LEET.get(x, x) for x in v) for k, v in out.items()}


_FOLD = _fold_table()
_MARKS = re.compile("[̀-ͯ​-‏⁠﻿­]")


def fold(text: str) -> str:
    """Lower case, without accents and invisible characters, look-alikes as Latin letters."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", text)
    return text.translate(_FOLD)


@dataclass(frozen=True)
class Lexicon:
    """stems: (folded word start, weight), one that ends in a space is a whole
    word; exceptions: folded phrases; the
    score is sigmoid(slope * log1p(density) + offset)."""

    stems: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = ()
    slope: float = 4.0
    offset: float = -4.0
    automaton: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"} | {"automaton": []}

    def machine(self):
        if not self.automaton:
            a = ahocorasick.Automaton()
            entries: dict[str, list] = {}  # size, weight as a word start, weight as a whole word, exception
            for s, w in self.stems:
                word = s.rstrip(" ")
                entries.setdefault(word, [len(word), 0.0, 0.0, False])[1 if word == s else 2] = w
            for p in self.exceptions:
                entries.setdefault(p, [len(p), 0.0, 0.0, False])[3] = True
            for s, e in entries.items():
                a.add_word(s, tuple(e))
            if entries:
                a.make_automaton()
            self.automaton.append(a if entries else None)
        return self.automaton[0]


def hits(lex: Lexicon, folded: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the stems at word starts that no exception
    phrase covers; of stems that start together the heaviest counts."""
    a = lex.machine()
    if a is None or not folded:
        return []
    found, spans, n = {}, [], len(folded)
    for last, (size, weight, whole, exception) in a.iter(folded):
        start, end = last - size + 1, last + 1
        if start and folded[start - 1].isalpha():
            continue
        if (exception or whole) and (end == n or not folded[end].isalpha()):
            weight = max(weight, whole)
            if exception:
                spans.append((start, end))
        if weight and weight > found.get(start, (0, 0.0))[1]:
            found[start] = (end, weight)
    # in order of their starts, a hit is covered if an exception that starts no later ends no earlier
    out, at, reach = [], 0, 0
    spans.sort()
    for s, (e, w) in sorted(found.items()):
        while at < len(spans) and spans[at][0] <= s:
            reach, at = max(reach, spans[at][1]), at + 1
        if e > reach:
            out.append((s, e, w))
    return out


def density(lex: Lexicon, text: str) -> tuple[int, float]:
    """Number of hits, and their weight over the root of the length in hundreds of words."""
    got = hits(lex, fold(text))
    words = 1 + text.count(" ") + text.count("\n")
    return len(got), sum(w for _, _, w in got) / math.sqrt(1 + words / 100)


def score_of(lex: Lexicon, dens: float) -> float:
    return 1 / (1 + math.exp(-(lex.slope * math.log1p(dens) + lex.offset)))


RESULT = "score double, n_hits long"


def _setup(lex: Lexicon):
    def each(texts: list[bytes]) -> pa.Array:
        got = [density(lex, t.decode("utf-8", "replace")) for t in texts]
        return pa.StructArray.from_arrays([pa.array([score_of(lex, d) for _, d in got], pa.float64()),
                                           pa.array([n for n, _ in got], pa.int64())], ["score", "n_hits"])
    return each


def toxicity(text: Column, lex: Lexicon) -> Column:
    """Struct ``RESULT`` of a text; null and empty texts have no hits and get the lowest score."""
    return per_text(lambda: _setup(lex), RESULT)(text_bytes(text))


def _neighbours(folded: str, start: int) -> tuple[str, str]:
    """The words right before and after the word that starts there, if only a space is between."""
    end = _LETTERS.match(folded, start).end()
    before = _BEFORE.search(folded, max(0, start - 40), start)
    after = _AFTER.match(folded, end, end + 40)
    return before[1] if before else "", after[1] if after else ""


def _stems_of(text: str) -> set[str]:
    """The starts of a text's words, and its words that are too short for one, with a space after them."""
    out = set()
    for w in set(_LETTERS.findall(fold(text))):
        if len(w) < MIN_STEM:
            out.add(w + " ")
        out.update(w[:k] for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1))
    return out


def _count(parts: Iterator[pa.RecordBatch], of, most: int) -> Iterator[pa.RecordBatch]:
    """(entry, toxic documents, other documents, toxic texts, other texts), added up in
    parts of at most ``most`` entries."""
    got: dict[str, list[int]] = {}

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(got), pa.string()), *(pa.array([v[k] for v in got.values()], pa.int64()) for k in range(4))],
            ["entry", "n_bad", "n_other", "t_bad", "t_other"])

    for part in parts:
        for text, bad, copies in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
            at = 0 if bad else 1
            for e in of(text.decode("utf-8", "replace")):
                v = got.setdefault(e, [0, 0, 0, 0])
                v[at] += copies
                v[at + 2] += 1
            if len(got) > most:
                yield batch()
                got.clear()
    if got:
        yield batch()
    got.clear()
    trim()


def _distinct(rows: DataFrame) -> DataFrame:
    """The distinct texts of each label and how many rows have them, written."""
    return written(rows.groupBy("_y", F.md5(text_bytes(F.col("text"))).alias("h")).agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).drop("h"), "distinct")


def _entries(once: DataFrame, of) -> DataFrame:
    """How many toxic and other documents, and distinct texts of them, have each entry."""
    sums = ("n_bad", "n_other", "t_bad", "t_other")
    return (once.select(text_bytes(F.col("text")).alias("t"), (F.col("_y") == 1).alias("b"), "copies")
            .mapInArrow(lambda it: _count(it, of, COUNT_ENTRIES), "entry string, n_bad long, n_other long, t_bad long, t_other long")
            .groupBy("entry").agg(*(F.sum(c).alias(c) for c in sums)))


def _longest(stems: dict[str, tuple[list, int]], keep: float = 0.9) -> list[str]:
    """Of each family of word starts, the longest that keeps a share of its documents."""
    kids: dict[str, list[str]] = {}
    for s in stems:
        kids.setdefault(s[:-1], []).append(s)
    out = []
    for s in stems:
        if s[:-1] in stems:
            continue
        while big := [k for k in kids.get(s, ()) if stems[k][1] >= keep * stems[s][1]]:
            s = max(big, key=lambda k: (stems[k][1], k))
        out.append(s)
    return sorted(out)


def _ways(entries: DataFrame, n: dict[int, tuple[int, int]], min_docs: int, min_log_odds: float) -> DataFrame:
    """The entries that toxic texts or documents use so much more than others;
    n: the texts and documents of each label."""
    def passes(k: int, bad: str, other: str):
        odds = F.log((F.col(bad) + 0.5) / (n[1][k] + 1)) - F.log((F.col(other) + 0.5) / (n[0][k] + 1))
        return (F.col(bad) >= min_docs) & (odds >= min_log_odds - 1e-9)
    return entries.where(passes(0, "t_bad", "t_other") | passes(1, "n_bad", "n_other"))


def learn(labelled: DataFrame, min_docs: int = 4, min_log_odds: float = 3.0, min_variety: float = 0.5) -> Lexicon:
    """The lexicon of ``labelled`` (doc_id, text, label 0 or 1, weight: the
    documents that a row stands for).

    The counts of stems and exception phrases cover all these rows; a stem gets in
    by its counts over distinct texts or by those over documents.  The
    word starts that pass their log-odds, the exceptions and one number for each
    row go through the driver, so the caller bounds the rows.  Without rows of both labels the lexicon is empty."""
    rows = labelled.withColumnRenamed("label", "_y")
    once = _distinct(rows)
    n = {r["_y"]: (r["texts"], r["docs"]) for r in once.groupBy("_y").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("docs")).collect()}
    if len(n) < 2:
        return Lexicon(())
    odds = {}
    for e, n_bad, n_other, t_bad, t_other in _ways(_entries(once, _stems_of), n, min_docs, min_log_odds).collect():
        ways = []  # (log-odds, toxic ones) by distinct texts and by documents
        for k, (bad, other) in enumerate(((t_bad, t_other), (n_bad, n_other))):
            w = math.log((bad + 0.5) / (n[1][k] + 1)) - math.log((other + 0.5) / (n[0][k] + 1))
            if bad >= min_docs and w >= min_log_odds:
                ways.append((w, bad))
        if ways:
            odds[e] = (ways, t_bad)
    lex = Lexicon(tuple((s, round(odds[s][0][0][0], 6)) for s in _longest(odds)))

    def contexts(text: str) -> set[str]:
        folded = fold(text)
        return {f"{folded[s:e]}{' ' * (e - s < MIN_STEM)}\n{a}\n{b}"
                for s, e, _ in hits(lex, folded) for a, b in [_neighbours(folded, s)]}

    seen = (_entries(once.where("_y = 1"), contexts).groupBy(F.split_part("entry", F.lit("\n"), F.lit(1)).alias("s"))
            .count().where(F.col("count") >= min_docs).collect())
    pairs = {r["s"]: r["count"] for r in seen}
    passed = ((s, [w for w, bad in odds[s][0] if pairs.get(s, 0) >= min_variety * bad]) for s, _ in lex.stems)
    lex = Lexicon(tuple((s, round(ws[0], 6)) for s, ws in passed if s in pairs and ws))

    def phrases(text: str) -> set[str]:
        folded = fold(text)
        out = set()
        for start, end, _ in hits(lex, folded):
            word = folded[start:end] + (_LETTERS.match(folded, end) or [""])[0]
            before, after = _neighbours(folded, start)
            out.add(word)
            out.update([f"{before} {word}"] if before else [])
            out.update([f"{word} {after}"] if after else [])
        return out

    exc = _entries(once, phrases).where((F.col("n_bad") == 0) & (F.col("n_other") >= min_docs))
    lex = Lexicon(lex.stems, tuple(sorted(r["entry"] for r in exc.select("entry").collect())))
    return _fit(rows, lex)


def _fit(rows: DataFrame, lex: Lexicon) -> Lexicon:
    """Slope and offset by logistic regression, so that the score is the share
    of toxic documents at that density."""
    dens = per_text(lambda: lambda ts: pa.array([density(lex, t.decode("utf-8", "replace"))[1] for t in ts],
                                                pa.float64()), "double")(text_bytes(F.col("text")))
    got = rows.select(dens.alias("d"), "_y", "weight").toArrow()
    x, y, weight = (got.column(c).to_numpy() for c in ("d", "_y", "weight"))
    x, weight = np.log1p(x), weight / weight.sum()
    slope, offset = fit_sigmoid(x, y, weight)
    return Lexicon(lex.stems, lex.exceptions, slope, offset)


def score(docs: DataFrame, lex: Lexicon, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted and n_hits of every document, one row per input row."""
    return (docs.select("doc_id", toxicity(F.col("text"), lex).alias("_t"))
            .select("doc_id", F.col("_t.score").alias("score"),
                    (F.col("_t.score") >= threshold).cast("int").alias("predicted"),
                    F.col("_t.n_hits").alias("n_hits")))


def drop_toxic(docs: DataFrame, lex: Lexicon, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` under the threshold, with their columns."""
    return docs.where(toxicity(F.col("text"), lex)["score"] < threshold)

