"""SentencePiece encoding and decoding over a given piece model.

An Aho-Corasick automaton holds the pieces.  One pass over the text yields, at
every position, the pieces that end there (the automaton's output links, longest
first); each relaxes the best score of its end from the best score of its start.
The back pointers then give the segmentation with the highest total of piece
scores, as a unigram model is read.  Characters that no piece covers fall back
to byte pieces.

Spaces become U+2581 and one is put before the text.  No piece has that sign
after another character (checked when a model is loaded), so a segmentation
never crosses a word start, nor any edge between letters and other characters
that no useful piece crosses.  The stretches between are segmented one by one,
and those met before come from a bounded memo.  A U+2581 that the text itself holds is written in byte
pieces, so decoding gives every text back exactly.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import SLICE, per_text, text_bytes

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: an uncovered character scores this much less than the lowest piece
MEMO_WORDS = 150_000
MEMO_CHARS = 64  # longer words are segmented each time


def _stretches(pieces: Iterable[str]) -> re.Pattern:
    """Cuts words at the edges between letters or digits and other characters,
    where no piece lies across: a character that a piece joins to one of the
    other kind is taken as of that kind, until no piece joins two kinds."""
    pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1) if p[i] != SPACE}
    other = {"_"}
    while more := {c for a, b in pairs for c in (a, b) if (_is_word(a, other) != _is_word(b, other)) and _is_word(c, other)}:
        other |= more
    others = re.escape("".join(sorted(other)))
    return re.compile(rf"{SPACE}*[^\W{others}]+|{SPACE}*(?:[^\w{SPACE}]|[{others}])+|{SPACE}+")


def _is_word(c: str, other: set[str]) -> bool:
    return c not in other and re.match(r"\w", c) is not None


@dataclass(frozen=True)
class Model:
    """pieces[id] is (piece, score, kind), kind one of normal, byte, other."""

    pieces: tuple[tuple[str, float, str], ...]


def load(path: str) -> Model:
    """The pieces of a SentencePiece model file that the driver can open."""
    with open(path, "rb") as f:
        m = sentencepiece.SentencePieceProcessor(model_proto=f.read())
    pieces = []
    for i in range(m.get_piece_size()):
        kind = "byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal"
        pieces.append((m.id_to_piece(i), m.get_score(i), kind))
    return Model(tuple(pieces))


class Segmenter(dict):
    """The memo word -> ids (as int32 bytes) of a model, and its automaton."""

    def __init__(self, model: Model):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        self.single, self.bytes_ = set(), {}
        low = 0.0
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind == "byte":
                self.bytes_[int(piece[3:5], 16)] = i
            elif kind == "normal" and piece:
                if re.search(f"[^{SPACE}]{SPACE}", piece):
                    raise ValueError(f"piece {piece!r} crosses a word start")
                self.automaton.add_word(piece, (len(piece), score, i))
                if len(piece) == 1:
                    self.single.add(piece)
                low = min(low, score)
        if len(self.bytes_) != 256:
            raise ValueError("the model has no byte pieces to fall back to")
        self.automaton.make_automaton()
        self.unknown = low - UNKNOWN_PENALTY
        # a piece that a split of itself outscores is in no best segmentation
        useful = ahocorasick.Automaton()
        for piece, entry in self.automaton.items():
            if len(piece) == 1 or self._scores(piece, whole=False)[0][-1] <= entry[1]:
                useful.add_word(piece, entry)
        useful.make_automaton()
        self.automaton = useful
        self.words = _stretches(piece for piece, _ in useful.items())
        self.literal = np.array([self.bytes_[b] for b in SPACE.encode()], np.int32).tobytes()

    def _scores(self, word: str, whole: bool = True) -> tuple[list[float], list]:
        """For each position the best score up to it and the piece that ends
        there; ``whole``: whether the word may be one piece."""
        n = len(word)
        score = [0.0] + [float("-inf")] * n
        back: list = [None] * (n + 1)
        found = self.automaton.iter(word)  # (end, piece), by end, longest first
        if not self.single.issuperset(word):
            found = self._with_unknown(word, found)
        for i, piece in found:
            i += 1
            if (s := score[i - piece[0]] + piece[1]) > score[i] and (whole or piece[0] < n):
                score[i] = s
                back[i] = piece
        return score, back

    def best(self, word: str) -> list[int]:
        """The ids of the best segmentation; of equal scores the one with the longer last piece."""
        back = self._scores(word)[1]
        out, end = [], len(word)
        while end:
            size, _, piece = back[end]
            if piece < 0:
                out += [self.bytes_[b] for b in reversed(word[end - size:end].encode())]
            else:
                out.append(piece)
            end -= size
        out.reverse()
        return out

    def _with_unknown(self, word: str, found) -> Iterator[tuple[int, tuple]]:
        """The pieces found, and an unknown piece for each character that is none."""
        at = next(found, None)
        for i, c in enumerate(word):
            if c not in self.single:
                yield i, (1, self.unknown, -1)
            while at is not None and at[0] == i:
                yield at
                at = next(found, None)

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.best(word)).tobytes()
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:  # the older half goes
                for old in list(islice(self, MEMO_WORDS // 2)):
                    del self[old]
            self[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; none for the empty text."""
        if not text:
            return np.zeros(0, np.int32)
        parts = [b"".join(map(self.__getitem__, self.words.findall(p.replace(" ", SPACE))))
                 for p in (" " + text).split(SPACE)]
        return np.frombuffer(self.literal.join(parts), np.int32)


class Joiner:
    """Decoding by a model's pieces."""

    def __init__(self, model: Model):
        self.pieces = [bytes([int(p[3:5], 16)]) if kind == "byte" else b"" if kind == "other"
                       else p.replace(SPACE, " ").encode() for p, _, kind in model.pieces]

        self._taken = pa.array(self.pieces, pa.binary())

    def decode(self, ids: list[int]) -> str:
        """The text of some ids.  Control ids give nothing, a first space is
        the one that encoding added; byte pieces that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """``decode`` of every list of ids (null: empty), the pieces joined in Arrow."""
        flat, ends = ids.flatten(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0))))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self._taken.take(flat)), b"")
        try:
            text = joined.cast(pa.string())
        except pa.ArrowInvalid:  # byte pieces that are no UTF-8
            return pa.array([b.decode("utf-8", "replace").removeprefix(" ") for b in joined.to_pylist()], pa.string())
        return pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text)


class Codec:
    """Encoding and decoding columns; the pieces reach the executors once, by a
    broadcast whose size is that of the vocabulary."""

    def __init__(self, spark: SparkSession, model: Model):
        self._pieces = spark.sparkContext.broadcast(model)

    def _made(self, kind: Callable):
        sent = self._pieces

        def once():
            made = _MADE.get(kind)
            if made is None or made[0] != sent.value:
                _MADE[kind] = made = (sent.value, kind(sent.value))
            return made[1]

        return once

    def encode(self, text: Column) -> Column:
        """array<int> of a text; empty for null and empty texts."""
        seg = self._made(Segmenter)

        def setup():
            s = seg()

            def each(texts: list[bytes]) -> pa.Array:
                got = [s.encode(t.decode("utf-8", "replace")) for t in texts]
                ends = np.cumsum([0] + [len(g) for g in got]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(
                    np.concatenate(got) if got else np.zeros(0, np.int32)))
            return each

        return per_text(setup, "array<int>")(text_bytes(text))

    def decode(self, ids: Column) -> Column:
        """The text of an array<int>; empty for null."""
        join = self._made(Joiner)

        @F.arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            j = join()
            for batch in batches:
                yield from (j.decode_all(batch.slice(at, SLICE)) for at in range(0, len(batch), SLICE))

        return run(ids)


_MADE: dict = {}  # of this Python worker: the automaton and the memo outlive a task


def encode_docs(docs: DataFrame, codec: Codec) -> DataFrame:
    """doc_id and ids of every document, one row per input row; other columns are ignored."""
    return docs.select("doc_id", codec.encode(F.col("text")).alias("ids"))
