"""Ids and token bytes of a byte-level BPE tokenizer file.

The file's own library spends four times as long on a text as tiktoken does.
Where a file's merges stand in the order of their ids, merging the pair of
lowest id is the same as merging by the list, so the file's vocabulary is given
to tiktoken as ranks; any other file is encoded by the library it is made for.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F


# The pattern that cuts texts before the merges of byte-level files (fixed value):
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# in a form that cuts the same and does not try shorter runs
CUT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
# tiktoken's way to arrays searches texts for special tokens first, slowly if there
# are none; this one has an id past the vocabulary and is never allowed, so it is plain text
NO_TOKEN = "<|never|>"

SLICE_ROWS, SLICE_BYTES = 512, 2 << 20


def byte_slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A binary array in slices of at most 512 values and about 2 MB, or one longer value."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(batch).to_pylist()):
        if i > at and (size + (n or 0) > SLICE_BYTES or i - at == SLICE_ROWS):
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if len(batch):
        yield batch.slice(at)


def per_slice(setup: Callable[[], Callable[[list[str]], pa.Array]], returns: str) -> Callable[[Column], Column]:
    """A column function over texts from ``setup``, which runs once for each
    task and gives a function from some texts (null: empty) to an Arrow array."""

    @F.arrow_udf(returns)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        each = setup()
        for batch in batches:
            for part in byte_slices(batch):
                yield each([(b or b"").decode("utf-8", "replace") for b in part.to_pylist()])

    return lambda text: apply(text.cast("binary"))


def load(path: str) -> str:
    """The content of a tokenizer file that the driver can open."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_of() -> dict[str, int]:
    """The byte that each letter of the vocabulary stands for: printable bytes
    stand for themselves, the others, in order, for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def encoder(content: str) -> ByteBpe:
    """The encoder of a tokenizer file's content, one a process."""
    return ByteBpe(content)


class ByteBpe:
    def __init__(self, content: str):
        file, byte = json.loads(content), _byte_of()
        vocab = file["model"]["vocab"]
        special = {t["content"] for t in file["added_tokens"]}
        #: the bytes of each id
        self.token_bytes: list[bytes] = [b""] * (1 + max(vocab.values(), default=0))
        for token, i in vocab.items():
            self.token_bytes[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"])
        made = [vocab["".join(p)] for p in pairs]
        if all(a < b for a, b in zip(made, made[1:])):
            ranks = {self.token_bytes[i]: i for t, i in vocab.items() if t not in special}
            ranked = tiktoken.Encoding("ranks", pat_str=CUT_PATTERN, mergeable_ranks=ranks, special_tokens={NO_TOKEN: len(self.token_bytes)})
            self._encode = ranked.encode_ordinary
            self._array = lambda text: ranked.encode_to_numpy(text, disallowed_special=())
        else:
            from tokenizers import Tokenizer
            library = Tokenizer.from_str(content)
            library.encode_special_tokens = True
            self._encode = lambda text: library.encode(text, add_special_tokens=False).ids
            self._array = lambda text: np.array(self._encode(text), np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; special tokens in a text are ordinary text."""
        return [self._encode(t) for t in texts]

    def arrays(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The same ids, an array of unsigned 32-bit integers for each text."""
        return map(self._array, texts)
