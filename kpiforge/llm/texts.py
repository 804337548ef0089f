"""Column functions over whole texts: one Arrow pass, a struct per text.

Working on a column keeps all other columns of the rows in the JVM, so a query
can take the digest and a filter can keep the rows as they are.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE = 512


def trim() -> None:
    """Give a Python worker's freed memory back to the system at a task's end:
    Spark keeps the worker, and what it holds, for tasks of other operators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text; none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def per_text(setup: Callable[[], Callable[[list], pa.Array]], returns: str) -> Callable[..., Column]:
    """A column function from ``setup``, which runs once for each task and
    gives a function from the list of a batch's values to an Arrow array."""

    @F.arrow_udf(returns)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        each = setup()
        for batch in batches:
            # in slices, so that few texts are Python objects at a time and results go out in small batches
            for at in range(0, len(batch), SLICE):
                yield each(batch.slice(at, SLICE).to_pylist())
        del each
        trim()

    return apply
