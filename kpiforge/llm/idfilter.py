"""A bitmap of id hashes that keeps most rows without a partner out of a join.

The bitmap has a fixed size (2 MB), whatever the number of ids.  It never drops
a row that has a partner; with very many ids it lets more rows through, and the
join that follows does the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24


def _place(c: Column) -> Column:
    return F.pmod(F.xxhash64(c.cast("long")), F.lit(1 << BITS))


def maybe_in(ids: DataFrame, id_column: str) -> Callable[[Column], Column]:
    """A test whether a column's value may occur among ``ids``: never false
    for one that does; false for null."""
    words = (ids.where(F.col(id_column).isNotNull()).select(_place(F.col(id_column)).alias("p"))
             .groupBy(F.expr("p div 32").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("b"))
             .toArrow())  # at most 2 ** (BITS - 5) rows
    bitmap = np.zeros(1 << BITS - 5, np.uint32)
    bitmap[words.column("w").to_numpy()] = words.column("b").to_numpy().astype(np.uint32)
    sent = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def seen(places: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = sent.value
        for batch in places:
            p = batch.to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.array((bits[p >> 5] >> (p & 31).astype(np.uint32) & 1).astype(bool))

    return lambda c: c.isNotNull() & seen(_place(c))


def likely(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` may occur in ``ids``."""
    return df.where(maybe_in(ids, id_column)(F.col(column)))
