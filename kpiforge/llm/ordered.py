"""Running totals over a global order, without a one-task window.

The rows are range-partitioned and sorted.  Each partition sums its own rows
while it streams them; the totals of the (partition, group) runs, at most one
per partition plus one per group, are turned into offsets.  A group that holds
a third of all rows is therefore spread over many partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written

RUN_COLUMNS = ("_pid", "_run", "_row", "_before")


def _stream(batches: Iterator[pa.RecordBatch], group: str | None, value: str) -> Iterator[pa.RecordBatch]:
    pid, run, row, total, last = TaskContext.get().partitionId(), 0, 0, 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        v = batch.column(batch.schema.get_field_index(value)).to_numpy(zero_copy_only=False)
        start = np.zeros(n, bool)
        if group is not None:
            g = batch.column(batch.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            start[1:] = g[1:] != g[:-1]
            start[0] = last is not None and g[0] != last
            last = g[-1]
        runs = run + np.cumsum(start)
        # offsets restart where a run starts; the first run goes on from the last batch
        ex = np.concatenate(([0], np.cumsum(v)[:-1])).astype(np.int64)
        ones = np.arange(n, dtype=np.int64)
        first = np.maximum.accumulate(np.where(start, ones, 0))
        fresh_run = runs > run
        before = ex - ex[first] + np.where(fresh_run, 0, total)
        rows = ones - first + np.where(fresh_run, 0, row)
        run, total, row = int(runs[-1]), int(before[-1] + v[-1]), int(rows[-1] + 1)
        add = [pa.array(np.full(n, pid, np.int64)), pa.array(runs.astype(np.int64)), pa.array(rows), pa.array(before)]
        yield pa.RecordBatch.from_arrays(batch.columns + add, names=batch.schema.names + list(RUN_COLUMNS))


def running(df: DataFrame, order: Sequence[str | Column], value: str, group: str | None = None,
            name: str = "running") -> DataFrame:
    """``df`` with ``_before``, the sum of ``value`` (non-null integers) over
    the rows that come before in ``order``, and ``_row``, their number; both
    start again in each ``group`` (a non-null string column) if one is given.
    Equal rows come in any order.  The result is a written table."""
    keys = ([group] if group else []) + list(order)
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in RUN_COLUMNS])
    laid = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .mapInArrow(lambda it: _stream(it, group, value), schema), name)
    by = ["_pid", "_run"]
    totals = laid.groupBy(*by, *([group] if group else [])).agg(
        F.sum(value).alias("_t"), F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy(*by)
    w = w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_o"),
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_p"))
    if group is None:  # one row per partition
        offsets = F.broadcast(offsets)
    return (laid.join(offsets, by).withColumn("_before", F.col("_before") + F.col("_o"))
            .withColumn("_row", F.col("_row") + F.col("_p")).drop("_pid", "_run", "_o", "_p"))
