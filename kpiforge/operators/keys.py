"""Surrogate keys, insert-if-absent and exact running totals.

O-30 assign_sk, O-31 insert_absent, and the running total behind them (also
used by the Pareto curve, O-61), plus ``lag_within`` (purchase interval, O-62).

A global ``row_number()`` / cumulative ``sum()`` without PARTITION BY runs in
a single task.  ``running_total`` gives the same numbers with the work spread
over range partitions:

1. range-partition on (group, order) and sort inside partitions;
2. checkpoint, so the partition layout can never change on a recompute
   (range bounds are sampled) -- lineage is cut into ``spark.checkpoint.dir``;
3. number rows inside each partition (``monotonically_increasing_id`` is
   partition index << 33 + position, stable on the checkpointed data);
4. sum each (partition, group) -- at most partitions + groups rows -- and
   turn those sums into offsets with a window over that small table;
5. value = offset of its (partition, group) + running sum inside the
   partition.

Only step 4's small table crosses partitions; a group holding a third of all
rows is spread over many range partitions.

A plain count (surrogate keys, ids) skips step 5's window: the position
inside the sorted partition is already the rank (``_running_count``).
``lag_within`` uses the same layout for LAG(1) per group.  There is one path for
every input size, and NULL group values form a group of their own, as in a
window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, stored

_POS_BITS = 33


def _attach(rows: DataFrame, small: DataFrame, pid: str, groups: Sequence[str], how: str) -> DataFrame:
    """``rows`` with the other columns of ``small``, joined on the partition
    number and NULL-safely on the group columns."""
    keys = [pid, *groups]
    renamed = small.withColumnsRenamed({k: f"_on_{k}" for k in keys})
    same = [F.col(pid) == F.col(f"_on_{pid}")] + [F.col(g).eqNullSafe(F.col(f"_on_{g}")) for g in groups]
    return rows.join(renamed, same, how).drop(*[f"_on_{k}" for k in keys])


def _sort_exprs(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def running_total(df: DataFrame, order_by: Sequence[str | Column], value: Column | None = None,
                  partition_by: Sequence[str] = (), out: str = "running",
                  num_partitions: int | None = None,
                  values: dict[str, Column] | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``value`` (default: running count) over
    ``order_by`` within each ``partition_by`` group, rows from the first up to
    the current one; ``values`` ({out: column}) computes several running sums
    in the same pass.  The order must be total (unique) for a deterministic
    result; rows with NULL group values are a group."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = list(partition_by)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_exprs(parts) + _sort_exprs(order_by)
    if value is None and values is None:
        return _running_count(df, keys, parts, out, n)
    if values is None:
        values = {out: value}
    vcols = {f"_rt_v{i}": (o, c) for i, (o, c) in enumerate(values.items())}
    staged = (df.withColumns({k: c for k, (_, c) in vcols.items()})
              .repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .checkpoint(eager=True))
    staged = staged.withColumn("_rt_mid", F.monotonically_increasing_id()).withColumn(
        "_rt_pid", F.shiftright(F.col("_rt_mid"), _POS_BITS))

    totals = staged.groupBy("_rt_pid", *parts).agg(
        *[F.sum(k).alias(f"{k}_tot") for k in vcols])
    before = Window.partitionBy(*parts).orderBy("_rt_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("_rt_pid", *parts, *[
        F.coalesce(F.sum(f"{k}_tot").over(before),
                   F.lit(0).cast(totals.schema[f"{k}_tot"].dataType)).alias(f"{k}_off")
        for k in vcols])
    if not parts:
        # one row per range partition: a proven, tiny size
        offsets = F.broadcast(offsets)

    inside = Window.partitionBy("_rt_pid", *parts).orderBy("_rt_mid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    with_cum = staged.withColumns({f"{k}_cum": F.sum(k).over(inside) for k in vcols})
    joined = _attach(with_cum, offsets, "_rt_pid", parts, "inner")
    joined = joined.withColumns({o: F.col(f"{k}_off") + F.col(f"{k}_cum")
                                 for k, (o, _) in vcols.items()})
    drop = ["_rt_mid", "_rt_pid"] + [f"{k}{s}" for k in vcols for s in ("", "_cum", "_off")]
    return joined.drop(*drop)


def _running_count(df: DataFrame, keys: list[Column], parts: list[str], out: str,
                   n: int) -> DataFrame:
    """Row number inside each group without a window: on the written
    range-partitioned data a row's position in its partition is its rank in
    that partition, so rank = rows of the group in earlier partitions +
    position - first position of the group in this partition + 1.  Only the
    (partition, group) table is aggregated; no second shuffle of the rows."""
    # the position is written with the rows, so it doesn't depend on how the files are read
    staged = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                    .withColumn("_rc_mid", F.monotonically_increasing_id()), "running-count")
    staged = staged.withColumns({
        "_rc_pid": F.shiftright(F.col("_rc_mid"), _POS_BITS),
        "_rc_pos": F.col("_rc_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)),
    })
    slices = staged.groupBy("_rc_pid", *parts).agg(F.count(F.lit(1)).alias("_rc_n"),
                                                   F.min("_rc_pos").alias("_rc_first"))
    before = Window.partitionBy(*parts).orderBy("_rc_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = slices.select("_rc_pid", *parts, "_rc_first",
                            F.coalesce(F.sum("_rc_n").over(before), F.lit(0)).alias("_rc_off"))
    if not parts:
        offsets = F.broadcast(offsets)     # one row per range partition
    joined = _attach(staged, offsets, "_rc_pid", parts, "inner")
    rank = F.col("_rc_off") + F.col("_rc_pos") - F.col("_rc_first") + F.lit(1)
    return (joined.withColumn(out, rank.cast("bigint"))
            .drop("_rc_mid", "_rc_pid", "_rc_pos", "_rc_first", "_rc_off"))


def insert_absent(target: DataFrame | None, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """O-31: rows of ``src`` whose key is not in ``target`` (ON CONFLICT DO NOTHING)."""
    if target is None:
        return src
    return src.join(target.select(*keys).distinct(), on=list(keys), how="left_anti")


def max_key(existing: DataFrame | None, sk: str) -> int:
    if existing is None:
        return 0
    m = existing.agg(F.max(sk)).first()[0]
    return int(m or 0)


def assign_sk(new_rows: DataFrame, keys: Sequence[str], sk: str,
              existing: DataFrame | None = None) -> DataFrame:
    """O-30: dense keys for rows absent from ``existing``, ordered by the
    natural key, starting after max(existing.sk); existing rows keep theirs.

    Returns ``existing ∪ new`` with the column order ``sk, *other columns``.
    Equals ``row_number() over (order by keys) + max(sk)``.
    """
    fresh = insert_absent(existing, new_rows, keys)
    start = max_key(existing, sk)
    numbered = running_total(fresh, order_by=list(keys), out="_rank")
    cols = [c for c in new_rows.columns if c != sk]
    added = numbered.select((F.col("_rank") + F.lit(start)).cast("bigint").alias(sk), *cols)
    if existing is None:
        return added
    return existing.select(sk, *cols).unionByName(added)


def lag_within(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str],
               value: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row (by ``order_by``) in the
    same ``group_by`` group -- LAG(value, 1) -- without putting a whole group
    in one task.

    Rows are range-partitioned on (group, order) and checkpointed; LAG runs
    inside each (partition, group) slice, and the first row of a slice takes
    the last value of the same group in the nearest earlier partition, found
    on the table of per-slice last values (one row per slice).  Rows with
    NULL group values are a group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    groups = list(group_by)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_exprs(groups) + _sort_exprs(order_by)
    staged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .checkpoint(eager=True)
              .withColumn("_lg_mid", F.monotonically_increasing_id()))
    staged = staged.withColumn("_lg_pid", F.shiftright(F.col("_lg_mid"), _POS_BITS))
    inside = Window.partitionBy("_lg_pid", *groups).orderBy("_lg_mid")
    with_lag = staged.withColumns({
        "_lg_prev": F.lag(value, 1).over(inside),
        "_lg_first": F.row_number().over(inside) == 1,
    })
    last = (staged.groupBy("_lg_pid", *groups)
            .agg(F.max_by(F.struct(value), F.col("_lg_mid")).alias("_lg_last")))
    carry = last.select("_lg_pid", *groups, F.lag("_lg_last", 1).over(
        Window.partitionBy(*groups).orderBy("_lg_pid")).alias("_lg_carry"))
    joined = _attach(with_lag, carry, "_lg_pid", groups, "left")
    return (joined.withColumn(out, F.when(F.col("_lg_first"), F.col("_lg_carry")[value])
                              .otherwise(F.col("_lg_prev")))
            .drop("_lg_mid", "_lg_pid", "_lg_prev", "_lg_first", "_lg_carry"))
