"""Percentiles of groups of any size, exact or by a mergeable sketch.

``percentile`` merges a value -> count map of a whole group in one task.  Here
an exact percentile takes two passes that leave the rows where they are:

1. every group's values go into a quantile sketch of fixed size (KLL, merged
   from the tasks' partial ones); its error bound brackets each wanted rank;
2. values inside a bracket are counted one by one, all others only by the side
   on which they lie.  What is shuffled is a few percent of a group's distinct values.

The counts keep every rank, so the order statistics are read off their running
sums.  A rank that the sketch brackets wrongly falls on a side, is seen, and the
groups it happens to are counted in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .keys import running_total

#: Size of the quantile sketch; its rank error is under SKETCH_ERROR with 99 % confidence.
SKETCH_K, SKETCH_ERROR = 1024, 0.0045
#: Half a bracket in ranks: three errors, and room for the two ranks that an
#: interpolation needs in a group of SMALL_GROUP rows; smaller ones are counted in full.
BRACKET, SMALL_GROUP = 0.02, 400
#: Groups whose brackets are broadcast, and counts whose running sums are taken
#: by one task a group, at most; above these the joins and sums are distributed.
BROADCAST_GROUPS, WINDOW_COUNTS = 100_000, 500_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on equal or both NULL ``on`` columns, which are kept once."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


# ---------------------------------------------------------------------------
# O-43 by sketch
# ---------------------------------------------------------------------------
def quantile_sketch(value: str | Column, k: int = SKETCH_K) -> Column:
    """An aggregate: the mergeable sketch of the non-NULL values."""
    return F.kll_sketch_agg_double((F.col(value) if isinstance(value, str) else value).cast("double"), F.lit(k))


def percentiles_approx(rows: DataFrame, by: Sequence[str], value: str, ps: dict[str, float],
                       k: int = SKETCH_K) -> DataFrame:
    """One row per group with ``n_rows``, its non-NULL values, and a value whose
    rank is within the sketch's error of each wanted percentile: one pass, one
    row per group and task shuffled.  Groups without values are left out."""
    g = rows.groupBy(*by).agg(F.count(value).alias("n_rows"), quantile_sketch(value, k).alias("_sketch"))
    return g.where("n_rows > 0").select(*by, "n_rows", *[
        F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))).alias(name) for name, p in ps.items()])


def rank_shares(rows: DataFrame, by: Sequence[str], value: str, at: DataFrame, mark: str) -> DataFrame:
    """The exact shares of a group's non-NULL values below and up to its
    ``mark`` in ``at`` (one row per group): by, below, upto."""
    v = null_safe_join(rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v")),
                       at.select(*by, mark), by, "inner")
    return v.groupBy(*by).agg(F.avg((F.col("_v") < F.col(mark)).cast("int")).alias("below"),
                              F.avg((F.col("_v") <= F.col(mark)).cast("int")).alias("upto"))


# ---------------------------------------------------------------------------
# exact
# ---------------------------------------------------------------------------
def _running(counts: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``counts`` (materialized; _n rows each) with _upto, the group's rows up to a value."""
    if counts.count() > WINDOW_COUNTS:
        return running_total(counts, order_by=[value], partition_by=by, values={"_upto": F.col("_n")})
    return counts.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*by).orderBy(value)))


def percentiles_of_counts(counts: DataFrame, by: Sequence[str], value: str, n: str,
                          ps: dict[str, float], sure: Column | None = None) -> DataFrame:
    """One row per ``by`` group with the percentiles ``ps`` ({name: p}) of
    ``value``, each standing for ``n`` rows; NULL values don't count and a
    group without others is left out.  ``counts`` has one row per (group,
    value) and should be materialized by the caller.  With ``sure``, a condition on
    its rows, the column _sure says whether it holds for all that the percentiles come from."""
    c = counts.where(F.col(value).isNotNull()).select(
        *by, value, F.col(n).cast("bigint").alias("_n"), (F.lit(True) if sure is None else sure).alias("_ok"))
    ranked = _running(c, by, value)
    totals = c.groupBy(*by).agg(F.sum("_n").alias("_total"))
    ranked = null_safe_join(ranked, totals, by, "inner")
    x = F.col(value).cast("double")

    def at(rank: Column) -> Column:
        return F.when((F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto")), x)

    place = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in ps.items()}
    marks = {}
    for name, pos in place.items():
        marks[f"_lo_{name}"], marks[f"_hi_{name}"] = at(F.floor(pos)), at(F.ceil(pos))
    hit = None
    for m in marks.values():
        hit = m.isNotNull() if hit is None else hit | m.isNotNull()
    g = (ranked.where(hit).groupBy(*by)
         .agg(F.first("_total").alias("_total"), F.min("_ok").alias("_sure"), *[F.max(m).alias(k) for k, m in marks.items()]))
    out = []
    for name, pos in place.items():
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append(F.when(lo == hi, lo).otherwise(
            (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi).alias(name))
    return g.select(*by, *out, *([] if sure is None else ["_sure"]))


def _brackets(groups: DataFrame, by: Sequence[str], ps: dict[str, float]) -> DataFrame:
    """For each group the value ranges, in rising order, that hold the wanted ranks."""
    def end(rank: float, open_end: float) -> Column:
        inside = F.kll_sketch_get_quantile_double("_sketch", F.lit(min(1.0, max(0.0, rank))))
        return F.when(F.lit(0 < rank < 1) & (F.col("_n") >= SMALL_GROUP), inside).otherwise(F.lit(open_end))

    inf = float("inf")
    ranks = sorted(set(map(float, ps.values())))
    ends = [c for i, p in enumerate(ranks) for c in (end(p - BRACKET, -inf).alias(f"_from{i}"), end(p + BRACKET, inf).alias(f"_to{i}"))]
    return groups.where("_n > 0").select(*by, *ends)


def percentiles(rows: DataFrame, by: Sequence[str], value: str, ps: dict[str, float],
                also: dict[str, Column] | None = None) -> DataFrame:
    """One row per ``by`` group with its exact interpolated percentiles ``ps``
    ({name: p}); NULL values don't count.

    ``also`` ({name: aggregate}) is computed in the first pass and comes along;
    groups without values then have NULL percentiles, and are left out
    otherwise.  ``rows`` are read twice and never shuffled."""
    also = also or {}
    groups = rows.groupBy(*by).agg(F.count(value).alias("_n"), quantile_sketch(value).alias("_sketch"),
                                   *[c.alias(name) for name, c in also.items()]).checkpoint(eager=True)
    brackets = _brackets(groups, by, ps)
    n_ranks = len(set(map(float, ps.values())))
    if groups.count() <= BROADCAST_GROUPS:
        brackets = F.broadcast(brackets)
    v = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    v = null_safe_join(v, brackets, by, "inner")
    inside, above = F.lit(False), F.lit(0)
    for i in range(n_ranks):
        inside = inside | F.col("_v").between(F.col(f"_from{i}"), F.col(f"_to{i}"))
        above = above + (F.col("_v") > F.col(f"_to{i}")).cast("int")
    # a side's values lie together in the order, so its least one can stand for them
    v = v.select(*by, "_v", F.when(inside, F.col("_v")).alias("_value"), F.when(~inside, above).alias("_side"))
    counts = (v.groupBy(*by, "_side", "_value").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_at"))
              .checkpoint(eager=True))
    got = percentiles_of_counts(counts, by, "_at", "_c", ps, sure=F.col("_side").isNull()).checkpoint(eager=True)
    unsure = got.where(~F.col("_sure")).select(*by)
    if not unsure.isEmpty():
        again = null_safe_join(rows.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v")), unsure, by, "inner")
        full = again.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True)
        got = got.where("_sure").drop("_sure").unionByName(percentiles_of_counts(full, by, "_v", "_c", ps))
    got = got.select(*by, *ps)
    return null_safe_join(groups.drop("_n", "_sketch"), got, by, "left").select(*by, *also, *ps) if also else got
