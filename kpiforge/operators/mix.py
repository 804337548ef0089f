"""Top-k, trend matrix, frequencies, profiling.

O-63 top_categories, O-64 category_trend, O-65 value_counts,
O-66 customers_by_city, O-67 profile, O-68 count_where, O-69 top_with_mix,
O-71 ordered, O-72 distinct / union (see ``staging.row_counts``).

Top-k uses ``orderBy().limit(k)``, which Spark plans as TakeOrderedAndProject:
each task keeps its own k best rows and only k x tasks rows reach the final
merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import period_label, share


# ---------------------------------------------------------------------------
# O-71 ordered / limited result
# ---------------------------------------------------------------------------
def ordered(df: DataFrame, keys: Sequence[str | Column], limit: int | None = None) -> DataFrame:
    """ORDER BY keys (NULLs last, as Postgres) [LIMIT n]."""
    cols = [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]
    out = df.orderBy(*cols)
    return out.limit(limit) if limit is not None else out


# ---------------------------------------------------------------------------
# O-63 / O-64 categories
# ---------------------------------------------------------------------------
def top_categories(cat_share: DataFrame, k: int = 10) -> DataFrame:
    """Total revenue and plain mean of the quarterly share per category, top k
    by revenue (ties: name ascending)."""
    g = cat_share.groupBy("category").agg(F.sum("revenue_cat").alias("revenue"),
                                          F.avg("share_cat").alias("avg_share"))
    return ordered(g, [F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_last()], k)


def category_trend(cat_share: DataFrame, k: int = 10) -> DataFrame:
    """Quarter label x top-k category matrix of revenue shares: for each place
    1..k by revenue the category there and its share in the quarter (NULL if it
    sold nothing).  The columns don't depend on the data, so nothing is
    collected to build the plan."""
    cat_share = cat_share.checkpoint(eager=True)  # an aggregate, read twice
    order = Window.orderBy(F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
    top = top_categories(cat_share, k).select("category", F.row_number().over(order).alias("_place"))
    cells = F.struct("category", "share_cat")
    rows = (cat_share.join(F.broadcast(top), "category")  # k rows
            .groupBy(period_label().alias("label"))
            .agg(*[F.max(F.when(F.col("_place") == i, cells)).alias(f"_c{i}") for i in range(1, k + 1)]))
    names = Window.partitionBy()  # the same name on every label; one row per quarter
    return rows.select("label", *[c for i in range(1, k + 1) for c in (
        F.max(f"_c{i}.category").over(names).alias(f"category_{i}"), F.col(f"_c{i}.share_cat").alias(f"share_{i}"))])


# ---------------------------------------------------------------------------
# O-65 / O-66 / O-68 counts
# ---------------------------------------------------------------------------
def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first (ties: value asc)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return ordered(g, [F.col("count").desc(), F.col(col).asc()], k)


def customers_by_city(customers: DataFrame, state: str, city_col: str = "customer_city",
                      state_col: str = "customer_state") -> DataFrame:
    """Customers per city inside one state, most first."""
    d = customers.filter(F.col(state_col) == F.lit(state))
    g = d.groupBy(city_col).agg(F.count(F.lit(1)).alias("customers"))
    return ordered(g, [F.col("customers").desc(), F.col(city_col).asc()])


def count_where(df: DataFrame, cond: Column, name: str = "n_match") -> DataFrame:
    """One row: rows matching ``cond`` and all rows."""
    return df.agg(F.count_if(cond).alias(name), F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------------------
# O-67 table profile
# ---------------------------------------------------------------------------
def profile(df: DataFrame) -> DataFrame:
    """Rows, non-NULL and NULL count and type of every column, most NULLs
    first -- one aggregate pass, then an unpivot of its single row."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_nn_{i}")
                                                 for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    types = {c: df.schema[c].dataType.simpleString() for c in cols}
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                                 F.col(f"_nn_{i}").alias("non_null")) for i, c in enumerate(cols)])
    long = one.select("_rows", F.inline(entries))
    out = long.select("column", "dtype", F.col("_rows").alias("n_rows"), "non_null",
                      (F.col("_rows") - F.col("non_null")).alias("nulls"))
    return ordered(out, [F.col("nulls").desc(), F.col("column").asc()])


# ---------------------------------------------------------------------------
# O-69 top entities and their mix
# ---------------------------------------------------------------------------
def top_with_mix(rows: DataFrame, entity: str, mix: str, value: str = "price",
                 k: int = 10) -> DataFrame:
    """Top-k ``entity`` by revenue and, for each, revenue and share of every
    ``mix`` value (e.g. the categories a top seller sells).

    Rows are summed by (entity, mix) once; the entities' totals come from those
    sums.  The top-k list is a TakeOrdered result (k rows), joined back with a
    broadcast of those k rows -- a proven size."""
    mixed = rows.groupBy(entity, mix).agg(F.sum(value).alias("mix_revenue"))
    tot = mixed.groupBy(entity).agg(F.sum("mix_revenue").alias("entity_revenue"))
    top = ordered(tot, [F.col("entity_revenue").desc(), F.col(entity).asc()], k)
    return (mixed.join(F.broadcast(top), entity, "inner")
            .select(entity, "entity_revenue", mix, "mix_revenue",
                    share("mix_revenue", "entity_revenue").alias("mix_share")))
