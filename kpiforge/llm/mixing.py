"""Mixing sources to target weights: a budget through a domain-language-source tree.

The token budget goes down the tree.  At each node it is shared out among the
children by weight, but no child gets more than its subtree holds (its tokens
times the epochs allowed).  What a short child leaves goes to its siblings, and
only what a whole family can't take goes to the family's siblings one level up.
A leaf that gets q of its A tokens repeats q div A whole epochs and adds, for the
rest, the token prefix of the next epoch's seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import running
from .storage import written

BROADCAST_LEAVES = 100_000  # rows of the leaf plan that may be broadcast
LEVELS = ("domain", "lang", "source")


def share_out(children: DataFrame, parent: Sequence[str], budget: str) -> DataFrame:
    """``children`` (the parent's columns, its ``budget``, name, cap, weight)
    with ``quota``, in whole tokens rounded down.

    Children are filled in the order of cap over weight: those that the level
    common to all would overfill get their cap, the others share the rest by
    weight.  Null names are names like others."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.col("cap") / F.col("weight"), F.col("name").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    c = children.where("weight > 0 and cap > 0")
    c = c.withColumn("_left", F.col(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    c = c.withColumn("_open", F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    c = c.withColumn("_full", F.expr("cap * _open <= weight * _left"))
    c = c.withColumn("_rest", F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(family), F.lit(0)))
    c = c.withColumn("_share", F.coalesce(F.sum(F.when(~F.col("_full"), F.col("weight"))).over(family), F.lit(0)))
    quota = F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("least(cap, weight * _rest div _share)"))
    return c.withColumn("quota", quota).drop("_left", "_open", "_full", "_rest", "_share")


def leaf_quotas(leaves: DataFrame, budget: int, weights: Sequence[Column], epochs: int) -> DataFrame:
    """``quota`` of every leaf (the LEVELS, tokens); ``weights`` has the whole
    weight of a node of each level among its siblings, over the LEVELS."""
    tree = leaves.select(*LEVELS, (F.col("tokens") * epochs).alias("cap"),
                         *(w.cast("bigint").alias(f"w{k}") for k, w in enumerate(weights)))
    up = None
    for k, name in enumerate(LEVELS):
        path, parent = list(LEVELS[:k + 1]), list(LEVELS[:k])
        nodes = tree.groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"w{k}").alias("weight"))
        nodes = nodes.withColumn("name", F.col(name))
        if up is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("bigint"))
        else:
            same = [nodes[p].eqNullSafe(up[p]) for p in parent]
            nodes = nodes.join(up, same).select(*(nodes[c] for c in nodes.columns), up["quota"].alias("budget"))
        shared = share_out(nodes, parent, "budget")
        up = shared.select(*path, "quota")
    return up


def _key(seed: int, epoch: Column) -> Column:
    """The place of a document in an epoch's order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))


def _free(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name = "_" + name
    return name


def mix(docs: DataFrame, domain: Column, tokens: Column, weights: Sequence[Column], budget: int | float,
        epochs: int = 4, seed: int = 17) -> DataFrame:
    """The rows of ``docs`` (doc_id, lang, source, ...) that the mixture takes,
    once for each epoch that takes them, with ``_epoch`` from 1.

    ``domain`` and ``tokens`` (whole, not under 0) are expressions over the
    rows; ``budget`` is a number of tokens or, as a float, a share of all there
    are.  Null languages and sources are leaves of their own.  Of the last epoch
    of a leaf the documents are taken whose prefix starts inside the rest, so
    the last one may overrun it.  Rows with equal doc_ids stand together in the
    order and are taken or left together.  Documents without tokens are taken
    with whole epochs and when their place comes before the cut.  All columns of
    ``docs`` come back as they are; ``_domain``, ``_tokens`` and ``_epoch`` follow,
    each with one more underscore in front as long as ``docs`` has a column of that name."""
    held = {c: f"c{k}" for k, c in enumerate(docs.columns)}  # no name of theirs can clash with one of this job
    rows = docs.select(*(docs[f"`{c}`"].alias(x) for c, x in held.items()), docs["doc_id"].alias("_id"), docs["lang"], docs["source"],
                       domain.alias("_domain"), tokens.cast("bigint").alias("_tokens"))
    rows = rows.withColumn("_leaf", F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
                                                       for c in ("_domain", "lang", "source"))))
    narrow = written(rows.select("_id", "_leaf", "_tokens", F.col("_domain").alias("domain"), "lang", "source"), "tokens")
    leaves = written(narrow.groupBy(*LEVELS, "_leaf").agg(F.sum("_tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total * budget) if isinstance(budget, float) else budget
    quotas = leaf_quotas(leaves, min(budget, total * epochs), weights, epochs)
    same = [quotas[c].eqNullSafe(leaves[c]) for c in LEVELS]
    plan = written(leaves.join(quotas, same).select(
        leaves["_leaf"], leaves["tokens"].alias("_a"), quotas["quota"].alias("_q")).selectExpr(
        "_leaf", "_q div _a as _whole", "_q % _a as _rest"), "quotas")
    # the order of each leaf's last epoch, as far as its rest
    last = (narrow.join(plan.where("_rest > 0"), "_leaf")
            .select("_leaf", "_tokens", "_rest", _key(seed, F.col("_whole") + 1).alias("_key")))
    # equal doc_ids have equal keys: one place
    last = last.groupBy("_leaf", "_key").agg(F.sum("_tokens").alias("_tokens"), F.max("_rest").alias("_rest"))
    cut = (running(last, ["_key"], "_tokens", "_leaf", "mix").where("_before < _rest")
           .groupBy("_leaf").agg(F.max("_key").alias("_cut")))
    plan = written(plan.join(cut, "_leaf", "left"), "plan")
    if plan.count() <= BROADCAST_LEAVES:  # then the texts need no shuffle; beyond it AQE splits hot leaves
        plan = F.broadcast(plan)
    taken = rows.join(plan, "_leaf").withColumn("_n", F.col("_whole") + F.coalesce(
        (_key(seed, F.col("_whole") + 1) <= F.col("_cut")).cast("bigint"), F.lit(0)))
    taken = taken.where("_n > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return taken.select(*(F.col(x).alias(c) for c, x in held.items()),
                        *(F.col(c).alias(_free(c, docs.columns)) for c in ("_domain", "_tokens", "_epoch")))
