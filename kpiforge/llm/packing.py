"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut; full pieces are sequences of their
own.  The other pieces are ranked by length over range partitions and dealt in
turn to buckets of a few thousand, so all buckets have nearly the same lengths.

A bucket starts with best-fit decreasing and is then evolved on several islands,
one task each: a child takes whole well-filled bins of one parent, the bins of
the other parent that hold any of their documents are dissolved, which removes
the duplicates, and the displaced documents are put where they fit best.  After
each epoch the islands hand their elite to the next island.  A bucket whose bins
can't get fewer (a lower bound is reached), be it at the start, takes no further
part, and an epoch has tasks only for the buckets that do.

The sequences of all buckets that are far from full are then dissolved together
and packed again as one problem of fewer pieces, as long as that saves any.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import encoder, per_slice
from .ordered import running
from .storage import written

CAPACITY = 2048
BUCKET, ISLANDS, EPOCHS = 4096, 4, 3
POPULATION, CHILDREN, ELITE = 8, 24, 2
FAR_FROM_FULL, PASSES = 0.95, 3

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long,ids:array<int>>>"


# -- documents to pieces

def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first takes what full pieces leave over."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(spark: SparkSession, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False):
    """A column function: the pieces of a text under the tokenizer file's
    content, which is broadcast (its size is that of the vocabulary).  Each
    document ends with id 0; a null or empty text is that id alone."""
    sent = spark.sparkContext.broadcast(tokenizer)
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                               ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))]))

    def setup():
        bpe = encoder(sent.value)

        def each(texts: list[str]) -> pa.Array:
            out = []
            for ids in bpe.arrays(texts):
                ids = np.append(ids, np.uint32(0)).astype("<u4", copy=False)
                out.append([{"piece": k, "start": at, "length": n, "ids_crc32": zlib.crc32(ids[at:at + n].tobytes()),
                             "ids": ids[at:at + n].astype(np.int32) if with_ids else None}
                            for k, (at, n) in enumerate(cuts(len(ids), capacity))])
            return pa.array(out, kind)

        return each

    return per_slice(setup, PIECES)


# -- one bucket; ``sizes`` is in falling order, a packing is the bin of each item

def least_bins(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """A lower bound for the bins that ``counts`` items of each size need: for
    every k, items over capacity - k stand alone, those over half can't share,
    and the others down to k fill at best what is left beside them."""
    held = np.zeros(capacity + 1, np.int64)
    np.add.at(held, sizes, counts)
    number, weight = np.cumsum(held), np.cumsum(held * np.arange(capacity + 1))
    half, k = capacity // 2, np.arange(1, capacity // 2 + 1)
    alone = number[-1] - number[capacity - k]
    large, large_weight = number[capacity - k] - number[half], weight[capacity - k] - weight[half]
    small_weight = weight[half] - weight[k - 1]
    more = np.maximum(0, -(-(small_weight - (large * capacity - large_weight)) // capacity))
    return int((alone + large + more).max(initial=0))


def best_fit(sizes: np.ndarray, items: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> int:
    """Put ``items``, in their order, each into the bin with the least room that
    holds it; bin k has ``room[k]``, new ones are opened at the end.  Writes
    ``bins`` and returns the number of bins."""
    open_ = sorted((r, k) for k, r in enumerate(room) if r)
    n = len(room)
    for i, size in zip(items.tolist(), sizes[items].tolist()):
        at = bisect_left(open_, (size, -1))
        if at < len(open_):
            left, k = open_.pop(at)
        else:
            left, k, n = capacity, n, n + 1
        bins[i] = k
        if left > size:
            insort(open_, (left - size, k))
    return n


def numbered(bins: np.ndarray) -> np.ndarray:
    """The same packing with bins 0, 1, ... without gaps."""
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes, minlength=int(bins.max()) + 1)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """The mean square fill of the bins: few full and few nearly empty ones."""
    return float(((fills(sizes, bins) / capacity) ** 2).mean())


def crossover(sizes: np.ndarray, one: np.ndarray, other: np.ndarray, capacity: int, rnd: random.Random) -> np.ndarray:
    """A child of two packings: whole well-filled bins of ``other`` go into
    ``one``; its bins that share a document with them are dissolved, a few of
    its emptiest ones as well, and what was displaced is best-fitted."""
    fill = fills(sizes, other)
    best = np.argsort(-fill, kind="stable")[:max(1, len(fill) // 2)]
    chosen = rnd.sample(best.tolist(), rnd.randint(1, len(best)))
    injected = np.isin(other, chosen)
    fill = fills(sizes, one)
    hit = np.zeros(len(fill), bool)
    hit[one[injected]] = True
    hit[np.argsort(fill, kind="stable")[:rnd.randint(0, 3)]] = True
    displaced = hit[one] & ~injected
    child = np.where(injected, other + len(fill), one)
    kept = ~displaced
    child[kept] = numbered(child[kept])
    room = (capacity - fills(sizes[kept], child[kept]).astype(int)).tolist() if kept.any() else []
    items = np.flatnonzero(displaced)  # falling sizes
    if rnd.random() < 0.5 and len(items) > 2:  # or falling but for some noise
        items = items[np.argsort(-sizes[items] * (1 + 0.2 * np.array([rnd.random() for _ in items])), kind="stable")]
    best_fit(sizes, items, child, room, capacity)
    return child


def first_packing(sizes: np.ndarray, capacity: int, order: np.ndarray | None = None) -> np.ndarray:
    bins = np.zeros(len(sizes), np.int32)
    best_fit(sizes, np.arange(len(sizes)) if order is None else order, bins, [], capacity)
    return bins


def evolve(sizes: np.ndarray, elite: list[np.ndarray], bound: int, capacity: int, rnd: random.Random) -> list[np.ndarray]:
    """An epoch of an island: its best packings, the best one first.  Without
    an elite it starts from best-fit decreasing and noisy orders.  Ends as soon
    as a packing has ``bound`` bins."""
    def order():
        return np.argsort(-sizes * (1 + 0.3 * np.array([rnd.random() for _ in sizes])), kind="stable")

    def value(bins):
        return -(int(bins.max()) + 1), fitness(sizes, bins, capacity)

    flock = [np.asarray(e, np.int32) for e in elite] or [first_packing(sizes, capacity)]
    if -value(flock[0])[0] > bound:
        flock += [first_packing(sizes, capacity, order()) for _ in range(POPULATION - len(flock))]
        flock.sort(key=value, reverse=True)
        for _ in range(CHILDREN):
            if -value(flock[0])[0] <= bound:
                break
            one, other = rnd.sample(range(len(flock)), 2)
            child = crossover(sizes, flock[min(one, other)], flock[max(one, other)] if rnd.random() < 0.5 else flock[rnd.randrange(len(flock))],
                              capacity, rnd)
            flock = sorted(flock + [child], key=value, reverse=True)[:POPULATION]
    return flock[:ELITE]


def _start(capacity: int):
    """The packing that all islands of a bucket start from, its bins and their lower bound."""
    kind = pa.struct([("first", pa.list_(pa.int32())), ("bins", pa.int32()), ("bound", pa.int32())])

    @F.arrow_udf("struct<first:array<int>,bins:int,bound:int>")
    def run(sizes: pa.Array) -> pa.Array:
        out = []
        for s in sizes:
            s = np.array(s.as_py(), np.int64)
            first = first_packing(s, capacity)
            out.append({"first": first, "bins": int(first.max()) + 1, "bound": least_bins(s, np.ones(len(s), np.int64), capacity)})
        return pa.array(out, kind)
    return run


def _island(capacity: int):
    @F.arrow_udf("struct<elite:array<array<int>>,bins:int,bound:int>")
    def run(bucket: pa.Array, island: pa.Array, epoch: pa.Array, sizes: pa.Array, elite: pa.Array) -> pa.Array:
        out = []
        for b, i, e, s, best in zip(*(c.to_pylist() for c in (bucket, island, epoch, sizes, elite))):
            s = np.array(s, np.int64)
            bound = least_bins(s, np.ones(len(s), np.int64), capacity)
            got = evolve(s, best or [], bound, capacity, random.Random(f"{b}|{i}|{e}"))
            out.append({"elite": got, "bins": int(got[0].max()) + 1, "bound": bound})
        kind = pa.struct([("elite", pa.list_(pa.list_(pa.int32()))), ("bins", pa.int32()), ("bound", pa.int32())])
        return pa.array(out, kind)
    return run


def _places(ranks: str, sizes: str, bins: str) -> Column:
    """Each item's bin, its offset there and the bin's fill."""
    kind = pa.list_(pa.struct([("_row", pa.int64()), ("bin", pa.int32()), ("offset", pa.int64()), ("fill", pa.int64())]))

    @F.arrow_udf("array<struct<_row:long,bin:int,offset:long,fill:long>>")
    def run(ranks: pa.Array, sizes: pa.Array, bins: pa.Array) -> pa.Array:
        out = []
        for rank, size, at in zip(*(c.to_pylist() for c in (ranks, sizes, bins))):
            fill, offsets = [0] * len(at), []
            for n, k in zip(size, at):
                offsets.append(fill[k])
                fill[k] += n
            out.append([{"_row": r, "bin": k, "offset": o, "fill": fill[k]} for r, k, o in zip(rank, at, offsets)])
        return pa.array(out, kind)

    return run(ranks, sizes, bins)


def _pack(items: DataFrame, n: int, capacity: int) -> DataFrame:
    """``items`` (_row, length; _place, their places by falling length from 0)
    packed bucket by bucket: _row, length, bucket, bin, offset, fill."""
    buckets = -(-n // BUCKET)
    # every bucket gets each `buckets`-th item: BUCKET items at most
    dealt = (items.select((F.col("_place") % buckets).alias("bucket"), "_place", "_row", "length")
             .groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("_place", "_row", "length"))).alias("i"))
             .select("bucket", F.col("i._row").alias("ranks"), F.col("i.length").alias("sizes")))
    dealt = written(dealt.withColumn("s", _start(capacity)("sizes")).select("bucket", "ranks", "sizes", "s.*"), "pack-buckets")
    going = dealt.where("bins > bound").count()  # buckets that take part in the next epoch
    island, state = _island(capacity), None
    done = [dealt.where("bins <= bound").select("bucket", F.col("first").alias("bins"))]
    for epoch in range(EPOCHS):
        if not going:
            break
        if state is None:
            flock = dealt.where("bins > bound").select("bucket", "sizes", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"),
                                                       F.array("first").alias("elite"))
        else:  # an island's own elite and that of the island before it
            sent = state.select("bucket", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("guests"))
            flock = (state.join(sent, ["bucket", "island"]).join(dealt.select("bucket", "sizes"), "bucket")
                     .select("bucket", "sizes", "island", F.concat("elite", "guests").alias("elite")))
        # a task for each few islands: one of them is seconds of work, few bytes
        flock = flock.repartition(min(going * ISLANDS, 100_000), "bucket", "island")
        got = written(flock.select("bucket", "island", island("bucket", "island", F.lit(epoch), "sizes", "elite").alias("g"))
                      .select("bucket", "island", "g.*"), "pack-islands")
        best = got.groupBy("bucket").agg(F.min("bins").alias("least"), F.max("bound").alias("bound"))
        ended = best.where(F.lit(epoch == EPOCHS - 1) | (F.col("least") <= F.col("bound")))
        done.append(got.join(ended, "bucket").where("bins = least").groupBy("bucket").agg(
            F.min_by(F.col("elite")[0], "island").alias("bins")))
        state = got.join(best.where(F.col("least") > F.col("bound")).select("bucket"), "bucket").select("bucket", "island", "elite")
        if epoch < EPOCHS - 1:
            going = best.where("least > bound").count()
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    placed = dealt.select("bucket", "ranks", "sizes").join(found, "bucket").select("bucket", F.inline(_places("ranks", "sizes", "bins")))
    return written(placed.select("_row", "bucket", "bin", "offset", "fill"), "pack-placed")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences for pieces (columns doc_id, piece, length and any others but
    those that start with ``_``): the same rows with sequence_id and offset.

    Pieces of a sequence stand from offset 0 without gaps and have at most
    ``capacity`` ids together.  Rows are taken as they are: a doc_id may be null or occur
    several times, and equal rows are packed each.  No rows give no rows."""
    rows = cut.withColumn("_one", F.lit(1)).withColumn("_salt", F.monotonically_increasing_id())
    ranked = running(rows, [F.col("length").desc(), "doc_id", "piece", "_salt"], "_one", name="pack-pieces")
    counts = ranked.groupBy("length").count().collect()  # at most `capacity` rows
    if over := [r["length"] for r in counts if not 0 < r["length"] <= capacity]:
        raise ValueError(f"lengths {over[:3]} are not in 1..{capacity}")
    full = sum(r["count"] for r in counts if r["length"] == capacity)
    n = sum(r["count"] for r in counts) - full
    whole = ranked.where(F.col("length") == capacity).select(
        "_row", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = ranked.where(F.col("length") < capacity).select("_row", (F.col("_row") - full).alias("_place"), "length")
    least = least_bins(np.array([r["length"] for r in counts if r["length"] < capacity], np.int64),
                       np.array([r["count"] for r in counts if r["length"] < capacity], np.int64), capacity)
    parts, at = [whole], 0
    if n:
        placed, at = _pack(items, n, capacity), 1
        used = placed.where("offset = 0").count()
        while used > least and n > BUCKET and at < PASSES:
            loose = placed.where(F.col("fill") < FAR_FROM_FULL * capacity)
            moved, freed = loose.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
            if freed < 2 or moved == n:
                break
            again = running(loose.join(items.select("_row", "length"), "_row").select(F.col("_row").alias("_id"), "length", F.lit(1).alias("_one")),
                            [F.col("length").desc(), "_id"], "_one", name="pack-loose")
            fresh = _pack(again.select(F.col("_id").alias("_row"), F.col("_row").alias("_place"), "length"), moved, capacity)
            need = fresh.where("offset = 0").count()
            if need >= freed:
                break
            parts.append(_sequences(placed.where(F.col("fill") >= FAR_FROM_FULL * capacity), at))
            placed, used, n, least, at = fresh, need, moved, max(0, least - (used - freed)), at + 1
        parts.append(_sequences(placed, at))
    where = parts[0]
    for part in parts[1:]:
        where = where.unionAll(part)
    return ranked.join(where, "_row").drop("_row", "_before", "_one", "_salt")


def _sequences(placed: DataFrame, at: int) -> DataFrame:
    """Sequence numbers from the pass, the bucket and the bin (under 2^13)."""
    number = F.lit(at).cast("long") * (1 << 60) + F.col("bucket") * (1 << 13) + F.col("bin")
    return placed.select("_row", number.alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents (doc_id, text) in sequences: a row per piece with doc_id,
    piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end mark alone; a text of any length is
    encoded whole; repeated rows are packed each; no rows give no rows; other
    columns are ignored, whatever their names."""
    cut = pieces(docs.sparkSession, tokenizer, capacity)
    rows = docs.select("doc_id", F.inline(cut(F.col("text")))).drop("ids")
    return pack(written(rows, "pack-cut"), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids and the offset
    at which each document's piece starts.  Needs unique doc_ids; a sequence's
    pieces are ``capacity`` at most."""
    cut = pieces(docs.sparkSession, tokenizer, capacity, with_ids=True)
    rows = docs.select("doc_id", F.inline(cut(F.col("text")))).select("doc_id", "piece", "ids")
    placed = packed.select("doc_id", "piece", "sequence_id", "offset").join(rows, ["doc_id", "piece"])
    made = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return made.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
