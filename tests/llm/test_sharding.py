"""Byte shards against a plain running sum, and the running sum itself."""

import random
import zlib

from kpiforge.llm import sharding
from kpiforge.llm.ordered import running
from kpiforge.llm.queries import op10_sharding


def brute(rows, n):
    rows = sorted(((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, at, out, slots = sum(r[2] for r in rows), 0, [], {}
    for i, crc, size in rows:
        shard = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((i, size, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    return out


def check(spark, rows, n):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, shard string, slot int")
    got = sorted(map(tuple, sharding.assign_shards(docs, n).collect()), key=str)
    assert got == sorted(brute(rows, n), key=str)


def test_against_a_running_sum(spark):
    rnd = random.Random(3)
    check(spark, [(i, "é" * rnd.randint(0, 30) if i % 3 else "word " * rnd.randint(0, 9)) for i in range(500)], 7)


def test_nulls_ties_long_and_repeated_rows(spark):
    check(spark, [(1, None), (1, None), (None, "a"), (2, ""), (2, "x" * 100_000), (3, "b"), (3, "b"), (3, "c")], 4)


def test_few_rows_and_none(spark):
    check(spark, [(5, "a")], 16)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.assign_shards(docs).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = op10_sharding(spark, d)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {r["law"] for r in got.select("law").distinct().collect()} == {"bytes"}
    docs = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    rows = got.select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, rows)) == sorted(brute(docs, 16))


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(300)], "doc_id long, text string")
    at = sharding.write_shards(docs, str(tmp_path / "s"), 4, 20)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select("doc_id", "text").collect())) == sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, back.select("doc_id", "shard", "slot").collect())) == \
        sorted(map(tuple, at.select("doc_id", "shard", "slot").collect()))


def test_running_by_group_with_a_hot_group(spark):
    rows = [(f"g{0 if i % 3 else i % 7}", i, i % 11) for i in range(2000)]
    got = running(spark.createDataFrame(rows, "g string, i long, v long"), ["i"], "v", "g").collect()
    sums, counts, want = {}, {}, {}
    for g, i, v in sorted(rows):
        want[(g, i)] = (sums.get(g, 0), counts.get(g, 0))
        sums[g], counts[g] = sums.get(g, 0) + v, counts.get(g, 0) + 1
    assert {(r["g"], r["i"]): (r["_before"], r["_row"]) for r in got} == want
