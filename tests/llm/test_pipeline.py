"""Every stage against a plain version of itself on the rows it was given."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_compression_rules import plain_bands, verdict  # noqa: E402
from test_jaccard_join import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from kpiforge.llm import queries as Q  # noqa: E402
from kpiforge.llm import sentencepiece, toxicity  # noqa: E402
from kpiforge.llm.storage import written  # noqa: E402

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stage_names_and_columns(tables):
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
    assert all(t.columns == COLUMNS for t in tables[:-1])


def test_toxicity_stage(spark, tables):
    lex = Q.toxicity_lexicon(spark, SF)
    score = lambda t: toxicity.score_of(lex, toxicity.density(lex, t or "")[1])
    kept = [r for r in rows(tables[0]) if score(r[1]) < 0.3]
    assert rows(tables[1]) == kept and 0 < len(kept) < tables[0].count()


def test_quality_stage(tables):
    bands = plain_bands([r[1] or "" for r in rows(tables[1])])  # learned from what the stage is given
    assert rows(tables[2]) == [r for r in rows(tables[1]) if verdict(r[1] or "", bands)[1]]


def test_near_copy_stage(tables):
    component = {i: c for i, _, c in brute([(r[0], r[1]) for r in rows(tables[2])])}
    assert rows(tables[3]) == [r for r in rows(tables[2]) if component[r[0]] == r[0]]


def test_mixing_stage(tables):
    con = duckdb.connect()
    documents = tables[3].toPandas()
    con.register("documents", documents)
    want = con.sql(Q.oracle_sql()["op3_mixing"]).fetchall()
    times = {}
    for r in want:
        times[r[0]] = times.get(r[0], 0) + 1
    assert rows(tables[4]) == sorted((r for r in rows(tables[3]) for _ in range(times.get(r[0], 0))), key=str)


def test_encoding_stage(tables):
    seg = sentencepiece.Segmenter(sentencepiece.load(Q.PIECE_MODEL))
    got = sorted((r["doc_id"], r["lang"], r["source"], tuple(r["ids"]), r["n_ids"]) for r in tables[5].collect())
    want = sorted((i, lang, source, tuple(seg.encode(t).tolist()), len(seg.encode(t))) for i, t, lang, source, _ in rows(tables[4]))
    assert got == want


def test_run_is_the_last_stage(spark, tables):
    got = P.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], tuple(r["ids"])) for r in df.collect())
    assert key(got) == key(tables[5])


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, stage):
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b c", "en", "", 5), (2, "", "", None, 0),
           (3, "word " * 30_000, "en", "src1", 1), (4, "x" * 200_000, "de", "src1", 1)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        got = P.STAGES[stage][1](spark, df, SF)
        n = got.count()
        assert n <= len(odd) * Q.EPOCHS and (df is docs or n == 0)
        if stage < 4:
            assert got.columns == COLUMNS
