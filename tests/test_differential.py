"""Every registered query against its DuckDB twin at sf0.001 (rows, columns,
values; doubles are already rounded to 6 places by both sides)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from kpiforge.plans import registry as E
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_a_twin():
    missing = sorted(set(E.queries()) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_twin(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = duck.sql(E.oracle_sql()[name])
    dcols = rel.columns
    assert sorted(dcols) == cols
    drows = sorted(tuple(_norm(r[dcols.index(c)]) for c in cols) for r in rel.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    import __spark_entry__
    df = __spark_entry__.entry(spark)
    assert df.columns == ["year", "quarter", "revenue_sp", "reviews_ge4_share", "lead_time_p90",
                          "on_time_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_twin_through_pandas(spark, duck, name):
    """Same check through the pandas clients (toPandas vs DuckDB .df()):
    column dtype kinds and text of every value agree."""
    sp = E.queries()[name](spark, SF001).toPandas()
    dd = duck.sql(E.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dd.columns)
    sp, dd = sp[cols], dd[cols]
    assert [sp[c].dtype.kind for c in cols] == [dd[c].dtype.kind for c in cols]
    assert (sorted(map(tuple, sp.astype(str).values.tolist()))
            == sorted(map(tuple, dd.astype(str).values.tolist())))
