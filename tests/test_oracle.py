"""Every query with oracle SQL agrees with DuckDB on sf0.001 (fast subset of the driver check)."""

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"label_propagation", "small_communities", "pagerank", "pagerank_top"}


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return "NULL" if v is None else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query_matches_duckdb(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order_s = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    order_d = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    got = sorted("|".join(_norm(r[i]) for i in order_s) for r in sdf.collect())
    want = sorted("|".join(_norm(r[i]) for i in order_d) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [r.kind for r in sorted(rows, key=lambda r: r.kind)] == ["max", "min"]
