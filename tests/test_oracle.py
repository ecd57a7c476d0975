"""Every registered query against its independent DuckDB SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quire.plans.queries import QUERIES
from quire.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
# SQL has no tokenizer, and whole texts are too long for its common subsequence: tests of their own hold these against brute force.
NO_SQL = {"e5_doc_rouge_l", "t1_subword"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) - NO_SQL <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["domain", "n"] and len(rows) >= 1
