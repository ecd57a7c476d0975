"""The registered queries: one per operator and the pipeline, and DuckDB SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as entry
from quire.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    columns = [c[0] for c in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, res.fetchall()))
