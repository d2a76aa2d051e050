"""Corpus queries that SQL expresses return the same rows in DuckDB."""

import duckdb
import pytest

from strandline.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{DIR}/documents.parquet')")
    rel = con.sql(queries.ORACLES[name])
    df = queries.QUERIES[name](spark, DIR).select(*rel.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, rel.fetchall()))
