"""Every query with SQL must return the same rows in Spark and DuckDB."""

import importlib

import duckdb
import pytest

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
catalog = importlib.import_module("strandline.plans.catalog")
importlib.import_module("strandline.plans.domain")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return str(v) if v is not None else None


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    rel = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_without_sql_return_rows(spark, name):
    assert catalog.QUERIES[name](spark, DIR).count() > 0
