"""Every query against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from skein.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9))) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_rows_are_those_of_the_sql(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    rel = duck.sql(catalogue.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    at = [rel.columns.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == want and got, f"{len(got)} and {len(want)} rows"


def test_clusters_are_not_all_single(spark):
    rows = catalogue.split_clusters(spark, "/root/testdata/sf0.01").groupBy("cluster").count().where("count > 1")
    assert rows.count() > 0 and catalogue.median_merges(spark, "/root/testdata/sf0.01").count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_other_queries_have_rows(spark, sf):
    for name in set(catalogue.QUERIES) - set(catalogue.ORACLES):
        assert catalogue.QUERIES[name](spark, sf).count() > 0
