"""Queries against their SQL in DuckDB, rows and types."""

import os

import duckdb
import pytest

from skein.llm import queries

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", ["op12_centroids", "op13_periodic_runs"])
def test_rows_are_those_of_the_sql(spark, sf, name):
    with duckdb.connect() as con:
        for file in os.listdir(sf):
            con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
        rel = con.sql(queries.ORACLES[name])
        want, columns, types = rel.fetchall(), rel.columns, [str(t) for t in rel.types]
    df = queries.QUERIES[name](spark, sf)
    assert df.columns == columns and [KINDS[k] for _, k in df.dtypes] == types
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr) and want
