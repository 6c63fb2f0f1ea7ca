"""Every operator query with a SQL counterpart gives the same rows, columns and types as DuckDB."""

import glob
import os

import duckdb
import pytest

from postlens.llm.catalog import ORACLES, QUERIES

ALIKE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, sf, key):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    cursor = connection.execute(ORACLES[key])
    names = [c[0] for c in cursor.description]
    frame = QUERIES[key](spark, sf)
    assert {c: ALIKE[t] for c, t in frame.dtypes} == {c[0]: str(c[1]).upper() for c in cursor.description}
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in frame.collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_runs_over_all_rows(spark, sf, key):
    table = {"op2": "pages", "op6": "pages", "op8": "embeddings", "op13": "embeddings"}.get(key.split("_")[0], "documents")
    rows = QUERIES[key](spark, sf).count()
    if key.startswith("op13"):
        assert rows == 4 * spark.read.parquet(f"{sf}/{table}.parquet").count()
    elif not key.startswith(("op7", "op10", "op12")):
        assert rows == spark.read.parquet(f"{sf}/{table}.parquet").count()
