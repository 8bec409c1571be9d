"""Every registered query against its SQL counterpart, as multisets of rows."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from daymark.queries import ORACLES, QUERIES
from daymark.queries.inputs import SCHEMAS, table


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) == 71
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    kinds = dict(zip(columns, [str(d[1]) for d in want.description]))
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    assert {c: same[t] for c, t in got.dtypes} == kinds
    expected = _rows(columns, want.fetchall())
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == expected
    assert expected or name == "rep_never_stocked"


def test_declared_schemas_are_those_of_the_files(spark, sf_dir):
    for name in SCHEMAS:
        assert table(spark, sf_dir, name).schema == spark.read.parquet(f"{sf_dir}/{name}.parquet").schema


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["cat", "f_cnt"]
    assert df.count() > 0
