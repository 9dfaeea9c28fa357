"""Every registered query equals its SQL oracle (DuckDB) at sf0.01."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from linebeam.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"
SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["user_raw", "comment_raw"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, cur.fetchall())
    spark_types = {f.name: SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    sql_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()}
    assert spark_types == sql_types
