"""Queries with SQL equal DuckDB at sf0.01, types included; the entry point lists all of them."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from linebeam.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(*cols).collect()))) == sorted(map(str, want))
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert kinds == {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
