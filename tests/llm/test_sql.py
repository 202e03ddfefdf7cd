"""The corpus queries with SQL, against DuckDB on the same tables."""

import duckdb
import pytest

from pubmill.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(ORACLE_SQL[name])
    names = sorted(c[0] for c in want.description)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == names
    theirs = sorted(map(str, want.df()[names].itertuples(index=False, name=None)))
    assert sorted(map(str, got.select(*names).toPandas().itertuples(index=False, name=None))) == theirs and theirs
