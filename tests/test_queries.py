"""Every query with SQL against DuckDB on the same tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in entry.oracle_sql().items() if k.startswith("q_")}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    theirs = sorted(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns) for r in want.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_every_query_has_sql():
    assert {k for k in entry.queries() if k.startswith("q_")} == set(SQL)


def test_report_complement_reads_the_texts_once(spark):
    plan = entry.queries()["q_report_complement"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_audit_lists_read_the_texts_once(spark):
    plan = entry.queries()["q_audit_lists"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
