"""What the query modules share: the table of queries, and how they register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n(c="*") -> Column:
    return F.count(c).cast("bigint")


def values(rows) -> str:
    """Rows of a VALUES list."""
    return ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in rows)


def norm_sql(c: str) -> str:
    """The SQL of ``normalise``."""
    return rf"trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(coalesce({c}, '')),'[^\x00-\x7F]','','g')),'[^\w\s]',' ','g'),'\s+',' ','g'))"
