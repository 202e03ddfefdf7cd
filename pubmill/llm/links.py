"""Connected components over a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, mark, materialize, release


def _to_least(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v) with the least neighbour m of u, u itself included; a node of very many links is joined by broadcast."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows")).select("u", F.least("u", "m").alias("m"), "rows")
    return heavy_join(pairs, least, ["u"], "rows", total)


def _digest(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b): comp is the least node reached.

    Large-star and small-star steps alternate, each a grouped minimum and an
    equi-join, until a round changes nothing; nothing is gathered in one place.
    Self links and repeated links are harmless; an empty table gives no rows.
    """
    spark, since = links.sparkSession, mark()
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, 2 * before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "edges")
        small = _to_least(large, before[0])
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = materialize(moved.where("u <> v").distinct(), "edges")
        release(spark, since, edges)
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots.select("node", F.col("node").alias("comp")))
