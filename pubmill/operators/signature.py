"""Signatures of whole tables as trees of digests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digests that are put together in one place, about.
LEAF = 4096


def tree_signature(rows: DataFrame, item: Column, *by: str, leaf: int = LEAF) -> DataFrame:
    """(by, signature) of each group's items, whatever their order and partitioning; an item's number of copies counts.

    Items are digested, the digests put together by as many leading digits as leave about
    ``leaf`` in a place, and the places' digests put together digit by digit up to the root. So no row
    holds more than a place's digests.
    """
    digests = rows.select(*by, F.sha2(F.coalesce(item.cast("string"), F.lit("")).cast("binary"), 256).alias("d")).groupBy(*by, "d").agg(F.count("*").alias("n"))
    most = digests.groupBy(*by).count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    levels = max(1, math.ceil(math.log(max(1, most) / leaf, 16)))
    joined = lambda parts, sep: F.sha2(F.array_join(F.array_sort(F.collect_list(parts)), sep).cast("binary"), 256).alias("d")
    nodes = digests.groupBy(*by, F.substring("d", 1, levels).alias("at")).agg(joined(F.concat("d", F.lit(":"), F.col("n").cast("string")), ","))
    for k in reversed(range(levels)):
        # children of one length, so that order is by place
        nodes = nodes.groupBy(*by, F.substring("at", 1, k).alias("up")).agg(joined(F.concat("at", "d"), "")).withColumnRenamed("up", "at")
    return nodes.select(*by, F.col("d").alias("signature"))
