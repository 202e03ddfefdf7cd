"""Mixing sources to target weights with hash-threshold histograms.

A source's budget is its target rounded to whole words. Whole passes over the
source come first; the rest of the budget goes to the documents of least hash.
Instead of sorting, sizes are summed by (source, hash bucket); the running sums
of a source's buckets give the threshold bucket in which the budget ends, and
only the documents of that bucket are summed again, by the next hash digits.
After three levels of 4096 buckets the few documents of the boundary are put in
order. Documents below the threshold are taken once more, the boundary document
gives the words still missing, and a filter on the hash does the rest.

Built-in functions only. Cases: null and empty texts have size 0 and are taken
for 0 words; null sources are one source, last in order; sources without words
have target 0; repeated rows (same id and text) share a hash and are ordered by
nothing else, so such a group at the boundary gives its words in equal parts up
to rounding down; an empty table gives no rows; further columns are not used by
``mix_plan`` and kept by ``mix``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialize

#: Weights of the sources in order, repeating; most passes over a source; hash digits of a level.
WEIGHTS, MOST, DIGITS, LEVELS = (5, 2, 1), 3, 3, 3


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target from (source, source_size), one row a source.

    The caps depend on each other, so all sources pass one task in order: some tens of
    bytes each, sorted with spilling, which holds for millions of sources.

    Sources reach their cap in order of cap / weight. With the earlier ones at
    their caps the rest is shared by weight; the first source whose share is no
    more than its cap ends the caps, and that share per weight holds from it on.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("long")
    t = sizes.withColumn("weight", weight).withColumn("cap", F.lit(MOST) * F.col("source_size"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("words", F.sum("source_size").over(W.partitionBy()))
    t = t.withColumn("rest", F.col("words") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    t = t.withColumn("weights", F.sum("weight").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)))
    t = t.withColumn("open", F.col("rest") * F.col("weight") <= F.col("cap") * F.col("weights"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "rest", "weights"))).over(W.partitionBy())
    t = t.withColumn("first", first)
    share = (F.col("weight") * F.col("first.rest")).cast("double") / F.col("first.weights").cast("double")
    return t.select("source", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """row, doc_id, size, source, source_size, target and taken of each document (doc_id, source, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text.alias("text"))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text")))
    sized = source.select("doc_id", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), key.alias("h"))
    sized = materialize(sized, "sizes")
    cell = [F.substring("h", 1 + DIGITS * k, DIGITS).alias(f"b{k}") for k in range(LEVELS)]
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    targets = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    targets = materialize(targets.withColumn("left", budget - F.col("passes") * F.col("source_size")), "targets")

    # One level at a time: the bucket in which what is left of a budget ends.
    edge = targets.where("`left` > 0").select("source", "left")
    names: list[str] = []
    for k in range(LEVELS):
        names.append(f"b{k}")
        on = [F.col("d.source").eqNullSafe(F.col("e.source")), *(F.col(f"d.{n}") == F.col(f"e.{n}") for n in names[:-1])]
        inside = sized.select("source", "size", *cell[: k + 1]).where("size > 0").alias("d").join(edge.alias("e"), reduce(lambda a, b: a & b, on))
        sums = inside.groupBy(*(F.col(f"d.{n}").alias(n) for n in ["source", *names]), F.col("e.left").alias("left")).agg(F.sum("d.size").alias("size"))
        run = F.sum("size").over(W.partitionBy("source").orderBy(names[-1]))
        sums = sums.withColumn("run", run).where("run >= `left` and run - size < `left`")
        edge = materialize(sums.select("source", *names, (F.col("left") - F.col("run") + F.col("size")).alias("left")), "edge")
    at = edge.select(F.col("source"), F.concat(*names).alias("edge"), "left")
    last = sized.where("size > 0").alias("d").join(at.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.substring("d.h", 1, DIGITS * LEVELS) == F.col("e.edge")))
    last = last.groupBy(F.col("d.source").alias("source"), F.col("d.h").alias("h"), F.col("e.left").alias("left")).agg(F.sum("d.size").alias("size"), F.count("*").alias("rows"))
    last = last.withColumn("run", F.sum("size").over(W.partitionBy("source").orderBy("h"))).where("run >= `left` and run - size < `left`")
    plan = targets.alias("t").join(last.select(F.col("source").alias("s"), F.col("h").alias("edge"), F.floor((F.col("left") - F.col("run") + F.col("size")) / F.col("rows")).cast("long").alias("part")), F.col("t.source").eqNullSafe(F.col("s")), "left")
    plan = materialize(plan.select("source", "source_size", "target", "passes", "edge", "part"), "plan")

    more = F.when(F.col("d.h") < F.col("p.edge"), F.col("d.size")).when(F.col("d.h") == F.col("p.edge"), F.col("p.part")).otherwise(F.lit(0))
    joined = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    return joined.select("d.h", "d.doc_id", "d.source", "d.size", "p.source_size", "p.target", (F.col("d.size") * F.col("p.passes") + more).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: a row for each whole pass, and the part of a boundary document.

    Documents without words stay once; they cost the mix nothing.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
    plan = mix_plan(docs).select(F.col("h").alias("__h"), F.col("size").alias("__size"), F.col("taken").alias("__taken")).distinct()
    joined = docs.withColumn("__h", key).join(plan, "__h")
    whole = F.when(F.col("__size") == 0, F.lit(1)).otherwise(F.floor(F.col("__taken") / F.col("__size"))).cast("int")
    part = F.when(F.col("__size") == 0, F.lit(0)).otherwise(F.col("__taken") % F.col("__size")).cast("int")
    full = joined.withColumn("__n", F.explode(F.array_repeat(F.lit(1), whole)))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, part), " ")
    rest = joined.where(part > 0).withColumn("text", cut).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes).get("n_chars", "long")))
    return full.select(*docs.columns).unionByName(rest.select(*docs.columns))


def op9_hash_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix."""
    plan = mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(trim(coalesce(text, ''), E' \t\n\x0b\x0c\r'), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s),
f AS (SELECT rest, weights FROM r WHERE rest * weight <= cap * weights ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, (weight * f.rest)::DOUBLE / f.weights::DOUBLE) AS target FROM r, f),
b AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size)::BIGINT ELSE 0 END AS passes FROM t),
g AS (SELECT source, h, sum(size)::BIGINT AS size, count(*) AS n FROM d WHERE size > 0 GROUP BY source, h),
c AS (SELECT source, h, size, n, sum(size) OVER (PARTITION BY source ORDER BY h) - size AS before FROM g),
m AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, d.size * b.passes AS base, b.budget - b.passes * b.source_size AS left_over, c.before, c.size AS total, c.n
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.h = d.h AND d.size > 0)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (base + CASE WHEN total IS NULL OR before >= left_over THEN 0 WHEN before + total < left_over THEN size
     ELSE floor((left_over - before) / n) END)::BIGINT AS taken
FROM m
"""
