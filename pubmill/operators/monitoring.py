"""Process search, per-key state, calendars, grids and the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pubmill.functions import text as T

#: Digits of a process number in groups, up to five separators between groups, no digit on either side.
PROCESS = r"(?<![0-9])[0-9]{5}[^0-9]{0,5}[0-9]{6}[^0-9]{0,5}[0-9]{4}[^0-9]{0,5}[0-9]{2}(?![0-9])"


def process_hits(pubs: DataFrame, portfolio: DataFrame) -> DataFrame:
    """(process, pub_id, n_hits) of monitored 17-digit numbers in pubs (pub_id, text): candidates by pattern, then an equi-join."""
    found = pubs.select("pub_id", F.explode(F.regexp_extract_all("text", F.lit(PROCESS), F.lit(0))).alias("raw"))
    counted = found.groupBy("pub_id", T.digits(F.col("raw")).alias("process")).agg(F.count("*").alias("n_hits"))
    return counted.join(portfolio, "process").select("process", "pub_id", "n_hits")


def process_summary(portfolio: DataFrame, hits: DataFrame) -> DataFrame:
    """Every monitored process with its totals, those without a hit included."""
    agg = hits.groupBy("process").agg(F.count("*").alias("n_pubs"), F.sum("n_hits").alias("n_hits"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return portfolio.join(agg, "process", "left").select("process", zero("n_pubs"), zero("n_hits"), F.when(F.col("n_pubs") > 0, "FOUND").otherwise("NOT_FOUND").alias("status"))


def inherit(rows: DataFrame, group: str, order: str, titled: Column, value: str) -> DataFrame:
    """Rows without a title take the value of the last titled row before them in their group."""
    before = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    parent = F.last(F.when(titled, F.col(value)), ignorenulls=True).over(before)
    return rows.withColumn("parent", F.when(titled, F.col(value)).otherwise(parent))


def business_day(day: Column) -> Column:
    return F.dayofweek(day).between(2, 6)


def calendar(df: DataFrame, day: str, *keys: str) -> DataFrame:
    """Every business day between a key's first and last day."""
    spans = df.groupBy(*keys).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return spans.select(*keys, F.explode(F.sequence("lo", "hi")).alias(day)).where(business_day(F.col(day)))


def coverage_gaps(days: DataFrame, covered: DataFrame, *on: str) -> DataFrame:
    return days.join(covered.select(*on).distinct(), list(on), "left_anti")


def advance(state: DataFrame, day: Column, validated: DataFrame) -> DataFrame:
    """The monotone watermark with gap block: a gap over one day blocks every key, unless validated.

    ``state`` has (key, last). Returns key, last, next, verdict; ``next`` moves only
    if no key is blocked.
    """
    marked = state.join(validated.select("key", F.lit(True).alias("ok")), "key", "left")
    gap = F.datediff(day, F.col("last"))
    blocked = (F.col("last").isNull() | (gap > 1)) & F.col("ok").isNull()
    verdict = F.when(blocked, "BLOCKED").when(gap <= 0, "KEPT").otherwise("ADVANCED")
    any_blocked = marked.agg(F.coalesce(F.max(blocked.cast("int")), F.lit(0)).alias("stop"))  # one row
    out = marked.withColumn("verdict", verdict).crossJoin(F.broadcast(any_blocked))
    return out.select("key", "last", F.when((F.col("stop") == 0) & (F.col("verdict") == "ADVANCED"), day).otherwise(F.col("last")).alias("next"), "verdict")


def sync(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """Portfolio sync of held (key, active) with wanted (key): new, kept, removed, returned, inactive."""
    j = held.withColumn("h", F.lit(True)).join(wanted.select("key", F.lit(True).alias("w")), "key", "full_outer")
    status = F.when(F.col("h").isNull(), "NEW").when(F.col("w").isNull() & F.col("active"), "REMOVED").when(F.col("w").isNull(), "INACTIVE").when(F.col("active"), "KEPT").otherwise("RETURNED")
    return j.select("key", status.alias("status"))


def outbox(found: DataFrame, sent: DataFrame) -> DataFrame:
    """Pending items of found (key, ord, payload): each key once, its first payload, never one already sent."""
    first = found.groupBy("key").agg(F.min_by("payload", "ord").alias("payload"), F.count("*").alias("seen"))
    return first.join(sent.select("key"), "key", "left_anti")


def difference(left: DataFrame, right: DataFrame, only_left: str, only_right: str) -> DataFrame:
    """Rows of one side that the other lacks, with the side's name; both have the same columns, each row once."""
    keys = left.columns
    return left.join(right, keys, "left_anti").withColumn("side", F.lit(only_left)).unionByName(right.join(left, keys, "left_anti").withColumn("side", F.lit(only_right)))
