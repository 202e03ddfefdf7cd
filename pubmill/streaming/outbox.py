"""Streaming forms of the outbox and of windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_items(stream: DataFrame, key: str = "key", at: str = "ts", late: str = "7 days") -> DataFrame:
    """Each key once within the watermark; the sink may replay a batch, the key makes that harmless."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def daily_counts(stream: DataFrame, at: str, *keys: str, late: str = "1 day") -> DataFrame:
    day = F.window(at, "1 day")
    return stream.withWatermark(at, late).groupBy(day.alias("day"), *keys).agg(F.count("*").alias("n"))
