"""What the operators on vectors share: whole numbers from components, and columns of lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A list column's values that a worker turns into one matrix at a time.
VALUES = 1 << 20


def whole_vectors(table: DataFrame, scale: int, *more) -> tuple[DataFrame, int]:
    """(vec_id, x, *more) and the length of x: floor(scale * component), as longs, of the vectors that take part.

    Vectors null, empty or holding null or non-finite components, and those of another
    length than the commonest (ties: the shorter) take no part. A component whose floor
    no long holds becomes the nearest long.
    """
    v = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("__v"), *more).where(F.size("__v") > 0)
    rows = rows.where(F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    common = rows.groupBy(F.size("__v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common else 0
    x = F.transform("__v", lambda c: F.floor(c * F.lit(float(scale))))
    return rows.where(F.size("__v") == dims).withColumn("x", x).drop("__v"), dims


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def matrices(batch: pa.RecordBatch, width: int):
    """Parts of a batch of some VALUES values of a list of ``width``."""
    step = max(1, VALUES // max(1, width))
    yield from (batch.slice(at, step) for at in range(0, len(batch), step))


def largest(x: np.ndarray) -> int:
    """The largest absolute value, 0 of none."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longs as high and low parts, x = high * 2 ** 32 + low, whose sums do not overflow."""
    return x >> 32, x & 0xFFFFFFFF


def whole(high: int, low: int) -> int:
    return (int(high) << 32) + int(low)
