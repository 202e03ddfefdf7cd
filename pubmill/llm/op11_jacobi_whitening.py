"""Embedding whitening by one-sided Jacobi SVD.

The fit list is each distinct whole-number vector once. Blocks of its centred rows are
reduced to triangular factors (QR), a task's blocks one after the other and the tasks'
factors in a tree, so that one small R with the same singular values and right
vectors is left (tall and skinny QR). Plane rotations then make R's columns orthogonal to
each other, all disjoint pairs of a round at a time; the rotations multiplied up are
the components, and the columns' norms the standard deviations times sqrt(n). No
covariance matrix is formed, so small deviations keep their digits.

Counts and sums are exact, and so is the centring: n * x - S in whole numbers, with
Python's where a long is too short. The driver holds sums, R and components, whose
size follows the vectors' length alone.

Cases: vectors null, empty, with null or non-finite entries, or of another length
than the commonest take no part; repeated rows count once in the fit list and each
give rows of their own; null ids are kept; vectors of fewer entries than components
are asked for have as many components as entries; a component without variance has
whitened null and explained 0 (null where no component has any), and identity_error
covers the others (null if there is none); a deviation that no long holds is null there
and whole in deviation_wide; an empty table gives no rows; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, turn_to
from .sketch import _filled, _in_tree
from .vectors import halves, largest, matrices, matrix, whole, whole_vectors

#: Components returned, and the factor of the whole numbers.
COMPONENTS, SCALE = 4, 256
#: Rows of a QR block at least, and rounds over all pairs of columns at most.
ROWS, SWEEPS = 1024, 60
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_wide decimal(38,0), deviations array<double>"


class Model(NamedTuple):
    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    variances: np.ndarray


def jacobi_svd(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (columns) and singular values of r, largest first."""
    a, dims = np.array(r, float), r.shape[1]
    v = np.eye(dims)
    eps = np.finfo(float).eps
    nothing = eps * np.sqrt((a * a).sum())
    order = np.arange(dims + dims % 2)  # an odd column out meets none
    half = len(order) // 2
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(order) - 1):
            p, q = order[:half], order[half:][::-1]
            p, q = p[(real := (p < dims) & (q < dims))], q[real]
            x, y = a[:, p], a[:, q]
            nx, ny, xy = np.sqrt((x * x).sum(0)), np.sqrt((y * y).sum(0)), (x * y).sum(0)
            turn = (np.abs(xy) > dims * eps * nx * ny) & (nx > nothing) & (ny > nothing)
            if turn.any():
                turned = True
                p, q, x, y = p[turn], q[turn], x[:, turn], y[:, turn]
                ratio = (ny[turn] - nx[turn]) * (ny[turn] + nx[turn]) / (2 * xy[turn])
                tan = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1, ratio))
                cos = 1 / np.hypot(1, tan)
                sin = cos * tan
                a[:, p], a[:, q] = cos * x - sin * y, sin * x + cos * y
                x, y = v[:, p], v[:, q]
                v[:, p], v[:, q] = cos * x - sin * y, sin * x + cos * y
            order = np.r_[order[0], order[-1], order[1:-1]]
        if not turned:
            break
    values = np.sqrt((a * a).sum(0))
    values[values <= nothing] = 0
    down = np.argsort(-values, kind="stable")
    return v[:, down], values[down]


def column_sums(lists: DataFrame, dims: int) -> tuple[int, list[int]]:
    """How many rows x has, and each place's exact sum; a task gives one row a place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for part in (part for batch in batches for part in matrices(batch, dims)):
            up, down = halves(matrix(part["x"], dims))
            n, high, low = n + len(part), high + up.sum(0), low + down.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(np.full(dims, n)), pa.array(high), pa.array(low)], ["place", "n", "high", "low"])

    parts = lists.select("x").mapInArrow(run, "place int, n long, high long, low long")
    rows = parts.groupBy("place").agg(F.sum("n"), F.sum("high"), F.sum("low")).orderBy("place").collect()  # one a place
    return (rows[0][1], [whole(r[2], r[3]) for r in rows]) if rows else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly."""
    most = max(map(abs, sums), default=0)
    kind = np.int64 if n * largest(x) + most < 2**62 else object
    return n * x.astype(kind) - np.array(sums, kind)


def triangular(lists: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows' QR, by blocks and then in a tree."""
    dims = len(sums)
    block = max(ROWS, 4 * dims)
    fold = lambda r, rows: np.linalg.qr(np.vstack([r, rows]), mode="r") if len(rows) else r
    empty = lambda: np.empty((0, dims))
    pack = lambda r: np.ascontiguousarray(r).tobytes()

    def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        r = empty()
        for part in (part for batch in batches for part in matrices(batch, dims)):
            rows = centred(matrix(part["x"], dims), n, sums).astype(float) / n
            for at in range(0, len(rows), block):
                r = fold(r, rows[at : at + block])
        return np.vstack([r, np.zeros((dims - len(r), dims))])

    tasks = lists.rdd.getNumPartitions()
    made = _in_tree(_filled(lists.select("x"), lambda b: fill(b).ravel(), dims * dims, pack), tasks, lambda r, part: fold(r, np.frombuffer(part).reshape(-1, dims)), empty, pack)
    found = made.select("counts").first()  # one factor, as wide as the vectors are long
    return np.frombuffer(bytes(found[0])).reshape(-1, dims) if found else np.zeros((dims, dims))


def fit(lists: DataFrame, dims: int, components: int = COMPONENTS) -> Model:
    """Mean, components and standard deviations of the rows x."""
    n, sums = column_sums(lists, dims)
    v, values = jacobi_svd(triangular(lists, n, sums))
    k = min(components, dims)
    return Model(n, sums, v[:, :k], values[:k] / np.sqrt(n), (values / np.sqrt(n)) ** 2)


def _project(rows: DataFrame, model: Model) -> DataFrame:
    """vec_id, deviation, wide and w, the whitened entries by component (NaN without variance), of rows (vec_id, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    dims = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        n, sums, axes, sigma, _ = shared.value
        for part in (part for batch in batches for part in matrices(batch, dims)):
            c = centred(matrix(part["x"], dims), n, sums)
            fits = dims * largest(c) ** 2 < 2**63 if c.dtype != object else False
            squares = (c * c).sum(1) if fits else (c.astype(object) ** 2).sum(1)
            real = c.astype(float) / n
            # summed row by row, so equal vectors have equal entries in every batch
            w = np.stack([(real * axis).sum(1) / s if s else np.full(len(c), np.nan) for axis, s in zip(axes.T, sigma, strict=True)], 1)
            yield pa.RecordBatch.from_arrays(
                [
                    part["vec_id"],
                    pa.array([int(s) if s < 2**63 else None for s in squares], pa.int64()) if not fits else pa.array(squares),
                    pa.array([str(s) for s in squares] if not fits else [None] * len(c), pa.string()),
                    pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel()),
                ],
                ["vec_id", "deviation", "wide", "w"],
            )

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, wide string, w array<double>")


def identity_error(lists: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = [i for i, s in enumerate(model.deviations) if s]
    if not k:
        return None
    w = _project(lists.select(F.lit(None).cast("long").alias("vec_id"), "x"), model)
    pairs = [(i, j) for i in k for j in k if i <= j]
    found = w.agg(*(F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row for each vector of (vec_id, embedding) that takes part and component; see the columns in ``_OUT``.

    deviations are the components' standard deviations, in units of x.
    """
    spark = table.sparkSession
    rows, dims = whole_vectors(table, scale)
    if not dims:
        return spark.createDataFrame([], _OUT)
    lists = materialize(rows.select("x").distinct(), "fit")
    model = fit(lists, dims, components)
    off, total = identity_error(lists, model), float(model.variances.sum())
    number = lambda c: F.lit(c).cast("double")
    shares = F.array(*(number(float(v) / total if total else None) for v in model.variances[: len(model.deviations)]))
    out = _project(rows, model).select("vec_id", "deviation", "wide", F.posexplode("w").alias("at", "w"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.when(~F.isnan("w"), F.col("w")).alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        number(off).alias("identity_error"),
        F.coalesce(F.col("deviation").cast("decimal(38,0)"), F.col("wide").try_cast("decimal(38,0)")).alias("deviation_wide"),
        F.array(*(number(float(s)) for s in model.deviations)).alias("deviations"),
    )


def op11_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's first four whitened entries."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
