"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, rotated onto their principal axes and then by a
learned rotation that brings the axes near the corners of a cube (alternating
sign and Procrustes steps); a code holds a sign bit an axis. Mean and rotation
are learned from at most ``SAMPLE`` vectors of the commonest length, in ``SAMPLE_BYTES``, those of least id hash; all vectors
are indexed.

Search: a code is split into m substrings of 8 bits, each with its own table from
value to rows. If two codes within a Hamming radius r = m * a + b differed in more
than a bits in each of the first b + 1 substrings and in more than a - 1 in each of
the rest, they would differ in more than r bits; so probing the tables for the values
within these distances retrieves every code within r. Full distances leave those
within r, and cosines on the original vectors rank them. A query starts with radius
``FIRST``; from the k-th best cosine found so far follows how many bits codes of that
angle differ in, and the radius grows to that and ``MARGIN`` standard deviations, or
until k codes are found. So close neighbours cost few probes, and far ones are found
alike at every size.

Queries are a stated set against all rows: rows are dealt into blocks of bounded
bytes and queries into chunks, each pair is one task, and a query keeps its k best of
each block and then of all. Cases: rows with a null id, repeated ids after the least
vector, and vectors null, empty, zero or with null or non-finite components take no
part; components of any finite size are compared without overflow (each vector is
scaled by a power of two, which changes no cosine); vectors of another length than
the index was learned for are compared plainly with those of their own length; ties
go to the smaller vec_id; an empty table gives no rows; further columns are not used.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

#: Vectors learned from, and their bytes, at most.
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
#: Bytes of a block's vectors at most, blocks of a smaller table, rows below which no block is split, and queries of a chunk.
BYTES, BLOCKS, LEAST, QUERIES = 64 << 20, 16, 2048, 1 << 16
#: First radius as a share of the code's bits, standard deviations added to the expected distance, and rounds of learning.
FIRST, MARGIN, ROUNDS = 0.25, 1.3, 30
_POP = np.array([bin(x).count("1") for x in range(256)], np.uint8)
_BY_DISTANCE = [np.flatnonzero(_POP <= r).astype(np.uint8) for r in range(9)]


def learn(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions x bits; bits a multiple of 8, 64 at most)."""
    sample = _scaled(sample)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    dims = x.shape[1]
    bits = max(8, min(64, dims // 8 * 8))
    mean = x.mean(0)
    _, axes = np.linalg.eigh(np.cov((x - mean).T, bias=True).reshape(dims, dims))
    axes = axes[:, ::-1][:, :bits]
    rng = np.random.default_rng(7)
    if axes.shape[1] < bits:  # fewer axes than bits: random directions fill the code
        axes = np.hstack([axes, rng.normal(size=(dims, bits - axes.shape[1]))])
    flat = (x - mean) @ axes
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        u, _, w = np.linalg.svd(np.sign(flat @ turn).T @ flat)
        turn = (u @ w).T
    return mean, axes @ turn


def encode(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Codes as rows of bytes."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.packbits((unit - model[0]) @ model[1] > 0, axis=1)


class MultiIndex:
    """The substring tables of one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.counts = [np.bincount(c, minlength=256) for c in codes.T]
        self.starts = [np.cumsum(n) - n for n in self.counts]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs in ``radius`` bits at most."""
        hit = np.zeros(len(self.codes), bool)
        most, more = divmod(radius, self.codes.shape[1])
        for k, (own, order, counts, starts) in enumerate(zip(code, self.order, self.counts, self.starts, strict=True)):
            if most - (k > more) < 0:
                continue
            values = _BY_DISTANCE[min(8, most - (k > more))] ^ own
            n = counts[values]
            at = np.repeat(starts[values] - np.cumsum(n) + n, n) + np.arange(n.sum())
            hit[order[at]] = True
        rows = np.flatnonzero(hit)
        return rows[_POP[self.codes[rows] ^ code].sum(1) <= radius]


def expected_radius(cosine: float, bits: int) -> int:
    """Bits that codes of this cosine differ in, and MARGIN standard deviations more."""
    share = float(np.arccos(np.clip(cosine, -1, 1)) / np.pi)
    return int(np.ceil(bits * share + MARGIN * np.sqrt(bits * share * (1 - share))))


def _scaled(v: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two so that the largest component is between 0.5 and 1."""
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1))[1][:, None])


def _found(index: MultiIndex, code: np.ndarray, best, k: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """``best`` (rows, scores) of the codes within a radius that grows as far as the k-th best score asks for."""
    bits = index.codes.shape[1] * 8
    while True:
        rows, scores = best(index.within(code, radius))
        if radius >= bits:
            return rows, scores
        wanted = expected_radius(scores[k - 1], bits) if len(rows) >= k else radius + max(1, bits // 16)
        if wanted <= radius:
            return rows, scores
        radius = min(bits, wanted)


def _block(rows: pd.DataFrame, queries: pd.DataFrame, model, k: int, first: float) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    lengths = queries["v"].map(len).to_numpy() if len(queries) else np.empty(0)
    for dims in np.unique(lengths):
        own = rows[rows["v"].map(len) == dims] if len(rows) else rows
        if not len(own):
            continue
        ids, x = own["vec_id"].to_numpy(), _scaled(np.stack(own["v"].to_numpy()).astype(float))
        norms = np.linalg.norm(x, axis=1)
        asked = queries[lengths == dims]
        y = _scaled(np.stack(asked["v"].to_numpy()).astype(float))
        indexed = dims == len(model[0])
        index, codes = (MultiIndex(encode(x, model)), encode(y, model)) if indexed else (None, None)
        for j, (q, v) in enumerate(zip(asked["vec_id"].to_numpy(), y, strict=True)):

            def best(found, q=q, v=v):
                found = found[ids[found] != q]
                # summed row by row, so equal vectors have equal scores in every block
                score = (x[found] * v).sum(axis=1) / (norms[found] * np.linalg.norm(v))
                order = np.lexsort((ids[found], -score))[:k]
                return found[order], score[order]

            held, score = _found(index, codes[j], best, k, int(first * index.codes.shape[1] * 8)) if indexed else best(np.arange(len(ids)))
            out["query_id"] += [q] * len(held)
            out["vec_id"] += ids[held].tolist()
            out["score"] += score.tolist()
    return pd.DataFrame(out)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, first: float = FIRST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` found for each row of ``queries`` (vec_id, v)."""
    spark = vectors.sparkSession
    n, size = vectors.agg(F.count("*"), F.coalesce(F.sum(F.size("v")), F.lit(0)) * 8).first()
    m = queries.count()
    # from the table alone, so that every cluster gives the same neighbours
    row_blocks, query_blocks = max(1, -(-size // BYTES), min(BLOCKS, n // LEAST)), max(1, -(-m // QUERIES))
    common = vectors.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = common["dims"] if common else 0
    most = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * max(1, dims))))
    sample = vectors.where(F.size("v") == dims).orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("v").collect()  # bounded
    model = learn(np.array([r.v for r in sample], float)) if sample else (np.empty(0), np.empty((0, 8)))
    shared = spark.sparkContext.broadcast(model)
    block = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    left = vectors.select("vec_id", "v", block(row_blocks).alias("r"), every(query_blocks).alias("q"))
    right = queries.select("vec_id", "v", every(row_blocks).alias("r"), block(query_blocks).alias("q"))
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInPandas(lambda a, b: _block(a, b, shared.value, k, first), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, v as doubles) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    return rows.where(finite).groupBy("vec_id").agg(F.min("v").alias("v"))


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose vec_id is divisible by 50."""
    rows = materialize(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "vectors")
    return nearest(rows, rows.where("vec_id % 50 = 0"))
