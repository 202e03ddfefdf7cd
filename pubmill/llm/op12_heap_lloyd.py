"""Vector code compression by product codebooks, fitted with heap-ordered Lloyd rounds.

Whole-number vectors are cut into equal parts; each part position has a codebook, and a
code holds the number of each part's nearest entry. Rounds assign every part
exactly (squared distances in whole numbers, ties to the lower number) and move
entries to their parts' floored means.

A part keeps one number, its key: lower bound to any other entry minus distance to its own when it was
last scanned, plus its entry's drift up to then. An entry's drift grows each round by its own
move and the largest move of another. While the key exceeds the drift, no other entry
can have come nearer. Tasks hold, for each entry, a heap of their parts by key and pop
only those whose bound the drift has passed; these are scanned again against the
whole codebook. Keys are rounded down and drifts up, so equal distances are always
scanned.

A round reads and writes one table (in the shared folder), without a shuffle; what
moved travels as one row of sums a task's batch and entry it touched, summed again by Spark, so the driver
holds the codebooks and their sums only. Their size follows entries and vector
length.

Cases: vectors null, empty, with null or non-finite components, or of another length
than the commonest take no part; the first entries are the rows of least vec_id, ties
by vector, null ids last, each row one entry, and fewer rows give fewer entries; repeated
rows count each; a length that the parts do not divide is filled up with zeros; components
of any finite size work (a floor that no long holds becomes the nearest long, an error
that none holds null, and then so is its label's sum); a table without labels counts as one of
null labels; an empty table gives no rows; further columns are not used.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import heavy_join, mark, materialize, release, turn_to
from .vectors import halves, largest, matrices, matrix, whole, whole_vectors

#: Entries of a codebook (256 at most, for two hex digits), parts of a vector, rounds, and the factor of the whole numbers.
ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Share by which keys are rounded down and drifts up, far above rounding errors.
MARGIN = 1e-9
#: Parts scanned at a time.
CHUNK = 4096
_STATE = "vec_id long, label string, x array<long>, entry array<int>, key array<double>, error decimal(38,0), part int, at int, n long, high array<long>, low array<long>"
_OUT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


class Books(NamedTuple):
    """A codebook a part position, each entry's drift since the first round, and entries' counts and sums."""

    entries: list[np.ndarray]
    drift: list[np.ndarray]
    counts: list[np.ndarray]
    sums: list[np.ndarray]


def _exact(x: np.ndarray, book: np.ndarray) -> bool:
    """Whether all squared distances between the two are exact in double precision."""
    return x.shape[1] * (2 * max(largest(x), largest(book))) ** 2 < 2**53


def _squares(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Exact squared distances of rows of longs, with Python's integers."""
    return [sum((int(p) - int(q)) ** 2 for p, q in zip(v, w, strict=True)) for v, w in zip(a, b, strict=True)]


def _scan_large(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``scan`` for longs of any size: entries that extended precision cannot tell apart are compared exactly."""
    own, first, second = np.empty(len(x), np.int64), np.empty(len(x)), np.full(len(x), np.inf)
    wide = book.astype(np.longdouble)
    for i, v in enumerate(x):
        d = ((v.astype(np.longdouble) - wide) ** 2).sum(1)
        close = np.flatnonzero(d <= d.min() * (1 + 1e-15))
        own[i] = close[int(np.argmin(np.array(_squares(np.broadcast_to(v, (len(close), len(v))), book[close]), object)))]
        first[i] = np.sqrt(d[own[i]])
        d[own[i]] = np.inf
        second[i] = np.sqrt(d.min())
    return own, first, second


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the nearest entry, the distance to it and that to the next (infinite without one)."""
    if not _exact(x, book):
        return _scan_large(x, book)
    own, first, second = np.empty(len(x), np.int64), np.empty(len(x)), np.full(len(x), np.inf)
    real = book.astype(float)
    own_squares, turned = (real * real).sum(1), -2 * real.T
    for at in range(0, len(x), CHUNK):
        rows = x[at : at + CHUNK].astype(float)
        d = rows @ turned + own_squares  # whole numbers all through, so exact in any order
        i = np.arange(len(rows))
        best = d.argmin(1)
        squares = (rows * rows).sum(1)
        own[at : at + len(rows)], first[at : at + len(rows)] = best, np.sqrt(d[i, best] + squares)
        if len(book) > 1:
            d[i, best] = np.inf
            second[at : at + len(rows)] = np.sqrt(d.min(1) + squares)
    return own, first, second


def keys_of(first: np.ndarray, second: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Slack less a margin, from the entry's drift on."""
    alone = np.isinf(second)  # an only entry is never left
    next_ = np.where(alone, first, second)
    found = drift * (1 - MARGIN) + next_ - first
    return np.where(alone, np.inf, found - MARGIN * (np.abs(found) + first + next_ + 1))


def violated(entry: np.ndarray, key: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Places of parts whose key their entry's drift has reached, popped from a heap an entry."""
    heaps: dict[int, list[tuple[float, int]]] = {}
    for i, (own, k) in enumerate(zip(entry.tolist(), key.tolist(), strict=True)):
        heaps.setdefault(own, []).append((k, i))
    out = []
    for own, heap in heaps.items():
        heapq.heapify(heap)
        while heap and heap[0][0] <= drift[own]:
            out.append(heapq.heappop(heap)[1])
    return np.array(sorted(out), np.int64)


def assign(x: np.ndarray, book: np.ndarray, drift: np.ndarray, entry: np.ndarray | None, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries and keys of parts x now, and the places that were scanned: all of them the first time."""
    if entry is None:
        own, first, second = scan(x, book)
        return own, keys_of(first, second, drift[own]), np.arange(len(x))
    entry, key = entry.astype(np.int64), key.copy()
    again = violated(entry, key, drift)
    if len(again):
        own, first, second = scan(x[again], book)
        entry[again], key[again] = own, keys_of(first, second, drift[own])
    return entry, key, again


def _moves(x: np.ndarray, was: np.ndarray | None, now: np.ndarray, entries: int) -> Iterator[tuple]:
    """(entry, count, high, low) by which each touched entry's count and sum change."""
    moved = np.arange(len(x)) if was is None else np.flatnonzero(was != now)
    signs = [(now[moved], 1)] if was is None else [(now[moved], 1), (was[moved], -1)]
    n, high, low = np.zeros(entries, np.int64), np.zeros((entries, x.shape[1]), np.int64), np.zeros((entries, x.shape[1]), np.int64)
    up, down = halves(x[moved])
    touched = np.zeros(entries, bool)
    for at, sign in signs:
        np.add.at(n, at, sign)
        np.add.at(high, at, sign * up)
        np.add.at(low, at, sign * down)
        touched[at] = True
    for e in np.flatnonzero(touched):
        yield int(e), int(n[e]), high[e].tolist(), low[e].tolist()


def _errors(x: np.ndarray, own: np.ndarray) -> list[int]:
    if _exact(x, own):
        d = x - own
        return (d * d).sum(1).tolist()
    return _squares(x, own)


def _round(state: DataFrame, books: Books, parts: int, first: bool, last: bool) -> DataFrame:
    """The state with every part assigned to ``books``, and rows (part, at, n, high, low) of what moved; the last round gives errors."""
    shared = state.sparkSession.sparkContext.broadcast(books)
    dims = sum(b.shape[1] for b in books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        entries, drift, _, _ = shared.value
        for batch in (part for whole_batch in batches for part in matrices(whole_batch, dims)):
            if not len(batch):
                continue
            x = matrix(batch["x"], dims).reshape(len(batch), parts, -1)
            was = None if first else matrix(batch["entry"], parts)
            keys = None if first else matrix(batch["key"], parts)
            now, key, moves, errors = np.empty((len(batch), parts), np.int32), np.empty((len(batch), parts)), [], [0] * len(batch)
            for p in range(parts):
                own = np.ascontiguousarray(x[:, p])
                now[:, p], key[:, p], _ = assign(own, entries[p], drift[p], None if first else was[:, p], None if first else keys[:, p])
                if last:
                    errors = [a + b for a, b in zip(errors, _errors(own, entries[p][now[:, p]]), strict=True)]
                else:
                    moves += [(p, *m) for m in _moves(own, None if first else was[:, p], now[:, p], len(entries[p]))]
            yield _rows(batch, now, key, errors if last else None, moves)

    return state.select("vec_id", "label", "x", "entry", "key").mapInArrow(run, _STATE)


def _rows(batch: pa.RecordBatch, now: np.ndarray, key: np.ndarray, errors: list[int] | None, moves: list[tuple]) -> pa.RecordBatch:
    n, m = len(batch), len(moves)
    lists = lambda a: pa.ListArray.from_arrays(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32), a.ravel())
    longs = pa.list_(pa.int64())
    both = lambda kept, more, kind: pa.concat_arrays([kept.cast(kind), more.cast(kind)])
    part, at, count, high, low = zip(*moves, strict=True) if moves else ((),) * 5
    wide = pa.decimal128(38, 0)
    error = pa.nulls(n, wide) if errors is None else pa.array([Decimal(e) if e < 10**38 else None for e in errors], wide)
    columns = {
        "vec_id": both(batch["vec_id"], pa.nulls(m, pa.int64()), pa.int64()),
        "label": both(batch["label"], pa.nulls(m, pa.string()), pa.string()),
        "x": both(batch["x"], pa.nulls(m, longs), longs),
        "entry": both(lists(now), pa.nulls(m, pa.list_(pa.int32())), pa.list_(pa.int32())),
        "key": both(lists(key), pa.nulls(m, pa.list_(pa.float64())), pa.list_(pa.float64())),
        "error": both(error, pa.nulls(m, wide), wide),
        "part": both(pa.nulls(n, pa.int32()), pa.array(part, pa.int32()), pa.int32()),
        "at": both(pa.nulls(n, pa.int32()), pa.array(at, pa.int32()), pa.int32()),
        "n": both(pa.nulls(n, pa.int64()), pa.array(count, pa.int64()), pa.int64()),
        "high": both(pa.nulls(n, longs), pa.array(high, longs), longs),
        "low": both(pa.nulls(n, longs), pa.array(low, longs), longs),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def start(rows: DataFrame, dims: int, parts: int, entries: int) -> Books:
    """The first codebooks: that part of the rows of least vec_id."""
    found = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # at most as many as entries
    x = np.array([r.x for r in found], np.int64).reshape(len(found), parts, -1)
    books = [np.ascontiguousarray(x[:, p]) for p in range(parts)]
    return Books(books, [np.zeros(len(b)) for b in books], [np.zeros(len(b), np.int64) for b in books], [np.zeros(b.shape, object) for b in books])


def moved(books: Books, state: DataFrame) -> Books:
    """Entries at the floored means of their parts after a round, and their drift; unused ones stay."""
    width = books.entries[0].shape[1]
    place = lambda c: [F.sum(F.get(c, F.lit(j))).alias(f"{c}{j}") for j in range(width)]
    changes = state.where("part is not null").groupBy("part", "at").agg(F.sum("n").alias("n"), *place("high"), *place("low"))
    counts, sums = [c.copy() for c in books.counts], [s.copy() for s in books.sums]
    for r in changes.collect():  # at most one for each entry
        counts[r["part"]][r["at"]] += r["n"]
        sums[r["part"]][r["at"]] += np.array([whole(r[f"high{j}"], r[f"low{j}"]) for j in range(width)], object)
    entries, drifts = [], []
    for book, drift, n, s in zip(books.entries, books.drift, counts, sums, strict=True):
        new = book.copy()
        for e in np.flatnonzero(n):
            new[e] = [int(v) // int(n[e]) for v in s[e]]
        # the difference of two longs may be none
        far = np.sqrt(((new.astype(np.longdouble) - book.astype(np.longdouble)) ** 2).sum(1)).astype(float)
        most = np.sort(far)[::-1]
        other = np.where(far == most[0], most[1] if len(far) > 1 and (far == most[0]).sum() == 1 else most[0], most[0]) if len(far) > 1 else np.zeros(1)
        entries.append(new)
        drifts.append((drift + far + other) * (1 + MARGIN))
    return Books(entries, drifts, counts, sums)


def compress(table: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, entry numbers, error as a decimal) of each vector of (vec_id, embedding, label) that takes part, and the codebooks."""
    spark = table.sparkSession
    label = F.col("label").cast("string") if "label" in table.columns else F.lit(None).cast("string")
    rows, dims = whole_vectors(table, scale, label.alias("label"))
    if not dims:
        return spark.createDataFrame([], "vec_id long, label string, entry array<int>, error decimal(38,0)"), []
    short = -dims % parts
    rows = rows.withColumn("x", F.concat("x", F.array(*[F.lit(0).cast("long")] * short))) if short else rows
    since = mark()
    state = materialize(rows.select("vec_id", "label", "x", F.lit(None).cast("array<int>").alias("entry"), F.lit(None).cast("array<double>").alias("key")), "parts")
    books = start(state, dims + short, parts, entries)
    for k in range(rounds + 1):
        written = materialize(_round(state, books, parts, k == 0, k == rounds), "parts")
        if k < rounds:
            books = moved(books, written)
        state = written.where("part is null")
        release(spark, since, written)
    return state.select("vec_id", "label", "entry", "error"), books.entries


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimals, by part, entry and place."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def op12_heap_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's code, its error and its label's."""
    rows, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    if not books:
        return spark.createDataFrame([], _OUT)
    code = F.concat(*(F.lower(F.lpad(F.hex(F.get("entry", F.lit(p))), 2, "0")) for p in range(PARTS)))
    # labels as keys that are never null
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))
    out = rows.select("vec_id", code.alias("code"), F.col("error").try_cast("long").alias("error"), key.alias("label"))
    long_sum = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long"))
    sums = out.groupBy("label").agg(long_sum.alias("label_error"), F.count("*").alias("rows"))
    joined = heavy_join(out, sums, ["label"], "rows")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
