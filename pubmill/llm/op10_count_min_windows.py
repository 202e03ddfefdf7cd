"""Substring dedup: words covered by a window that also starts elsewhere.

A window is ``size`` consecutive words. Each window is filed under its anchor,
the least hash of its inner grams: equal windows have equal anchors, and an
anchor serves a run of windows, so there are about nine times fewer anchor runs
than words.

1. Every partition counts its anchor runs in a count-min sketch, sized from the
   bytes of the texts up to ``WIDTH_BITS``; the merged sketch never underestimates.
2. A second pass compares the windows of a slice of some megabytes with each other.
   Windows whose anchor is estimated repeated go on, by run; a window repeated
   within the slice sends one witness for all its copies, so a hot passage costs a
   row per slice.
3. Windows are grouped by anchor and hash, 64 bits each and both compared; those met
   twice come back as intervals of window starts, which join their documents. Rows
   arrive sorted by anchor, and a task holds a batch and one anchor's rows at a time, up
   to ``HELD``. A common anchor (one sentence in ever other surroundings) has more: what
   repeats within ``HELD`` rows is settled at once, and the distinct windows left go on,
   each under its own hash, to meet those of the anchor's other parts. So a task is
   linear in its rows and holds a bounded part of them.

When the input outgrows the largest sketch, more windows take part in step 3; none is
ever lost. Cases: null and empty texts have no words and lose none; texts shorter
than a window lose none unless a window fits; repeated rows count as separate
documents, so all their windows repeat; null ids are kept; an empty table gives
no rows; further columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, gram_hashes, mix, slices, turn_to, word_hashes
from .sketch import count_min, seen_twice, width_for

WINDOW, INNER = 35, 20


def _least_within(h: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours, by doubling."""
    span, out = 1, h
    while span * 2 <= n:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = n - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(words: np.ndarray, size: int, inner: int) -> np.ndarray:
    """The anchor of each window, in order."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    return _least_within(gram_hashes(words, inner), size - inner + 1)


def _batch_words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in batch["text"]:
        yield word_hashes((text.as_py() or "").encode("utf-8", "surrogatepass"))


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs; same[i]: i goes on from i - 1."""
    starts = np.flatnonzero(~same)
    return starts, np.r_[starts[1:], len(same)] if len(starts) else starts


def _grouped(key: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (key, h) are neighbours, and where each group of them starts.

    Sorted by one sum of both, and parted where either differs: sums that agree by
    chance never make different windows equal.
    """
    order = np.argsort(mix(key) + h, kind="stable")
    k, w = key[order], h[order]
    return order, np.r_[True, (k[1:] != k[:-1]) | (w[1:] != w[:-1])][: len(key)]


def _windows(batch: pa.RecordBatch, planes: list[bytes], size: int, inner: int) -> Iterator[tuple]:
    """Rows (key, row, start, end, hashes): known intervals without hashes, runs and witnesses with them."""
    keys, hashes, counts = [], [], []
    for words in _batch_words(batch):
        keys.append(anchors(words, size, inner))
        hashes.append(gram_hashes(words, size))
        counts.append(len(keys[-1]))
    key, h, counts = np.concatenate(keys), np.concatenate(hashes), np.array(counts)
    if not len(key):
        return
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(key)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = batch["row"].to_numpy()[doc]
    order, head = _grouped(key, h)
    group = np.cumsum(head) - 1
    often = np.bincount(group)[group] > 1
    local = np.zeros(len(key), bool)
    local[order] = often

    def runs(chosen: np.ndarray, by_key: bool):
        i = np.flatnonzero(chosen)
        same = np.zeros(len(i), bool)
        same[1:] = (np.diff(i) == 1) & (doc[i[1:]] == doc[i[:-1]])
        if by_key:
            same[1:] &= key[i[1:]] == key[i[:-1]]
        starts, ends = _runs(same)
        return i, starts, ends

    i, starts, ends = runs(local, False)
    if len(i):
        yield row[i[starts]], row[i[starts]], at[i[starts]], at[i[ends - 1]] + 1, None
    likely = np.zeros(len(key), bool)
    first = np.r_[True, key[1:] != key[:-1]]
    likely[:] = seen_twice(planes, key[first])[np.cumsum(first) - 1]
    i, starts, ends = runs(likely & ~local, True)
    if len(i):
        yield key[i[starts]].view(np.int64), row[i[starts]], at[i[starts]], at[i[ends - 1]] + 1, (h[i], np.r_[starts, len(i)])
    i = order[head & often]
    i = i[likely[i]]
    if len(i):
        i = i[np.argsort(key[i], kind="stable")]
        same = np.zeros(len(i), bool)
        same[1:] = key[i[1:]] == key[i[:-1]]
        starts, _ = _runs(same)
        yield key[i[starts]].view(np.int64), None, None, None, (h[i], np.r_[starts, len(i)])


_ROWS = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("hashes", pa.list_(pa.int64()))])


def _spread(values, n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind) if values is None else pa.array(values, kind)


#: Rows of one anchor that a task holds before it keeps only their distinct windows.
HELD = 20_000


def _repeated(rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Of (key, row, start, size, h): for each hash whether it was met twice, and its row's place."""
    key, _, _, size, h = rows
    owner = np.repeat(np.arange(len(key)), size)
    order, head = _grouped(key[owner], h)
    group = np.cumsum(head) - 1
    met = np.zeros(len(h), bool)
    met[order] = np.bincount(group)[group] > 1
    return met, owner


def _intervals(rows: tuple[np.ndarray, ...], met: np.ndarray, owner: np.ndarray) -> Iterator[pa.RecordBatch]:
    # a witness (start -1) stands for two or more copies, which its own slice has marked
    _, row, start, size, h = rows
    at = start[owner] + np.arange(len(h)) - (np.cumsum(size) - size)[owner]
    i = np.flatnonzero(met & (start[owner] >= 0))
    if len(i):
        same = np.zeros(len(i), bool)
        same[1:] = (np.diff(i) == 1) & (owner[i[1:]] == owner[i[:-1]])
        starts, ends = _runs(same)
        out = [row[owner[i[starts]]], at[i[starts]].astype(np.int32), at[i[ends - 1]].astype(np.int32) + 1]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())], ["row", "start", "end"])


def _distinct(rows: tuple[np.ndarray, ...], met: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same windows with those met twice once, as witnesses, and the others one by one; what _intervals gave is not given again."""
    key, row, start, size, h = rows
    at = start[owner] + np.arange(len(h)) - (np.cumsum(size) - size)[owner]
    order, head = _grouped(key[owner], h)
    first = order[head]
    first.sort()
    alone = ~met[first]
    own = owner[first]
    where = np.where(alone & (start[own] >= 0), at[first], -1).astype(start.dtype)
    return key[own], row[own], where, np.ones(len(first), size.dtype), h[first]


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _cut(rows: tuple[np.ndarray, ...], at: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """The rows before and from place ``at``."""
    key, row, start, size, h = rows
    edge = int(size[:at].sum())
    return (key[:at], row[:at], start[:at], size[:at], h[:edge]), (key[at:], row[at:], start[at:], size[at:], h[edge:])


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(key, row, start, size, hashes) of rows with hashes; a witness starts at -1."""
    lists = batch["hashes"]
    sizes, hashes = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy().view(np.uint64)
    return batch["key"].to_numpy().view(np.uint64), batch["row"].fill_null(0).to_numpy(), batch["start"].fill_null(-1).to_numpy(), sizes, hashes


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: known intervals as they are, and the repeated stretches of runs."""
    turn_to()
    held, fresh = None, 0
    for batch in batches:
        known = batch["hashes"].is_null().to_numpy(zero_copy_only=False)
        if known.any():
            out = batch.filter(pa.array(known))
            yield pa.RecordBatch.from_arrays([out["row"], out["start"], out["end"]], ["row", "start", "end"])
            batch = batch.filter(pa.array(~known))
        if not len(batch):
            continue
        now = _columns(batch)
        fresh += len(now[0])
        rows = now if held is None else _joined([held, now])
        last = int(np.argmax(rows[0] == rows[0][-1]))
        done, held = _cut(rows, last)
        if len(done[0]):
            yield from _intervals(done, *_repeated(done))
            fresh = len(held[0])
        if fresh > HELD:
            found = _repeated(held)
            yield from _intervals(held, *found)
            held, fresh = _distinct(held, *found), 0
    if held is not None:
        yield from _intervals(held, *_repeated(held))


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals (row, start, end) as rows that are known."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b["row"], b["row"], b["start"], b["end"], pa.nulls(len(b), pa.list_(pa.int64()))], schema=_ROWS)


def _sent(rows: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """What repeats within these rows, and their distinct windows, each under a key of its anchor and hash."""
    found = _repeated(rows)
    yield from _found(_intervals(rows, *found))
    key, row, start, _, h = _distinct(rows, *found)
    witness = start < 0
    place = pa.array(start, pa.int32(), mask=witness)
    lists = pa.ListArray.from_arrays(np.arange(len(h) + 1, dtype=np.int32), h.view(np.int64))
    out = pa.RecordBatch.from_arrays([pa.array((mix(key) + h).view(np.int64)), pa.array(row, pa.int64(), mask=witness), place, place, lists], schema=_ROWS)
    yield from slices(out)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key: known intervals as they are, the repeated stretches of runs, and the distinct windows of keys with more rows than HELD."""
    turn_to()
    held, many = None, None  # rows of the last key; the key that has sent windows on
    for batch in batches:
        known = batch["hashes"].is_null()
        yield batch.filter(known)
        batch = batch.filter(pc.invert(known))
        if not len(batch):
            continue
        rows = _columns(batch) if held is None else _joined([held, _columns(batch)])
        if many is not None and rows[0][-1] != many:
            mine, rows = _cut(rows, int((rows[0] == many).sum()))
            many = None
            if len(mine[0]):
                yield from _sent(mine)
        done, held = _cut(rows, int(np.argmax(rows[0] == rows[0][-1])))
        if len(done[0]):
            yield from _found(_intervals(done, *_repeated(done)))
        if len(held[0]) > HELD:
            many = held[0][0]
            yield from _sent(held)
            held = None
    if held is not None:
        yield from _sent(held) if many is not None else _found(_intervals(held, *_repeated(held)))


def repeated_intervals(docs: DataFrame, size: int = WINDOW, inner: int = INNER, width_bits: int | None = None) -> DataFrame:
    """(row, start, end): windows of ``docs`` (row, text) that start at words start .. end - 1 and repeat.

    The sketch has 2 ** width_bits cells a row; without it, about four for each
    anchor run that texts of this length have (one in some fifty bytes).
    """
    if width_bits is None:
        width_bits = width_for(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 50)

    def runs_of(batch: pa.RecordBatch) -> np.ndarray:
        out = []
        for words in _batch_words(batch):
            key = anchors(words, size, inner)
            out.append(key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key)
        return np.concatenate(out) if out else np.empty(0, np.uint64)

    planes = count_min(docs.select("text"), runs_of, width_bits)
    shared = docs.sparkSession.sparkContext.broadcast(planes)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, row, start, end, held in (found for batch in batches for part in slices(batch, "text") for found in _windows(part, shared.value, size, inner)):
            n = len(key)
            lists = pa.nulls(n, pa.list_(pa.int64())) if held is None else pa.ListArray.from_arrays(pa.array(held[1], pa.int32()), pa.array(held[0].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), _spread(row, n, pa.int64()), _spread(start, n, pa.int32()), _spread(end, n, pa.int32()), lists], schema=_ROWS)

    rows = docs.select("row", "text").mapInArrow(emit, "key long, row long, start int, end int, hashes array<long>")
    dealt = lambda df: df.repartition("key").sortWithinPartitions("key")
    kind = "key long, row long, start int, end int, hashes array<long>"
    return dealt(dealt(rows).mapInArrow(_parts, kind)).mapInArrow(_meet, "row long, start int, end int")


def remove_repeated(docs: DataFrame, size: int = WINDOW, inner: int = INNER, width_bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept (words joined by one space) of each document (doc_id, text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("row", F.xxhash64("doc_id", "text"))
    spans = repeated_intervals(source, size, inner, width_bits).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def keep(batch: pa.RecordBatch):
        n_words, n_removed, kept = [], [], []
        for text, held in zip(batch["text"], batch["spans"], strict=True):
            words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            gone = 0
            if held.is_valid:
                edge = np.zeros(len(words) + 1, np.int32)
                at = held.values
                np.add.at(edge, at.field("start").to_numpy(), 1)
                np.add.at(edge, at.field("end").to_numpy() + size - 1, -1)
                left = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                gone = len(words) - len(left)
                n_words.append(len(words))
                words = [words[i] for i in left]
            else:
                n_words.append(len(words))
            n_removed.append(gone)
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return batch["doc_id"], n_words, n_removed, kept

    return arrow_map(source.join(spans, "row", "left").select("doc_id", "text", "spans"), keep, "doc_id long, n_words long, n_removed long, kept string")


def op10_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that 35-word windows repeat."""
    out = remove_repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
