"""Count-min sketches, made per partition and merged by cell blocks, and tables of bits of hashed keys."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, turn_to

#: Cells of a row at most, and rows of the sketch: 2 x 32 Mi counters.
WIDTH_BITS, DEPTH = 25, 2
#: Cells that are merged at a time, and parts of them that meet in one place.
BLOCK, FAN = 1 << 18, 64


def width_for(items: int, most: int = WIDTH_BITS) -> int:
    """Bits of a sketch row of about four cells an item, from 16 bits to ``most``."""
    return min(most, max(16, (4 * items - 1).bit_length() if items else 16))


def cells(h: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    return (mix(h + np.uint64((0x517CC1B727220A95 * (row + 1)) % 2**64)) >> np.uint64(64 - width_bits)).astype(np.int64)


def _pack(counts: np.ndarray) -> bytes:
    """Counters of 0 to 2: the cells that are not 0 while they are few, else two bit planes."""
    held = np.flatnonzero(counts)
    if len(held) < len(counts) // 32:
        return b"s" + (held * 2 + (counts[held] > 1)).astype(np.uint32).tobytes()
    return b"p" + np.packbits(counts >= 1).tobytes() + np.packbits(counts >= 2).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    if data[:1] == b"p":
        planes = np.unpackbits(np.frombuffer(data, np.uint8, offset=1)).reshape(2, -1)[:, :n]
        return planes[0] + planes[1]
    held = np.frombuffer(data, np.uint32, offset=1)
    out = np.zeros(n, np.uint8)
    out[held >> 1] = 1 + (held & 1)
    return out


def _in_tree(made: DataFrame, tasks: int, fold: Callable, zero: Callable, pack: Callable) -> DataFrame:
    """Rows (block, slot, counts) of ``tasks`` slots to one row a block; at each level FAN parts at most meet, one after the other."""
    schema = "block long, slot long, counts binary"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = None, None
        give = lambda: pa.RecordBatch.from_arrays([pa.array([name[0]]), pa.array([name[1]]), pa.array([pack(total)])], ["block", "slot", "counts"])
        for batch in batches:
            for k, slot, part in zip(batch["block"].to_pylist(), batch["slot"].to_pylist(), batch["counts"], strict=True):
                if (k, slot) != name:
                    if name is not None:
                        yield give()
                    name, total = (k, slot), zero()
                total = fold(total, part.as_py())
        if name is not None:
            yield give()

    while True:
        tasks = -(-tasks // FAN)
        made = made.withColumn("slot", F.floor(F.col("slot") / FAN) if tasks > 1 else F.lit(0).cast("long"))
        made = made.repartition("block", "slot").sortWithinPartitions("block", "slot").mapInArrow(merge, schema)
        if tasks <= 1:
            return made


def _filled(df: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray], block: int, pack: Callable) -> DataFrame:
    """A task's counters from ``fill``, in blocks; those all 0 left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        slot = TaskContext.get().partitionId()
        for k, part in enumerate(fill(batches).reshape(-1, block)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([slot]), pa.array([pack(part)])], ["block", "slot", "counts"])

    return df.mapInArrow(run, "block long, slot long, counts binary")


def count_min(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], width_bits: int = WIDTH_BITS, depth: int = DEPTH, text: str = "text") -> list[bytes]:
    """For each sketch row the bit plane of cells counted twice or more.

    Each task fills its own counters, which stop at 2, and gives them by blocks,
    which are added up in a tree. A task holds its own sketch and the driver the
    merged one, both of the given size. No counter falls short of min(count, 2).
    """
    width = 1 << width_bits
    block = min(BLOCK, width)

    def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own = np.zeros((depth, width), np.uint8)
        for batch in batches:
            for part in slices(batch, text):
                h = hashes(part)
                for row in range(depth):
                    at, n = np.unique(cells(h, row, width_bits), return_counts=True)
                    own[row][at] = np.minimum(own[row][at] + np.minimum(n, 2), 2)
        return own

    fold = lambda total, part: np.minimum(total + _unpack(part, block), 2)
    made = _in_tree(_filled(df, fill, block, _pack), df.rdd.getNumPartitions(), fold, lambda: np.zeros(block, np.uint8), _pack)
    planes = np.zeros((depth * width // block, (block + 7) // 8), np.uint8)
    for row in made.select("block", "counts").toLocalIterator():  # at most depth * width / block rows
        planes[row["block"]] = np.packbits(_unpack(bytes(row["counts"]), block) >= 2)
    return [x.tobytes() for x in planes.reshape(depth, -1)]


def magnitudes(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], width_bits: int, text: str = "text") -> np.ndarray:
    """For each cell of a sketch of one row the number of binary digits of its count, over all rows of ``df``."""
    width = 1 << width_bits
    block = min(1 << 16, width)
    pack = lambda counts: zlib.compress(counts.astype("<u4").tobytes(), 1)

    def fill(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        own = np.zeros(width, np.uint32)
        for part in (part for batch in batches for part in slices(batch, text)):
            np.add.at(own, cells(hashes(part), 0, width_bits), np.uint32(1))
        return own

    fold = lambda total, part: total + np.frombuffer(zlib.decompress(part), "<u4")
    made = _in_tree(_filled(df, fill, block, pack), df.rdd.getNumPartitions(), fold, lambda: np.zeros(block, np.uint64), lambda total: pack(np.minimum(total, 2**32 - 1)))
    out = np.zeros((width // block, block), np.uint8)
    for row in made.select("block", "counts").toLocalIterator():  # width / block rows
        out[row["block"]] = np.frexp(np.frombuffer(zlib.decompress(bytes(row["counts"])), "<u4"))[1]
    return out.ravel()


def seen_twice(planes: list[bytes], h: np.ndarray) -> np.ndarray:
    """True for every hash counted twice or more, and for a few others."""
    out = np.ones(len(h), bool)
    for row, plane in enumerate(planes):
        bits = np.frombuffer(plane, np.uint8)
        at = cells(h, row, (len(bits) * 8).bit_length() - 1)
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return out


def table_of_bits(keys: DataFrame, most: int = 28) -> Callable[[np.ndarray], np.ndarray]:
    """A test of 64-bit hashes, for tasks: true for every one that the only column of ``keys`` holds, and for a few others.

    Each key sets two bits of a table of 16 bits a key, 2 ** ``most`` at most (32 MB), which passes the driver and is
    broadcast. Past that more others pass, so what passes is joined with the keys.
    """
    n = keys.count()
    bits = 1 << max(16, min(most, (16 * n - 1).bit_length() if n else 0))
    key, mask = F.col(keys.columns[0]), F.lit(bits - 1).cast("long")
    at = keys.select(F.explode(F.array(*(x.bitwiseAND(mask) for x in (key, F.shiftrightunsigned(key, 32))))).alias("at"))
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()  # bits / 64 rows at most
    table = np.zeros(bits >> 6, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def test(h: np.ndarray) -> np.ndarray:
        h, out = h.view(np.uint64), True
        for x in (h & np.uint64(bits - 1), h >> np.uint64(32) & np.uint64(bits - 1)):
            out &= (shared.value[x >> np.uint64(6)] >> (x & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out

    return test


def may_hold(keys: DataFrame) -> Callable[[Column], Column]:
    """The test of ``table_of_bits`` for a column without nulls. A step in Python that follows tests by itself: it would be a second worker."""
    test = table_of_bits(keys)

    @F.arrow_udf("boolean")
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        turn_to()
        for batch in batches:
            yield pa.array(test(batch.to_numpy(zero_copy_only=False)))

    return held
