"""Best-fit packing of documents into sequences, improved by bin completion.

1. Each document becomes token ids and a closing id; what is longer than a sequence is
   cut into pieces. A task numbers its pieces of each length, and they are written once.
2. Only the histogram of lengths (one row a length, so never more than a sequence has
   tokens) goes to the driver. There best-fit decreasing gives an incumbent and bounds
   say how few sequences could do; if these differ, a branch-and-bound search
   goes on: around the longest piece left it enumerates undominated fillings (no
   piece outside could take the place of one or more inside), least waste first, and
   leaves a branch once its waste, or the bound on what is left, excludes fewer
   sequences than the incumbent has. Equal pieces are placed together, so the search
   depends on lengths and not on the number of documents. It ends at the bound, when
   nothing is left to try, or after ``EFFORT`` steps, with the best packing found.
3. The packing is a table of patterns and how often each is used, again bounded by
   the lengths. Pieces of a length take its places by number: a task's pieces start
   where the earlier tasks' end, so a join on (task, length) and a search in the
   pattern table give each its sequence and offset. No length is gathered anywhere.

Cases: null and empty texts are the closing id alone; texts of any length are cut, never
shortened; repeated rows and null ids are packed each; an empty table gives no rows;
further columns are not used.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep_cache, materialize, slices, turn_to
from .op8_forced_boundaries import byte_characters

#: Tokens of a sequence, the closing id, and the public tokenizer file.
CAPACITY, CLOSING, VOCABULARY = 2048, 0, "word_bpe_49k.json"
#: Steps of the search in all, and of one list of fillings; entries of a cache's newer half, and characters of a chunk that is kept.
EFFORT, PER_LIST, CACHED, KEPT = 4_000_000, 2000, 300_000, 64
#: Pieces that a task numbers on, before it starts again as another.
STRETCH = 1 << 18
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, run long, nth long"


class Texts:
    """Ids of texts as little-endian 32-bit numbers, chunks between white space being kept.

    The tokenizer drops white space and looks at nothing across it, so a text's ids
    are its chunks' one after the other. A chunk of Latin letters, and of
    signs after it, is one word of its pattern each; such a word goes to the tokenizer's model
    as that sees it: in lower case, its bytes as printable characters. All others are
    encoded by the library.
    """

    SIGNS, LETTERS = string.punctuation, "\u0250"  # letters below this have no compositions left, and as small ones as many characters

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = self.tokenizer.model
        self.shown = dict(enumerate(byte_characters()))
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, chunk: str) -> str | None:
        """A word of Latin letters in lower case, else nothing."""
        if chunk.isalpha() and max(chunk) < self.LETTERS:
            low = chunk.lower()
            return low if low.isalpha() else None
        return None

    def _library(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, low: str) -> bytes:
        return array("I", [t.id for t in self.words.tokenize(low.encode().decode("latin-1").translate(self.shown))]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            low = self._plain(chunk)
            if low is not None:
                found = self._word(low)
            else:
                head = chunk.rstrip(self.SIGNS)
                if head and len(head) < len(chunk) and self._plain(head) is not None:
                    tail = chunk[len(head) :]
                    found = (self.newer.get(head) or self._chunk(head)) + (self.newer.get(tail) or self._chunk(tail))
                else:
                    found = self._library(chunk)
        if len(chunk) <= KEPT:
            if len(self.newer) >= CACHED:
                self.older, self.newer = self.newer, {}
            self.newer[chunk] = found
        return found

    def ids(self, text: str) -> bytes:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to Python, and not to the tokenizer
            return self._library(text)
        chunks = text.split()
        found = list(map(self.newer.get, chunks))
        if None in found:
            found = [f if f is not None else self.newer.get(c) or self._chunk(c) for f, c in zip(found, chunks, strict=True)]
        return b"".join(found)


@lru_cache(maxsize=1)
def texts(path: str) -> Texts:
    """One for each Python worker."""
    keep_cache("op13", texts.cache_clear)
    return Texts(path)


def cut(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, path: str | None = None, stretch: int = STRETCH) -> DataFrame:
    """The pieces of each document (doc_id, text), with run and nth: their number among the pieces of a length in a stretch of a task."""
    path = path or str(public_tokenizers.path(VOCABULARY))
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("op13")
        encoder, name, given, held = texts(path), TaskContext.get().partitionId() << 32, 0, Counter()
        for part in (part for batch in batches for part in slices(batch, "text")):
            rows = []
            for doc, text in zip(part["doc_id"].to_pylist(), part["text"], strict=True):
                ids = encoder.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    n = len(piece) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(piece), name, held[n]))
                    held[n] += 1
                    given += 1
                    if given % stretch == 0:
                        name, held = name + 1, Counter()
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "run", "nth"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)


Pattern = tuple[tuple[int, int], ...]


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound: for each size k, pieces over capacity - k stand alone, those over half too, and pieces of k or more fill what these leave;
    and of pieces over a (k + 1)-th of the capacity a sequence holds k."""
    size = np.arange(capacity + 1)
    n, volume = np.cumsum(counts), np.cumsum(counts * size)
    k = np.arange(capacity // 2 + 1)
    alone = n[-1] - n[capacity - k]
    half = n[capacity - k] - n[capacity // 2]
    room = half * capacity - (volume[capacity - k] - volume[capacity // 2])
    small = volume[capacity // 2] - np.where(k > 0, volume[np.maximum(k - 1, 0)], 0)
    k = np.arange(1, capacity + 1)
    thick = n[-1] - n[capacity // (k + 1)]
    return int(max((alone + half + np.maximum(0, -(-(small - room) // capacity))).max(), (-(-thick // k)).max()))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, equal sequences together: (pattern, times)."""
    groups: dict[int, list[tuple[Pattern, int]]] = {}
    free = 0  # bit r: some sequence has room r

    def put(room: int, pattern: Pattern, times: int) -> None:
        nonlocal free
        groups.setdefault(room, []).append((pattern, times))
        free |= 1 << room

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            fits = free >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                pattern, times = groups[room].pop()
                if not groups[room]:
                    free ^= 1 << room
            else:
                room, pattern, times = capacity, (), -(-left // (capacity // size))
            each = min(room // size, left)
            used = min(times, left // each)
            put(room - each * size, (*pattern, (size, each)), used)
            if times > used and pattern:
                put(room, pattern, times - used)
            left -= each * used
    return [g for room in sorted(groups) for g in groups[room]]


class Search:
    """Bin completion over a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int, effort: int = EFFORT):
        self.capacity, self.effort = capacity, effort
        self.counts = np.zeros(capacity + 1, np.int64)
        for size, n in counts.items():
            self.counts[size] = n
        self.held = self.counts.tolist()
        self.avail = sum(1 << s for s in counts)
        self.total = sum(s * n for s, n in counts.items())
        self.best = best_fit(counts, capacity)
        self.fewest = sum(t for _, t in self.best)
        self.least = least_sequences(self.counts, capacity) if counts else 0
        self.used = self.waste = 0

    def _allowed(self) -> int:
        """Waste that a packing of fewer sequences than the incumbent may have, less what the branch has."""
        return (self.fewest - 1) * self.capacity - self.total - self.waste

    def _outside(self, chosen: list[int], longest: int) -> int:
        out = self.avail
        for s, n in Counter([*chosen, longest]).items():
            if self.held[s] <= n:
                out &= ~(1 << s)
        return out

    def _dominated(self, chosen: list[int], waste: int, longest: int) -> bool:
        """Whether some piece outside could take the place of chosen ones (or of room) that are no longer."""
        single = several = 0
        for s in chosen:
            several |= several << s | single << s
            single |= 1 << s
        shorter, span = single << 1 | 2, 1  # one longer than a chosen piece, or than nothing
        grown = 0
        if waste:
            while span * 2 <= waste:
                shorter |= shorter << span
                span *= 2
            grown = shorter | shorter << (waste - span)
            span, wide = 1, several
            while span * 2 <= waste + 1:
                wide |= wide << span
                span *= 2
            several = wide | wide << (waste + 1 - span)
        return bool((grown | several) & self._outside(chosen, longest))

    def fillings(self, longest: int) -> Iterator[tuple[list[int], int]]:
        """Undominated (pieces, waste) beside the longest piece, those of less waste first."""
        done, level = -1, 0
        volume = np.cumsum(np.array(self.held) * np.arange(self.capacity + 1)).tolist()
        while done < (allowed := min(self._allowed(), self.capacity)):
            level = min(level, allowed)
            yield from self._within(longest, done, level, volume)
            done, level = level, max(1, 2 * level)

    def _within(self, longest: int, over: int, most: int, volume: list[int]) -> Iterator[tuple[list[int], int]]:
        steps = 0
        chosen: list[int] = []
        room = self.capacity - longest
        masks = [self.avail & ((2 << min(room, longest)) - 1)]
        while masks:
            mask = masks[-1]
            steps += 1
            if not mask or steps > PER_LIST or room - volume[mask.bit_length() - 1] > most:
                # nothing more goes in: what is chosen is a filling
                masks.pop()
                if over < room <= most and not self._dominated(chosen, room, longest):
                    self.effort -= steps
                    steps = 0 if steps <= PER_LIST else steps
                    yield list(chosen), room
                if steps > PER_LIST:
                    break
                if chosen:
                    room += chosen.pop()
                continue
            size = mask.bit_length() - 1
            masks[-1] ^= 1 << size
            if self.held[size] - (size == longest) - chosen.count(size) > 0:
                chosen.append(size)
                room -= size
                masks.append(self.avail & ((2 << min(room, size)) - 1) if room else 0)
        self.effort -= min(steps, PER_LIST)

    def children(self) -> Iterator[tuple[Pattern, int, int]]:
        """Patterns round the longest piece, how often to use each (as often as possible, then by halves), and their waste."""
        longest = self.avail.bit_length() - 1
        for chosen, waste in self.fillings(longest):
            pattern = tuple(sorted(Counter([longest, *chosen]).items(), reverse=True))
            times = min(self.held[s] // n for s, n in pattern)
            while times:
                yield pattern, times, waste
                times //= 2

    def _apply(self, pattern: Pattern, times: int, waste: int) -> None:
        for s, n in pattern:
            self.held[s] -= n * times
            self.counts[s] = self.held[s]
            self.avail = self.avail | 1 << s if self.held[s] else self.avail & ~(1 << s)
        self.used += times
        self.waste += waste * times

    def run(self) -> list[tuple[Pattern, int]]:
        """The best packing found."""
        if self.fewest == self.least:
            return self.best
        path: list[tuple[Pattern, int, int]] = []
        levels = [self.children()]
        while levels and self.effort > 0 and self.fewest > self.least:
            child = next(levels[-1], None)
            if child is None:
                levels.pop()
                if path:
                    pattern, times, waste = path.pop()
                    self._apply(pattern, -times, waste)
                continue
            pattern, times, waste = child
            self.effort -= 100
            if waste * times > self._allowed():
                continue
            self._apply(pattern, times, waste)
            if self.used + (least_sequences(self.counts, self.capacity) if self.avail else 0) < self.fewest:
                path.append(child)
                if self.avail:
                    levels.append(self.children())
                    continue
                self.fewest, self.best = self.used, [(p, t) for p, t, _ in path]
                path.pop()
            self._apply(pattern, -times, waste)
        return self.best


class Places(NamedTuple):
    """By number of a piece (lengths one after the other): where each stretch starts, its first sequence, pieces a sequence, first offset and length."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    length: np.ndarray


def places(packing: list[tuple[Pattern, int]], starts: dict[int, int]) -> Places:
    rows, sequence, taken = [], 0, dict(starts)
    for pattern, times in packing:
        at = 0
        for size, n in pattern:
            rows.append((taken[size], sequence, n, at, size))
            taken[size] += n * times
            at += n * size
        sequence += times
    return Places(*(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)))


def pack(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, path: str | None = None, effort: int = EFFORT, stretch: int = STRETCH) -> DataFrame:
    """A row for each piece of the documents (doc_id, text), with its sequence and offset, how many sequences there are, and how few there could be at least."""
    spark = docs.sparkSession
    pieces = materialize(cut(docs, capacity, closing, path, stretch), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # as many rows as a sequence has tokens at most
    search = Search(counts, capacity, effort)
    packing = search.run()
    sizes = sorted(counts)
    starts = dict(zip(sizes, np.cumsum([0, *(counts[s] for s in sizes)]).tolist(), strict=False))
    shared = spark.sparkContext.broadcast(places(packing, starts) if packing else None)
    begin = F.create_map(*(F.lit(v).cast("long") for pair in starts.items() for v in pair)) if starts else F.lit(None).cast("map<long,long>")
    before = W.partitionBy("length").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    first = pieces.groupBy("length", "run").agg(F.count("*").alias("n")).select("length", "run", (F.coalesce(F.sum("n").over(before), F.lit(0)) + begin[F.col("length")]).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        for batch in batches:
            table = shared.value
            number = batch["nth"].to_numpy() + batch["before"].to_numpy()
            i = np.searchsorted(table.first, number, "right") - 1
            times, slot = np.divmod(number - table.first[i], table.each[i])
            out = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(table.sequence[i] + times), pa.array(table.offset[i] + slot * table.length[i])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    placed = pieces.join(first, ["length", "run"]).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return placed.withColumns({"sequences": F.lit(search.fewest).cast("long"), "least": F.lit(search.least).cast("long")})


def op13_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
