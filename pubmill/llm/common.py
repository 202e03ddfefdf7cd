"""What several corpus operators share: shared storage, word hashing, Arrow glue."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: ASCII white space, the word separator of every operator here.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows, and bytes of text, that a Python worker works on at a time; one longer text is a batch of its own.
ROWS, BYTES = 1000, 4 << 20
#: A key that holds more than one in so many rows is joined by broadcast, so there are at most so many of them.
HEAVY = 256
#: Deletes a query's shuffle files as it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the cluster names it, and only a local session may go without."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="pubmill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/pubmill-{tag}-{uuid.uuid4().hex}"


#: Tables written by materialize and not yet deleted, in order.
_written: list[str] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage with a written table: every later read sees the same rows. Of the work on it no shuffle files stay."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """The place from which ``release`` deletes."""
    return len(_written)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the tables that ``materialize`` wrote from ``since`` on, but for those that ``keep`` reads.

    Only for tables that no later action reads: a frame that is still lazy over one of them fails.
    """
    held = [f for df in keep for f in df.inputFiles()]
    gone = [p for p in _written[since:] if not any(p in f for f in held)]
    for path in gone:
        _written.remove(path)
        delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def heavy_join(left: DataFrame, right: DataFrame, on: list[str], rows: str, total: int | None = None) -> DataFrame:
    """Left join with a ``right`` of unique keys ``on``, whose column ``rows`` says how many rows of left have the key.

    Keys with more than one in HEAVY of the ``total`` rows (their sum, where it is not
    given) would each fill a task: they, HEAVY at most, are joined by broadcast, and
    the rest by shuffle. Nulls match no key.
    """
    value = [c for c in right.columns if c not in (*on, rows)]
    if total is None:
        total = right.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    heavy = right.where(F.col(rows) * HEAVY > total).select(*on, F.struct(*value).alias("__value"))
    light = right.where(F.col(rows) * HEAVY <= total).select(*on, *value)
    tried = left.join(F.broadcast(heavy), on, "left")
    done = tried.where("__value is not null").select(*left.columns, *(F.col("__value")[v].alias(v) for v in value))
    rest = tried.where("__value is null").select(*left.columns).join(light, on, "left").select(*left.columns, *value)
    return done.unionByName(rest)


def slices(batch: pa.RecordBatch, text: str | None = None, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of at most ``rows`` rows and about ``BYTES`` bytes of column ``text``."""
    if text is None or not len(batch):
        yield from (batch.slice(at, rows) for at in range(0, len(batch), rows))
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = done = 0
    while at < len(batch):
        end = min(max(at + 1, int(np.searchsorted(ends, done + BYTES, "right"))), at + rows)
        yield batch.slice(at, end - at)
        at, done = end, int(ends[end - 1])


#: What this Python worker caches, by operator: how to empty it.
_caches: dict[str, Callable[[], None]] = {}


def keep_cache(operator: str, empty: Callable[[], None]) -> None:
    _caches[operator] = empty


def turn_to(operator: str = "") -> None:
    """Called as a task starts: workers live on, so one that served another operator first empties what that cached."""
    for other in [name for name in _caches if name != operator]:
        _caches.pop(other)()


def arrow_map(df: DataFrame, fn: Callable, schema: str | T.StructType, text: str = "text", operator: str = "") -> DataFrame:
    """``mapInArrow`` where fn maps a slice of a record batch, bounded in rows and in bytes of ``text``, to column lists.

    ``operator`` is the one whose cache fn uses, if it does.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to(operator)
        for whole in batches:
            measured = text if text in whole.schema.names and pa.types.is_string(whole.schema.field(text).type) else None
            for part in slices(whole, measured):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(fn(part), target, strict=True)], schema=target)

    return df.mapInArrow(run, struct)


_STEP, _GRAM = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = np.where(_SPACE, np.uint64(0), np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
#: Longer texts are hashed piece by piece, cut between words.
PIECE = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next call."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, 1 << 14), base, np.uint64)
        found[0] = 1
        found = _powers[base] = np.cumprod(found, dtype=np.uint64)
    return found[:n]


_STEP_INV, _GRAM_INV = pow(_STEP, -1, 2**64), pow(_GRAM, -1, 2**64)


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    space = _SPACE[b]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if not space[0]:
        starts = np.concatenate([[0], starts])
    if not len(starts):
        return np.empty(0, np.uint64)
    total = np.add.reduceat(_TABLE[b] * powers(_STEP, len(b)), starts)
    return mix(total * powers(_STEP_INV, len(b))[starts])


def word_hashes(data: bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 ``data``, in order; lower folds A-Z."""
    b = np.frombuffer(data, np.uint8)
    if lower:
        b = _LOWER[b]
    if len(b) <= PIECE:
        return _piece_hashes(b) if len(b) else np.empty(0, np.uint64)
    cuts = np.flatnonzero(_SPACE[b])
    out, at = [], 0
    while at < len(b):
        k = np.searchsorted(cuts, at + PIECE)
        end = int(cuts[k]) if k < len(cuts) else len(b)
        out.append(_piece_hashes(b[at:end]))
        at = end + (end == at)
    return np.concatenate(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words; empty where there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_GRAM, len(words)), out=sums[1:])
    return mix((sums[k:] - sums[:n]) * powers(_GRAM_INV, n))


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, no words none."""
    words = word_hashes(text.encode("utf-8", "surrogatepass"), lower=True)
    if len(words) and len(words) < k:
        return mix(gram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(gram_hashes(words, k))
