"""The most similar title of each of many, by the ratio of matching characters, without comparing all pairs."""

from __future__ import annotations

import difflib
import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import postings as P
from pubmill.sinks import written

#: Pairs scored at a time, and copies of a gram that are told apart by their frequency.
PAIRS, COPIES = 2000, 32
#: Characters of a list of titles whose stretches of HEAD characters every task holds.
FEW, HEAD = 250_000, 8


def shared_least(first: int, second: int, least: float, q: int) -> int:
    """How many grams of q characters (1 or 2) two titles of these lengths share at least, if their ratio reaches ``least``.

    A ratio r means r * (first + second) / 2 matched characters. Blocks of them have an
    unmatched character between, in one title or the other, so there is one block more than
    unmatched characters at most, and each block costs one pair of neighbours.
    """
    both = first + second
    return math.ceil((least / 2 * both if q == 1 else (1.5 * least - 1) * both - 1) - 1e-9)


def _ranks(grams: DataFrame) -> dict[tuple[str, int], int]:
    """How many titles hold a gram so many times at least, up to COPIES, of rows (id, gram) with repeats.

    Normalised titles have letters, digits, _ and blanks, so there are 38 ** 2 grams at most.
    """
    held = grams.groupBy("id", "gram").count().groupBy("gram", F.least("count", F.lit(COPIES)).alias("copies")).count()
    out: dict[tuple[str, int], int] = {}
    for r in held.collect():  # a row for each gram and number of copies
        for k in range(1, r["copies"] + 1):
            out[r["gram"], k] = out.get((r["gram"], k), 0) + r["count"]
    return out


def _keys(df: DataFrame, least: float, q: int, rank: dict[tuple[str, int], int]) -> DataFrame:
    """(id, size, gram) of each title (id, title): so many of its rarest grams that any title similar enough has one among its own.

    Grams are numbered, so that the second "an" is another than the first.
    """
    shared = df.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for name, title in zip(batch["id"].to_pylist(), batch["title"].to_pylist(), strict=True):
                n, seen, grams = len(title), {}, []
                for i in range(n - q + 1):
                    g = title[i : i + q]
                    seen[g] = seen.get(g, 0) + 1
                    grams.append((order.get((g, min(seen[g], COPIES)), 0), g, seen[g]))
                need = shared_least(n, math.ceil(n * least / (2 - least) - 1e-9), least, q)
                for _, g, k in sorted(grams)[: max(0, len(grams) - max(1, need) + 1)]:
                    out[0].append(name)
                    out[1].append(n)
                    out[2].append(f"{g}{k}")
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], ["id", "size", "gram"])

    return df.select("id", "title").mapInArrow(run, "id long, size int, gram string")


def _pieces(df: DataFrame, q: int) -> DataFrame:
    """(id, gram) of the different stretches of q characters."""
    return df.where(F.length("title") >= q).select("id", F.explode(F.array_distinct(T.grams(F.col("title"), F.lit(q)))).alias("gram"))


def similar_pairs(left: DataFrame, right: DataFrame, least: float, q: int) -> DataFrame:
    """(l, r) of titles (id, title) that may be similar: with a rare gram in common, and lengths that allow the ratio."""
    # only titles of a length that some title of the other side allows
    span = lambda df: df.agg(F.min(F.length("title")), F.max(F.length("title"))).first()
    allowed = lambda df, lo, hi: df.where(F.length("title").between(math.floor((lo or 0) * least / (2 - least)), math.ceil((hi or 0) * (2 - least) / least)))
    left = allowed(left, *span(right))
    right = allowed(right, *span(left))
    rank = _ranks(left.where(F.length("title") >= q).select("id", F.explode(T.grams(F.col("title"), F.lit(q))).alias("gram")))
    a, b = (_keys(df.where(F.length("title") >= q), least, q, rank) for df in (left, right))
    joined = a.select(F.col("id").alias("l"), F.col("size").alias("ls"), "gram").join(b.select(F.col("id").alias("r"), F.col("size").alias("rs"), "gram"), "gram")
    close = F.least("ls", "rs") * 2.0 >= F.lit(least - 1e-9) * (F.col("ls") + F.col("rs"))
    return joined.where(close).select("l", "r").distinct()


def contained_pairs(short: DataFrame, long: DataFrame) -> DataFrame:
    """(s, l) of titles (id, title) of which one holds the other as it is, found by the rarest stretch of the shorter."""
    # a title longer than all on the other side is in none
    most = long.agg(F.max(F.length("title"))).first()[0] or 0
    short = short.where(F.length("title") <= most)
    out = None
    for q in (1, 2, P.GRAM):
        own = short.where(F.length("title") >= q if q == P.GRAM else F.length("title") == q)
        if q < P.GRAM and not own.limit(1).count():
            continue
        pieces, inside = _pieces(own, q), _pieces(long, q)
        n = inside.groupBy("gram").agg(F.count("*").alias("n"))  # 38 ** 3 at most
        filed = pieces.join(F.broadcast(n), "gram").groupBy("id").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
        tried = filed.select(F.col("id").alias("s"), "gram").join(inside.select(F.col("id").alias("l"), "gram"), "gram").select("s", "l")
        out = tried if out is None else out.unionByName(tried)
    s, l = (df.select(F.col("id").alias(name), F.col("title").alias(f"__{name}")) for df, name in ((short, "s"), (long, "l")))
    return out.join(s, "s").join(l, "l").where(F.contains("__l", F.col("__s"))).select("s", "l")


def contained_in_few(records: DataFrame, asked: DataFrame) -> DataFrame:
    """(l, r) of records and asked titles (id, title), of FEW characters in all, of which one holds the other; asked ones of three words at least where they are the shorter.

    A record within another title is found by its first characters. The words of an asked title but its first and last are whole
    words of what holds it, so its longest of them names the titles to try. A record's grams are not written out.
    """
    shared = records.sparkSession.sparkContext.broadcast(asked.select("id", "title").toArrow())  # FEW characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, titles = (shared.value[c].to_pylist() for c in ("id", "title"))
        inner = [frozenset(t.split(" ")[1:-1]) for t in titles]
        filed, begin, joined = defaultdict(list), defaultdict(set), "\n".join(titles)
        for j, t in enumerate(titles):
            if inner[j]:
                filed[max(inner[j], key=lambda w: (len(w), w))].append(j)
            for i in range(len(t) - HEAD + 1):
                begin[t[i : i + HEAD]].add(j)
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for name, title in zip(batch["id"].to_pylist(), batch["title"].to_pylist(), strict=True):
                near = begin.get(title[:HEAD], ()) if len(title) >= HEAD else range(len(titles)) if title in joined else ()
                found = {j for j in near if title in titles[j]}
                words = set(title.split(" "))
                found.update(j for w in words & filed.keys() for j in filed[w] if inner[j] <= words and titles[j] in title)
                out[0].extend([name] * len(found))
                out[1].extend(keys[j] for j in found)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], ["l", "r"])

    return records.select("id", "title").mapInArrow(run, "l long, r long")


def fuzzy_titles(records: DataFrame, wanted: DataFrame, least: float = 0.82) -> DataFrame:
    """(key, id, score) of the record (id, title) most like each wanted (key, title), by the ratio of matching characters.

    A title within the other counts 0.99, one that holds the other 0.95 at least. Ties
    go to the smaller id; below ``least`` there is none. Neither list is limited. Pairs that can reach the
    ratio are found by an equi-join on rare grams: of two characters where the ratio
    forces shared ones, of one character for short titles and low ratios. Bounds by length and by
    common characters come before the exact ratio.
    """
    title = lambda df, c: T.once(df.select(F.col(c).cast("long").alias("id"), F.col("title").alias("raw")), title=T.normalise(F.col("raw"))).where("title <> '' and id is not null").select("id", "title")
    records, asked = (written(df, "titles") for df in (title(records, "id"), title(wanted, "key")))  # read several times
    if 1.5 * least - 1 > 0.1:
        # so long that two of them share a pair of neighbours, else compared by single characters
        enough = math.ceil(2 / (1.5 * least - 1)) + 1
        short = lambda df: df.where(F.length("title") <= enough)
        pairs = similar_pairs(records, asked, least, 2).unionByName(similar_pairs(short(records), short(asked), least, 1))
    else:
        pairs = similar_pairs(records, asked, least, 1)
    inside = asked
    if asked.agg(F.coalesce(F.sum(F.length("title")), F.lit(0))).first()[0] <= FEW:
        pairs = pairs.unionByName(contained_in_few(records, asked))
        inside = asked.where(F.size(F.split("title", " ")) < 3)
    else:
        pairs = pairs.unionByName(contained_pairs(records, asked).select(F.col("s").alias("l"), F.col("l").alias("r")))
    if inside is asked or inside.limit(1).count():
        pairs = pairs.unionByName(contained_pairs(inside, records).select("l", F.col("s").alias("r")))
    small = P.fits(asked, "title")
    other = F.broadcast(asked) if small else asked
    both = pairs.distinct().join(records.select(F.col("id").alias("l"), "title"), "l").join(other.select(F.col("id").alias("r"), F.col("title").alias("asked")), "r")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, best = difflib.SequenceMatcher(None, "", ""), {}
        neighbours = lambda t: Counter(zip(t, t[1:], strict=False))
        for batch in batches:
            for at in range(0, len(batch), PAIRS):
                part = batch.slice(at, PAIRS)
                rows = sorted(zip(*(part[c].to_pylist() for c in ("r", "asked", "l", "title")), strict=True))
                for (key, title), group in itertools.groupby(rows, lambda r: r[:2]):
                    own = neighbours(title)
                    # those with the most neighbours in common first: a good score early spares the rest
                    tried = sorted((-sum((own & neighbours(other)).values()), id_, other) for _, _, id_, other in group)
                    m.set_seq2(title)
                    for shared, id_, other in tried:
                        held = best.get(key, (-least, 1 << 63))
                        found = 0.99 if title in other else 0.95 if other in title else 0.0
                        if -shared >= shared_least(len(title), len(other), -held[0], 2):
                            m.set_seq1(other)
                            if m.real_quick_ratio() >= -held[0] and m.quick_ratio() >= -held[0]:
                                found = max(found, m.ratio())
                        if (-found, id_) < held and found >= least:
                            best[key] = (-found, id_)
            if len(best) > 100_000:
                yield _rows(best)
                best = {}
        yield _rows(best)

    # pairs are few bytes and much work, so they are dealt by number rather than by size
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = both.select("r", "asked", "l", "title").repartition(tasks, F.xxhash64("r", "l")).mapInArrow(score, "key long, id long, score double")
    least_of = F.min(F.struct((-F.col("score")).alias("less"), "id"))
    return found.groupBy("key").agg(least_of.alias("x")).select("key", "x.id", (-F.col("x.less")).alias("score"))


def _rows(best: dict[int, tuple[float, int]]) -> pa.RecordBatch:
    columns = list(zip(*((k, i, -s) for k, (s, i) in best.items()), strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["key", "id", "score"])
