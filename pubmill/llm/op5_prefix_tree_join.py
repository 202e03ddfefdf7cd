"""N-gram Jaccard self-join of documents with prefix trees.

A document is the set of its distinct k-word shingles, held in one global order
(the order of their 64-bit hashes). Two documents link when
``den * |A & B| >= num * |A | B|``.

1. Equal sets become one node. A node's id is a 64-bit hash of its set; among
   10 ** 9 distinct sets two share an id with a chance of 3 %.
2. Filtering. If two sets link, at most D of their shingles differ, where D
   follows from their sizes. Sets are cut into P = 3/2 D parts and some by shingle
   hash, so at least P - D parts are the same in both. A part is as rare as its
   rarest shingle, by the magnitude of the count of each in a merged sketch over all
   texts. In the order of rarity, then of hash, the first D + 1 parts of either set
   hold a part that is the same in both: only these are keys, and parts that lie
   within a common passage hardly ever are. A part key carries its size class, and a
   set goes to the class of every possible larger partner. Parts empty in both sets
   prove nothing; a set that has as many empty parts as P - D is cut in another way
   as well.
3. Candidate clusters: a key of up to ``FEW`` nodes gives their pairs. A pair stays if
   bitmaps of both sets, of two to four bits a shingle, leave it possible that they
   link: a bit that only one has set is a shingle that the other lacks. So texts that
   share a passage by chance, whose number grows faster than the input, form no
   clusters. A key of more nodes links them to the least of them, first within a
   batch, then over the batches, so a hot key costs some rows a batch. Nodes that
   pairs and links connect form a cluster; nodes of different clusters never link.
4. A cluster's nodes are dealt by size class and id hash into blocks of about
   ``BLOCK`` nodes, or ``SHINGLES`` shingles if that is less. A node probes its own
   block, the later blocks of its class, and those of every higher class that a
   partner can be in; probes of a block come in chunks, each a task's work of bounded
   size. No pair is written out.
5. Prefix tree: a block's ordered sets are stored in a trie, whose edges hold up
   to ``EDGE`` shingles. Sets that link share a shingle among the first
   n - ceil(num * n / den) + 1 of each (n its size) in any one order; a probe goes down
   the branches of the sets it shares such a shingle with, by rarity in the block,
   level by level: overlap with a shared prefix is counted once, and a subtree goes as soon as the overlap
   so far and the remaining lengths cannot reach the threshold. Sets already known
   to be connected are not compared again.

Only texts of nodes that share a part travel, and each link is verified on
whole sets. A cluster of m nodes of one size costs m / (2 * BLOCK) probes a node.

Cases: null and empty texts have no shingles and stay alone; repeated rows
fall together; a component's id is its least non-null doc_id (null if there is
none); an empty table gives no rows; further columns of ``docs`` are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, gram_hashes, heavy_join, mark, materialize, mix, release, shingle_set, slices, turn_to, word_hashes
from .links import connected
from .sketch import cells, magnitudes, may_hold, table_of_bits

#: Nodes of a block, shingles on an edge of its trie, and cuts tried for a set with many empty parts.
BLOCK, EDGE, SEEDS = 4096, 32, 6
#: Shingles of a block, and part keys that a task sorts at a time: what its memory follows.
SHINGLES, KEYS = 1 << 20, 1 << 19
#: Nodes of a key that are compared pair by pair.
FEW = 8
#: Bytes of text whose part keys meet in one bin.
BIN = 256 << 20
#: Cells of the sketch that orders shingles by rarity, as bits: its size does not change what is found.
RARITY_BITS = 22
#: From one size class to the next.
GROWTH = 1.3


def size_classes(n: int) -> list[int]:
    """Class bounds from 1 past n: each at least one more and GROWTH times the last."""
    bounds = [1]
    while bounds[-1] <= n:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * GROWTH)))
    return bounds


_BOUNDS = np.array(size_classes(1 << 40))


def prefix_length(n: int, num: int, den: int) -> int:
    """So many first shingles, in any one order, of two sets that link have one in common."""
    return n + (-num * n) // den + 1


def prefix(h: np.ndarray, rarity: np.ndarray, num: int, den: int) -> np.ndarray:
    """The places of a sorted set's first shingles by (rarity, hash)."""
    return np.argsort(rarity, kind="stable")[: prefix_length(len(h), num, den)]


def class_keys(h: np.ndarray, rarity: np.ndarray, c: int, num: int, den: int) -> np.ndarray:
    """Part keys of a set for partners of size class c; two sets that link share one at least.

    Where a set has so many empty parts that all agreeing ones may be empty in both,
    it has the keys of another cut as well; after SEEDS cuts its empty parts count.
    """
    differ = 2 * (int(_BOUNDS[c]) - 1) * (den - num) // (den + num)
    if not differ:
        return np.empty(0, np.uint64)  # equal sets only, and those are one node
    parts, keys = differ + 1 + differ // 2, []
    for seed in range(SEEDS):
        part = (mix(h ^ np.uint64(0x2545F4914F6CDD1D + seed)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        held, starts = np.unique(part[order], return_index=True)
        sums, rare = np.add.reduceat(h[order], starts), np.minimum.reduceat(rarity[order], starts)
        few = parts - len(held) < parts - differ
        if not few and seed == SEEDS - 1:
            empty = np.setdiff1d(np.arange(parts), held)
            sums, rare, held = np.r_[sums, np.zeros(len(empty), np.uint64)], np.r_[rare, np.full(len(empty), 255, rare.dtype)], np.r_[held, empty]
        own = mix(mix(sums) + held.astype(np.uint64) * np.uint64(2654435761) + np.uint64((c << 40) + (seed << 36)))
        keys.append(own[np.lexsort((own, rare))[: differ + 1]])
        if few:
            break
    return np.concatenate(keys)


def size_class(n: int) -> int:
    return int(np.searchsorted(_BOUNDS, n, "right"))


def parts_of(h: np.ndarray, rarity: np.ndarray, num: int, den: int) -> np.ndarray:
    """Part keys of a set, for every class that a partner of its size or more can be of."""
    if not len(h):
        return np.empty(0, np.uint64)
    return np.concatenate([class_keys(h, rarity, c, num, den) for c in range(size_class(len(h)), size_class(len(h) * den // num) + 1)])


def set_id(h: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(h + np.uint64(len(h)))).astype(np.int64)) if len(h) else 0


def bitmap(h: np.ndarray) -> bytes:
    """A set as two to four bits a shingle, 256 at least: each sets the bit of its hash."""
    size = 1 << max(8, (2 * len(h) - 1).bit_length())
    held = np.zeros(size, bool)
    held[(h & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def may_link(n: int, a: bytes, m: int, b: bytes, num: int, den: int) -> bool:
    """False only if sets of n and m shingles with these bitmaps can't link."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    shared = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
    return den * shared >= num * (n + m - shared)


class PrefixTree:
    """A trie of ordered sets, its edges cut to EDGE shingles, kept level by level as arrays.

    Sets are ranked in the trie's order, so that a node holds a range of ranks.
    """

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
        self.order = np.array(order, np.int64)
        self.rank = np.argsort(self.order)
        self.sizes = np.array([len(sets[k]) for k in order], np.int64)
        edges, self.levels, total = [], [], 0
        open_nodes = [(0, len(sets), 0)] if sets else []  # ranks, depth
        while open_nodes:
            level, following = [], []
            for lo, hi, depth in open_nodes:
                while lo < hi and self.sizes[lo] == depth:
                    lo += 1
                heads = [sets[order[k]][depth] for k in range(lo, hi)]
                cuts = [lo, *(lo + k for k in range(1, hi - lo) if heads[k] != heads[k - 1]), hi] if hi > lo else []
                for a, b in zip(cuts, cuts[1:], strict=False):
                    first, last = sets[order[a]], sets[order[b - 1]]
                    span = min(len(first), len(last), depth + EDGE)
                    same = first[depth:span] == last[depth:span]
                    end = span if same.all() else depth + int(np.argmin(same))
                    edges.append(first[depth:end])
                    level.append((a, total, end - depth, end))
                    total += end - depth
                    following.append((a, b, end))
            if level:
                self.levels.append(np.array(level, np.int64).T)
            open_nodes = following
        self.tokens = np.concatenate(edges) if edges else np.empty(0, np.uint64)

    def links(self, probe: np.ndarray, num: int, den: int, among: np.ndarray | None = None) -> np.ndarray:
        """Places of the sets, or of those among the given places, that link with the probe."""
        n = len(probe)
        ranks = np.arange(len(self.sizes)) if among is None else np.sort(self.rank[among])
        ranks = ranks[(self.sizes[ranks] > 0) & (num * self.sizes[ranks] <= den * n) & (num * n <= den * self.sizes[ranks])]
        shared, found = np.zeros(len(ranks), np.int64), [ranks[:0]]
        for first, start, length, depth in self.levels:
            if not len(ranks):
                break
            node, head, place = np.unique(np.searchsorted(first, ranks, "right") - 1, return_index=True, return_inverse=True)
            starts, lengths = start[node], length[node]
            offset = np.cumsum(lengths) - lengths
            token = self.tokens[np.repeat(starts - offset, lengths) + np.arange(lengths.sum())]
            at = np.searchsorted(probe, token)
            hit = probe[np.minimum(at, n - 1)] == token
            overlap = shared[head] + np.add.reduceat(hit, offset, dtype=np.int64)
            left = n - at[offset + lengths - 1] - hit[offset + lengths - 1]
            # a subtree goes when none of its sets can overlap enough with what is left of both
            sizes, below = self.sizes[ranks], self.sizes[ranks] - depth[node][place]
            shared = overlap[place]
            reach = shared + np.minimum(left[place], below)
            alive = den * reach >= num * (n + sizes - reach)
            found.append(ranks[alive & (below == 0)])
            ranks, shared = ranks[alive & (below > 0)], shared[alive & (below > 0)]
        return np.sort(self.order[np.concatenate(found)])


class Block:
    """The sets of one block: their trie, their prefix shingles, and which of them are known to be connected."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        self.tree, self.label = PrefixTree(sets), np.arange(len(sets))
        self.token, self.often = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_counts=True)
        held = [self._prefix(h) for h in sets]
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), list(map(len, held)))
        at = np.concatenate(held) if held else np.empty(0, np.int64)
        self.owner = owner[np.argsort(at, kind="stable")]
        self.start = np.r_[0, np.cumsum(np.bincount(at, minlength=len(self.token)))]

    def _prefix(self, h: np.ndarray) -> np.ndarray:
        """Places among the block's shingles of the set's first ones by rarity in the block; those it lacks come first and drop out."""
        at = np.minimum(np.searchsorted(self.token, h), len(self.token) - 1)
        often = np.where(self.token[at] == h, self.often[at], 0)
        chosen = prefix(h, often, self.num, self.den)
        return at[chosen[often[chosen] > 0]]

    def _partners(self, h: np.ndarray) -> np.ndarray:
        """Places of the sets that share a prefix shingle with h; of all sets, where a search by these would take longer."""
        if not len(self.token):
            return np.empty(0, np.int64)
        at = self._prefix(h)
        low = self.start[at]
        counts = self.start[at + 1] - low
        if counts.sum() > 4 * len(self.sets):
            return np.arange(len(self.sets))
        return np.unique(self.owner[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())])

    def inner(self) -> list[tuple[int, int]]:
        """Links that connect all of the block's sets that its links connect."""
        out = []
        for i, h in enumerate(self.sets):
            among = self._partners(h)
            among = among[(among > i) & (self.label[among] != self.label[i])]
            for j in self.tree.links(h, self.num, self.den, among).tolist() if len(among) else ():
                if self.label[i] != self.label[j]:
                    self.label[self.label == self.label[j]] = self.label[i]
                    out.append((i, j))
        return out

    def outer(self, h: np.ndarray) -> list[int]:
        """A set that links with the probe h, of each group of connected sets that has one."""
        out, among, some = [], self._partners(h), 1
        while len(among):
            among = among[np.argsort(self.label[among], kind="stable")]
            _, start, size = np.unique(self.label[among], return_index=True, return_counts=True)
            early = np.arange(len(among)) - np.repeat(start, size) < some
            hits = self.tree.links(h, self.num, self.den, among[early])
            labels, at = np.unique(self.label[hits], return_index=True)
            out += hits[at].tolist()
            among = among[~early & ~np.isin(self.label[among], labels)]
            some *= 8
        return out


_PACKED = pa.schema([("bin", pa.int32()), ("payload", pa.binary()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_PACKED_DDL = "bin int, payload binary, row long, doc_id long, n long, a long, b long"
_MET_DDL = "row long, doc_id long, n long, a long, b long"


def _rows(schema: pa.Schema, length: int, **held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held[f.name], f.type) if f.name in held else pa.nulls(length, f.type) for f in schema], schema=schema)


def _pack(key: np.ndarray, at: np.ndarray, sid: np.ndarray, many: np.ndarray) -> bytes:
    """Sorted keys (their upper 48 bits) and the ids they belong to, each id once; ``many`` marks keys that stand for more ids.

    Keys that agree in 48 bits of a bin by chance add a pair to verify, no more.
    """
    own, place = np.unique(at, return_inverse=True)
    high = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return np.array([len(key), len(own)], "<u4").tobytes() + high.tobytes() + (place + (many << 15)).astype("<u2").tobytes() + sid[own].astype("<i8").tobytes()


def _unpack(data: bytes, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys whose upper byte is from low to below high, their ids and marks."""
    n, m = np.frombuffer(data, "<u4", 2)
    packed = np.frombuffer(data, np.uint8, 6 * n, 8).reshape(n, 6)
    a, b = np.searchsorted(packed[:, 5], [low, high])
    key = np.zeros((b - a, 8), np.uint8)
    key[:, 2:] = packed[a:b]
    place = np.frombuffer(data, "<u2", n, 8 + 6 * n)[a:b]
    return key.view("<u8").ravel(), np.frombuffer(data, "<i8", m, 8 + 8 * n)[place & 0x7FFF], place >> 15 > 0


def _pair_rows(schema: pa.Schema, n: int, a: np.ndarray, b: np.ndarray, bins: int = 1) -> Iterator[pa.RecordBatch]:
    """Each pair once; n says of which kind they are: -1 of a key's few ids, -2 of its least id and another."""
    pairs = np.unique(np.stack([a, b], 1), axis=0)
    if len(pairs):
        yield _rows(schema, len(pairs), bin=np.arange(len(pairs)) % bins, n=np.full(len(pairs), n, np.int64), a=pairs[:, 0], b=pairs[:, 1])


def _starred(keys: list[np.ndarray], ids: list[int], bins: int) -> Iterator[pa.RecordBatch]:
    """Packed (key, id) by bin; of keys with more than FEW of the given sets only the least id, and star pairs."""
    key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    if not len(key):
        return
    sid = np.array(ids)
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), list(map(len, keys)))
    order = np.lexsort((sid[doc], key))
    key, doc = key[order], doc[order]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
    key, doc = key[fresh], doc[fresh]
    head = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(head) - 1
    many = (np.bincount(group) > FEW)[group]
    inner = many & ~head
    yield from _pair_rows(_PACKED, -2, sid[doc[head]][group[inner]], sid[doc[inner]], bins)
    key, doc, many = key[~inner], doc[~inner], many[~inner]
    to = (key % np.uint64(bins)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    own, starts = np.unique(to[order], return_index=True)
    yield _rows(_PACKED, len(own), bin=own, payload=[_pack(key[p], doc[p], sid, many[p]) for p in np.split(order, starts[1:])])


def _stars(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, bins: int, rarity) -> Iterator[pa.RecordBatch]:
    """Of (row, doc_id, text): a row for each document (its id in a), and what _starred gives for about KEYS keys at a time.

    A set that the task has met before adds no keys. ``rarity`` is broadcast: the magnitude of each sketch cell.
    """
    turn_to()
    keys, own, count, met = [], [], 0, set()
    for batch in (part for batch in batches for part in slices(batch, "text")):
        sizes, ids = [], []
        for text in batch["text"]:
            h = shingle_set(text.as_py() or "", k)
            sizes.append(len(h))
            ids.append(set_id(h) if len(h) else None)
            if not len(h) or ids[-1] in met:
                continue
            met.add(ids[-1])
            own.append(ids[-1])
            keys.append(parts_of(h, rarity.value[cells(h, 0, RARITY_BITS)], num, den))
            count += len(keys[-1])
            if count >= KEYS or len(own) == 1 << 15:
                yield from _starred(keys, own, bins)
                keys, own, count = [], [], 0
        yield _rows(_PACKED, len(batch), bin=np.arange(len(batch)) % bins, row=batch["row"], doc_id=batch["doc_id"], n=sizes, a=ids)
    yield from _starred(keys, own, bins)


_MET = pa.schema(list(_PACKED)[2:])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and pairs as they are; of the packed keys, all pairs of few ids, and else pairs of a key's least id with its others."""
    turn_to()
    bins: dict[int, list] = {}
    for batch in batches:
        plain = batch["payload"].is_null()
        rest = batch.filter(plain)
        if len(rest):
            yield pa.RecordBatch.from_arrays([rest[f.name] for f in _MET], schema=_MET)
        for b, data in zip(batch["bin"].to_pylist(), batch["payload"], strict=True):
            if data.is_valid:
                bins.setdefault(b, []).append(data.as_py())
    for b in list(bins):
        packed = bins.pop(b)
        for low in range(0, 256, 32):  # an eighth of the bin's keys at a time
            key, sid, many = (np.concatenate(x) for x in zip(*(_unpack(data, low, low + 32) for data in packed), strict=True))
            if not len(key):
                continue
            order = np.lexsort((sid, key))
            key, sid, many = key[order], sid[order], many[order]
            head = np.r_[True, key[1:] != key[:-1]]
            group = np.cumsum(head) - 1
            fresh = head | np.r_[True, sid[1:] != sid[:-1]]
            large = np.bincount(group[fresh]) > FEW
            large[group[many]] = True
            least, inner = sid[head][group], fresh & ~head & large[group]
            yield from _pair_rows(_MET, -2, least[inner], sid[inner])
            group, sid = (x[fresh & ~large[group]] for x in (group, sid))
            near = [np.flatnonzero(group[d:] == group[:-d]) for d in range(1, FEW)]
            yield from _pair_rows(_MET, -1, *(np.concatenate([sid[i + d * last] for d, i in enumerate(near, 1)]) for last in (0, 1)))


def _search(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Of (block, probe, sid, text) sorted, a block's own nodes before its probes: links (a, b) that connect what all links connect."""
    turn_to()
    name, own, sets, block = None, [], [], None

    def built() -> tuple[Block, list]:
        made = Block(sets, num, den)
        return made, [(own[i], own[j]) for i, j in made.inner()]

    def batch_of(links):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    for batch in batches:
        out = []
        for b, probe, sid, text in zip(batch["block"].to_pylist(), batch["probe"].to_pylist(), batch["sid"].to_pylist(), batch["text"], strict=True):
            if b != name:
                if block is None:
                    out += built()[1]
                name, own, sets, block = b, [], [], None
            h = shingle_set(text.as_py() or "", k)
            if not probe:
                own.append(sid)
                sets.append(h)
                continue
            if block is None:
                block, found = built()
                out += found
            out += [(sid, own[j]) for j in block.outer(h)]
        yield batch_of(out)
    if block is None:
        yield batch_of(built()[1])


def _likely(pairs: DataFrame, nodes: DataFrame, source: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Those of the pairs (a, b) of ``nodes`` whose sizes and bitmaps let them link; texts are read, and only bitmaps travel."""
    ends = lambda df, c, *more: df.select(F.col("sid").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in more))
    pairs = pairs.join(ends(nodes, "a", "n"), "a").join(ends(nodes, "b", "n"), "b")
    pairs = materialize(pairs.where(F.greatest("n_a", "n_b") * num <= F.least("n_a", "n_b") * den), "few")
    held = materialize(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "sid").join(nodes.select("sid", "row"), "sid"), "held")

    test = table_of_bits(held.select("row"))

    def drawn(batch: pa.RecordBatch):
        some = batch["text"].filter(pa.array(test(batch["row"].to_numpy())))
        sets = [shingle_set(text.as_py() or "", k) for text in some]
        return [set_id(h) for h in sets], [bitmap(h) for h in sets]

    maps = arrow_map(source.select("row", "text"), drawn, "sid long, bits binary")
    maps = materialize(maps.join(held.select("sid"), "sid").dropDuplicates(["sid"]), "bitmaps")

    @F.arrow_udf("boolean")
    def possible(n: pa.Array, a: pa.Array, m: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([may_link(*x, num, den) for x in zip(n.to_pylist(), a.to_pylist(), m.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())

    both = pairs.join(ends(maps, "a", "bits"), "a").join(ends(maps, "b", "bits"), "b")
    return both.where(possible("n_a", "bits_a", "n_b", "bits_b")).select("a", "b")


def _dealt(nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(block, probe, sid) from (sid, cluster, n): each node in its own block and as a probe of the others it may link with.

    ``block`` names a block's chunk: its own nodes come in each, its probes are dealt among them.
    """
    bounds = F.array(*(F.lit(int(x)) for x in _BOUNDS))
    of_size = lambda n: F.size(F.filter(bounds, lambda x: x <= n))
    nodes = nodes.withColumn("c", of_size(F.col("n"))).withColumn("top", of_size(F.floor(F.col("n") * den / num)))
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("n") / F.lit(SHINGLES))).cast("int")
    held = nodes.groupBy("cluster", "c").agg(blocks.alias("blocks"), F.count("*").alias("rows"))
    chunks = held.groupBy("cluster").agg(F.ceil(F.sum("rows") / F.lit(4 * BLOCK)).cast("int").alias("chunks"))
    held = held.join(chunks, "cluster").withColumnRenamed("c", "to")
    visits = nodes.select("sid", "cluster", "c", F.explode(F.sequence("c", "top")).alias("to"))
    visits = heavy_join(visits, held, ["cluster", "to"], "rows").where("blocks is not null")
    home = F.col("to") == F.col("c")
    i = F.when(home, F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")).otherwise(0)
    visits = visits.select("sid", "cluster", "to", "chunks", home.alias("home"), i.alias("i"), F.explode(F.sequence(i, F.col("blocks") - 1)).alias("j"))
    probe = ~(F.col("home") & (F.col("i") == F.col("j")))
    own = F.pmod(F.xxhash64("sid", "j"), F.col("chunks")).cast("int")
    parts = F.when(probe, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    visits = visits.select("sid", "cluster", "to", "j", probe.alias("probe"), F.explode(parts).alias("chunk"))
    return visits.select(F.xxhash64("cluster", "to", "j", "chunk").alias("block"), "probe", "sid")


def ngram_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: row (a hash of id and text), doc_id, n_shingles, component_id, keeper.

    ``keeper`` marks the rows that hold the least (doc_id, row) of their component;
    documents without shingles are keepers. ``docs`` needs doc_id and text.
    """
    spark, since = docs.sparkSession, mark()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("row", F.xxhash64("doc_id", "text"))

    def shingles(batch: pa.RecordBatch) -> np.ndarray:
        words = (word_hashes((text.as_py() or "").encode("utf-8", "surrogatepass"), lower=True) for text in batch["text"])
        return np.concatenate([gram_hashes(w, k) for w in words])

    rarity = spark.sparkContext.broadcast(magnitudes(source.select("text"), shingles, RARITY_BITS))  # one byte a cell
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BIN))
    stars = partial(_stars, k=k, num=num, den=den, bins=bins, rarity=rarity)
    met = source.mapInArrow(stars, _PACKED_DDL).repartition(bins, "bin").mapInArrow(_meet, _MET_DDL)
    met = materialize(met, "stars")
    signed = met.where("n >= 0").select("row", "doc_id", F.col("n").alias("n_shingles"), F.col("a").alias("sid"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    nodes = signed.where("sid is not null").groupBy("sid").agg(first.alias("first"), F.min("row").alias("row"), F.min("n_shingles").alias("n"))
    found = {n: met.where(F.col("n") == n).select("a", "b").distinct() for n in (-1, -2)}
    pairs = materialize(_likely(found[-1], nodes, source, k, num, den).union(found[-2]), "pairs")

    clusters = connected(pairs).select(F.col("node").alias("sid"), F.col("comp").alias("cluster"))
    near = materialize(clusters.join(nodes.select("sid", "row", "n"), "sid"), "near")
    likely = source.select("row", "text").where(may_hold(near.select("row"))(F.col("row")))  # other texts do not travel
    texts = near.select("sid", "row").hint("merge").join(likely, "row").select("sid", "text").dropDuplicates(["sid"])
    dealt = _dealt(near.select("sid", "cluster", "n"), num, den).join(texts, "sid")
    dealt = dealt.select("block", "probe", "sid", "text").repartition("block").sortWithinPartitions("block", "probe")
    links = materialize(dealt.mapInArrow(partial(_search, k=k, num=num, den=den), "a long, b long"), "links")

    labels = connected(links)
    classes = nodes.select("sid", "first").join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "first", F.coalesce("comp", "sid").alias("comp"))
    heads = classes.groupBy("comp").agg(F.min("first").alias("head"))
    classes = materialize(classes.join(heads, "comp").select("sid", "head"), "classes")
    release(spark, since, met, classes)
    out = signed.select("row", "doc_id", "n_shingles", "sid").join(classes, "sid", "left")
    alone = F.col("sid").isNull()
    return out.select(
        "row", "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        (alone | ((F.col("row") == F.col("head.row")) & F.col("doc_id").eqNullSafe(F.col("head.doc_id")))).alias("keeper"),
    )


def op5_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class under 4-word shingles and a Jaccard similarity of 0.85."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ngram_components(docs, k=4, num=85).select("doc_id", "n_shingles", "component_id")
