"""Matching by postings, for lists of terms, pairs and ids of any length.

A list is measured first. One that fits ``BYTES`` travels to every task, and a longer one is
joined by shuffle, its hot tokens salted; both look tokens up instead of trying
every term on every text. ``pubs`` are publications with doc_id and norm (normalised text).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.sinks import written

#: Bytes, and rows, of a list that goes to every task.
BYTES, ROWS = 32 << 20, 500_000
#: A token with more than one in HOT postings is dealt over SALTS tasks; there are HOT such tokens at most.
HOT, SALTS = 512, 32
#: Characters by which a token inside a word is looked up, if it has as many.
GRAM = 3
#: Tokens of a term up to which each length is looked up by itself.
ALONE = 8
#: Places that a task gathers before it gives them on, and texts' words whose tokens it remembers.
PLACES, WORDS = 500_000, 200_000
#: By which a hash's second bit is found; products of it and 32 bits fit a long.
MIX = 0x5BD1E995


def fits(df: DataFrame, *columns: str) -> bool:
    """Whether these columns are few and short enough for every task."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.concat_ws("", *(F.col(c).cast("string") for c in columns))) + 32), F.lit(0))).first()
    return n <= ROWS and size <= BYTES


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _same_row(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def row_tokens(pubs: DataFrame, *columns: str) -> DataFrame:
    """(*columns, token) for each distinct token of a publication."""
    return pubs.select(*columns, F.explode(F.array_distinct(F.split("norm", " "))).alias("token"))


def rarest(parts: DataFrame, seen: DataFrame) -> DataFrame:
    """(ord, token, n) of each term's token of fewest postings; terms of which some token has none are left out.

    ``parts`` are (ord, token) of the terms' tokens, ``seen`` (token, n) their postings.
    """
    least = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least")
    return parts.join(seen, "token", "left").groupBy("ord").agg(least).where("least.n > 0").select("ord", "least.token", "least.n")


def frequent(counts: DataFrame, key: str) -> DataFrame:
    """Of counts (key, n), the keys with more than one in HOT of all: HOT of them at most."""
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).where(F.col("n") * HOT > F.col("total")).select(key)


def salted(left: DataFrame, right: DataFrame, on: str, hot: DataFrame, by: str, keep: bool = False, hashed: bool = False) -> DataFrame:
    """Join in which each key of ``hot`` (on), few and known, is dealt over SALTS tasks by the hash of ``by``; right is repeated for these.

    With ``keep`` the task's number stays, as __salt. With ``hashed`` a part of right is held as a hash table, and left is not sorted.
    """
    marked = hot.select(on, F.lit(True).alias("__hot"))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    dealt = left.join(F.broadcast(marked), on, "left").withColumn("__salt", salt).drop("__hot")
    every = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    copies = right.join(F.broadcast(marked), on, "left").withColumn("__salt", F.explode(every)).drop("__hot")
    joined = dealt.join(copies.hint("shuffle_hash") if hashed else copies, [on, "__salt"])
    return joined if keep else joined.drop("__salt")


def list_bits(keys: DataFrame, n: int) -> np.ndarray:
    """Bytes of bits of which each value of the one column of ``keys`` sets two; for n keys, 2 ** 28 bits at most.

    What it lets pass is compared all the same, so its size decides on speed alone. It passes the driver.
    """
    bits = 1 << max(16, min(28, (16 * n - 1).bit_length()))
    h = F.crc32(F.col(keys.columns[0]).cast("binary"))
    second = F.shiftrightunsigned((h * F.lit(MIX)).bitwiseAND(F.lit(0xFFFFFFFF)), 4)
    at = keys.select(F.explode(F.array(*(x.bitwiseAND(F.lit(bits - 1).cast("long")) for x in (h, second)))).alias("at"))
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()  # bits >> 6 words at most
    out = np.zeros(bits >> 6, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.astype("<i8").view(np.uint8)


def may_hold(table: np.ndarray, keys: Sequence[str]) -> np.ndarray:
    """The numbers of the keys of which both bits are set in a table of ``list_bits``."""
    h = np.fromiter((crc32(k.encode()) for k in keys), np.int64, len(keys))
    held = np.ones(len(keys), bool)
    for at in (h, ((h * MIX) & 0xFFFFFFFF) >> 4):
        at = at & (len(table) * 8 - 1)
        held &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return np.flatnonzero(held)


def length_classes(lengths: Sequence[int]) -> list[tuple[int, int]]:
    """Classes (shortest, longest) of terms' numbers of tokens: each by itself up to ALONE, then each class ends at twice its shortest."""
    classes: list[tuple[int, int]] = []
    for n in sorted(lengths):
        if n > ALONE and classes and classes[-1][0] > ALONE and n < 2 * classes[-1][0]:
            classes[-1] = (classes[-1][0], n)
        else:
            classes.append((n, n))
    return classes


def stretches(tokens: Sequence[str], n: int, most: int | None = None) -> Iterable[str]:
    """At each place that has n tokens, up to ``most`` of them (n by default) from there, joined by one space."""
    if n == 1 and most is None:
        return tokens
    if most is None:
        return map(" ".join, zip(*(tokens[i:] for i in range(n)), strict=False))
    return (" ".join(tokens[i : i + most]) for i in range(len(tokens) - n + 1))


def _field(df: DataFrame, column: str, name: str | None = None) -> str:
    return f"`{name or column}` {df.schema[column].dataType.simpleString()}"


def shared_ids(df: DataFrame, column: str = "doc_id") -> bool:
    """Whether rows share an id."""
    return df.groupBy(column).count().where("count > 1").limit(1).count() > 0


def _held(pubs: DataFrame, filed: DataFrame, classes: Sequence[tuple[int, int]]) -> DataFrame:
    """(doc_id, ord) of terms (ord, term, seed), few enough for every task, that a text holds; once a text."""
    rows = filed.select("seed", "term", "ord").toArrow()  # BYTES at most
    shared, kind = pubs.sparkSession.sparkContext.broadcast(rows), rows.schema.field("ord").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed: dict[str, list[tuple]] = {}
        for seed, term, number in zip(*(shared.value[c].to_pylist() for c in ("seed", "term", "ord")), strict=True):
            listed.setdefault(seed, []).append((term, number))
        seeds = frozenset(listed)
        for batch in batches:
            docs, numbers = [], []
            for doc, norm in zip(*(batch[c].to_pylist() for c in ("doc_id", "norm")), strict=True):
                tokens, found = norm.split(" "), []
                for least, most in classes:
                    if least == most:
                        found += (o for p in seeds.intersection(stretches(tokens, least)) for _, o in listed[p])
                    else:
                        at = {i: p for i, p in enumerate(stretches(tokens, least)) if p in seeds}
                        near = {(p, " ".join(tokens[i : i + most]) + " ") for i, p in at.items()}
                        found += {o for p, piece in near for t, o in listed[p] if piece.startswith(f"{t} ")}
                docs += [doc] * len(found)
                numbers += found
                if len(docs) > PLACES:
                    yield pa.RecordBatch.from_arrays([pa.array(docs, batch["doc_id"].type), pa.array(numbers, kind)], ["doc_id", "ord"])
                    docs, numbers = [], []
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch["doc_id"].type), pa.array(numbers, kind)], ["doc_id", "ord"])

    return pubs.select("doc_id", "norm").where("norm is not null").mapInArrow(run, f"{_field(pubs, 'doc_id')}, {_field(filed, 'ord')}")


def _places(pubs: DataFrame, table: np.ndarray, classes: Sequence[tuple[int, int]]) -> DataFrame:
    """(seed, piece, doc_id, first) of the stretches whose seed a table of bits lets pass, once a text; equal ones of a task lie together.

    A stretch that is no longer than its seed has no piece. One row of a text is its first.
    """
    shared = pubs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, kind = shared.value, None

        def rows(held: dict[tuple, list], first: bool) -> pa.RecordBatch:
            keys = sorted(held, key=lambda k: (k[0], k[1] or ""))
            at = pa.array(np.repeat(np.arange(len(keys)), [len(held[k]) for k in keys]))
            seed, piece = (pa.array([k[i] for k in keys], pa.string()).take(at) for i in (0, 1))
            docs = pa.array(list(chain.from_iterable(held[k] for k in keys)), kind)
            return pa.RecordBatch.from_arrays([seed, piece, docs, pa.array(np.full(len(at), first))], ["seed", "piece", "doc_id", "first"])

        firsts, others, n = defaultdict(list), defaultdict(list), 0
        for batch in batches:
            kind = batch["doc_id"].type
            for doc, norm in zip(*(batch[c].to_pylist() for c in ("doc_id", "norm")), strict=True):
                tokens, found = norm.split(" "), []
                alone = list({p for least, most in classes if least == most for p in stretches(tokens, least)})
                found += ((alone[i], None) for i in may_hold(bits, alone))
                for least, most in classes:
                    if least < most:
                        seeds = list(stretches(tokens, least))
                        found += {(seeds[i], " ".join(tokens[i : i + most])) for i in may_hold(bits, seeds)}
                for key in found[:1]:
                    firsts[key].append(doc)
                for key in found[1:]:
                    others[key].append(doc)
                n += len(found)
                if n > PLACES:
                    yield from (rows(firsts, True), rows(others, False))
                    firsts, others, n = defaultdict(list), defaultdict(list), 0
        if n:
            yield from (rows(firsts, True), rows(others, False))

    return pubs.select("doc_id", "norm").where("norm is not null").mapInArrow(run, f"seed string, piece string, {_field(pubs, 'doc_id')}, first boolean")


def term_matches(pubs: DataFrame, terms: DataFrame, small: bool | None = None) -> DataFrame:
    """(doc_id, ord, term, category), once each, of the terms (ord unique) that a publication's norm holds as a whole, for lists of any length.

    A text's stretches of as many tokens as terms have are looked up as they are, so that what is
    found is what matches, however common the words are. Lengths of more than ALONE tokens go in classes: by the tokens of the
    shortest, with those that follow to be compared. Before a long list's join is shuffled, stretches that are not in the list's bits go.
    Its join reads them as they come, against a hashed part of the list, so that they are not sorted; copies are
    looked for only where ids are shared or long terms may be met twice in a text.
    ``small`` states whether the list fits every task; it is measured otherwise.
    """
    own = written(terms.select("ord", "term", "category", F.size(F.split("term", " ")).alias("k")), "terms")  # read several times
    small = fits(own, "term", "category") if small is None else small
    classes = length_classes([r[0] for r in own.select("k").distinct().collect()])  # lengths of terms
    if not classes:
        return own.crossJoin(pubs.select("doc_id").limit(0)).select("doc_id", "ord", "term", "category")
    seed = F.lit(None).cast("string")
    for least, most in reversed(classes):
        seed = F.when(F.col("k").between(least, most), F.col("term") if least == most else F.array_join(F.slice(F.split("term", " "), 1, least), " ")).otherwise(seed)
    filed = own.withColumn("seed", seed).drop("k")
    if small:
        found = _held(pubs, filed, classes).distinct()
        return found.join(F.broadcast(own.drop("k")), "ord").select("doc_id", "ord", "term", "category")
    seeds = filed.select("seed").distinct()
    places = written(_places(pubs, list_bits(seeds, seeds.count()), classes), "places")  # the texts are read once
    hot = frequent(places.groupBy("seed").agg(F.count("*").alias("n")), "seed")
    whole = F.col("piece").isNull() | F.startswith(F.concat("piece", F.lit(" ")), F.concat("term", F.lit(" ")))
    # what lies together for the join stays so until copies are dropped
    met = salted(places.drop("first"), filed, "seed", hot, "doc_id", keep=True, hashed=True).where(whole)
    if any(least < most for least, most in classes) or shared_ids(places.where("first")):
        met = met.select("doc_id", "ord", "term", "category", "seed", "__salt").distinct()
    return met.select("doc_id", "ord", "term", "category")


def facet_bitmaps(matches: DataFrame, facets: Sequence[str]) -> DataFrame:
    """(doc_id, facets): a bit for each of the ordered facets (63 at most) of which a publication holds a term."""
    if len(facets) > 63:
        raise ValueError("more facets than a long has bits")
    bit = F.create_map(*(x for i, f in enumerate(facets) for x in (F.lit(f), F.lit(1 << i).cast("long"))))
    return matches.where(F.col("category").isin(*facets)).groupBy("doc_id").agg(F.bit_or(bit[F.col("category")]).alias("facets"))


def in_facets(bits: Column, facets: Sequence[str], every: Sequence[str] = (), none: Sequence[str] = ()) -> Column:
    """Whether a bitmap over ``facets`` has every one of some and none of others."""
    mask = lambda names: F.lit(sum(1 << facets.index(f) for f in names)).cast("long")
    held = F.coalesce(bits, F.lit(0).cast("long"))
    return (held.bitwiseAND(mask(every)) == mask(every)) & (held.bitwiseAND(mask(none)) == F.lit(0).cast("long"))


def near_matches(pubs: DataFrame, terms: DataFrame, within: int = 12) -> DataFrame:
    """(doc_id, ord) where all tokens of a term (ord, tokens) lie at most ``within`` positions from one of its tokens.

    Positions of the wanted tokens only, in order, and one sweep: around each position
    the window of ``within`` must hold as many different tokens as the term has.
    """
    parts = terms.select("ord", F.explode(F.array_distinct("tokens")).alias("token"), F.size(F.array_distinct("tokens")).alias("need"))
    parts = _small(parts, fits(parts, "ord", "token"))
    # rows that share an id do not share positions
    at = pubs.select("doc_id", F.xxhash64("norm").alias("row"), F.posexplode(F.split("norm", " ")).alias("at", "token"))
    around = W.partitionBy("doc_id", "row", "ord").orderBy("at").rangeBetween(-within, within)
    met = at.join(parts, "token").withColumn("met", F.size(F.collect_set("token").over(around)))
    return met.where("met = need").select("doc_id", "ord").distinct()


def _loosely_held(pubs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, ord) of terms (ord, term), few enough for every task, of which a text holds every token, also inside words; once a text.

    What a word holds is found by its stretches of as many characters as tokens have, and remembered.
    """
    rows = terms.select("ord", "term").toArrow()  # BYTES at most
    shared, kind = pubs.sparkSession.sparkContext.broadcast(rows), rows.schema.field("ord").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filed, wanted = defaultdict(list), defaultdict(set)
        for number, term in zip(*(shared.value[c].to_pylist() for c in ("ord", "term")), strict=True):
            need = frozenset(term.split(" ")) - {""}
            for t in need:
                wanted[len(t)].add(t)
            if need:
                filed[max(need, key=lambda t: (len(t), t))].append((number, need))  # long ones are rare
        inside: dict[str, list[str]] = {}

        def tokens_of(word: str) -> list[str]:
            out = [t for n, ts in wanted.items() for t in ts.intersection(word[i : i + n] for i in range(len(word) - n + 1))]
            if len(inside) >= WORDS:
                inside.clear()
            if len(word) <= 100:
                inside[word] = out
            return out

        for batch in batches:
            docs, numbers = [], []
            for doc, norm in zip(*(batch[c].to_pylist() for c in ("doc_id", "norm")), strict=True):
                held: set[str] = set()
                for word in set(norm.split(" ")):
                    own = inside.get(word)
                    held.update(tokens_of(word) if own is None else own)
                found = [number for t in held & filed.keys() for number, need in filed[t] if need <= held]
                docs += [doc] * len(found)
                numbers += found
                if len(docs) > PLACES:
                    yield pa.RecordBatch.from_arrays([pa.array(docs, batch["doc_id"].type), pa.array(numbers, kind)], ["doc_id", "ord"])
                    docs, numbers = [], []
            yield pa.RecordBatch.from_arrays([pa.array(docs, batch["doc_id"].type), pa.array(numbers, kind)], ["doc_id", "ord"])

    return pubs.select("doc_id", "norm").where("norm is not null").mapInArrow(run, f"{_field(pubs, 'doc_id')}, {_field(terms, 'ord')}")


def loose_matches(pubs: DataFrame, terms: DataFrame, small: bool | None = None, once: bool = True) -> DataFrame:
    """(doc_id, ord) where a text holds every token of a term (ord, term), also inside words.

    A list that fits every task is looked up text by text, and nothing of the texts is shuffled; without ``once``, rows that share an id
    give each their own. For a longer one,
    the words of all texts, each once, are looked up by the rarest gram of each token; a
    term's rarest token then names the texts to try, and in these the different tokens
    met are counted against the term's need.
    ``small`` states whether the list fits; it is measured otherwise.
    """
    terms = terms.where("term is not null")
    if fits(terms, "term") if small is None else small:
        found = _loosely_held(pubs, terms)
        return found.distinct() if once else found
    parts = terms.select("ord", F.explode(F.array_distinct(F.split("term", " "))).alias("token")).where("token <> ''")
    need = parts.groupBy("ord").agg(F.count("*").alias("need"))
    tokens = parts.select("token").distinct()
    grams = lambda c, q: T.grams(F.col(c), q)
    own = tokens.select("token", F.explode(F.array_distinct(grams("token", F.least(F.length("token"), F.lit(GRAM))))).alias("gram"))
    held = row_tokens(pubs, "doc_id", F.xxhash64("norm").alias("row")).withColumnRenamed("token", "word").where("word <> ''")
    # the corpus's dictionary with its counts; the texts are read for it, and once more for what its words hold
    counted = written(held.groupBy("word").agg(F.count("*").alias("n")), "words")
    words = counted.select("word")
    sizes = sorted(r[0] for r in own.select(F.length("gram")).distinct().collect())  # GRAM of them at most
    every = F.flatten(F.array(*(grams("word", F.lit(q)) for q in sizes or [GRAM])))
    small = fits(tokens, "token")
    inside = words.select("word", F.explode(F.array_distinct(every)).alias("gram")).join(_small(own.select("gram").distinct(), small), "gram")
    counts = inside.groupBy("gram").agg(F.count("*").alias("n"))
    key = own.join(counts, "gram", "left").groupBy("token").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"].alias("gram"))
    met = inside.join(key, "gram").where(F.contains("word", F.col("token"))).select("word", "token")
    has = written(salted(held, met, "word", frequent(counted, "word"), "doc_id").select("doc_id", "row", "token").distinct(), "held")
    seen = has.groupBy("token").agg(F.count("*").alias("n"))
    filed = rarest(parts, seen)
    tried = salted(has, filed.select("ord", "token"), "token", frequent(seen, "token"), "doc_id").select("doc_id", "row", "ord")
    asked = tried.join(parts, "ord")
    found = asked.join(has, _same_row(asked, has, "doc_id", "row") & (asked["token"] == has["token"])).select(asked["doc_id"], asked["row"], "ord")
    return found.groupBy("doc_id", "row", "ord").agg(F.count("*").alias("n")).join(need, "ord").where("n = need").select("doc_id", "ord").distinct()


def id_matches(pubs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, id) of each id (digits only) that a publication's digits, all put together, hold.

    Digits of neighbouring numbers run on, so an id may span two of them. Ids are looked
    up by seeds, as long as the shortest id of a class of lengths (each class ends at twice
    its shortest), at every place of the digits; the digits that follow, as many as the class's longest id has, come along to be
    compared.
    """
    ids = ids.select("id").where(F.length("id") > 0).distinct()
    lengths = sorted(r[0] for r in ids.select(F.length("id")).distinct().limit(1000).collect())  # an id has some digits
    classes: list[tuple[int, int]] = []
    for n in lengths:
        if classes and n < 2 * classes[-1][0]:
            classes[-1] = (classes[-1][0], n)
        else:
            classes.append((n, n))
    if not classes:
        return pubs.select("doc_id", F.lit(None).cast("string").alias("id")).limit(0)
    digits = T.once(pubs.select("doc_id", "text"), digits=T.digits(F.col("text"))).select("doc_id", "digits").where("digits <> ''")
    small = fits(ids, "id")

    def found(least: int, most: int) -> DataFrame:
        pieces = T.grams(F.col("digits"), F.lit(least), F.lit(most))
        at = digits.where(F.length("digits") >= least).select("doc_id", F.explode(F.array_distinct(pieces)).alias("piece")).withColumn("seed", F.substring("piece", 1, least))
        own = ids.where(F.length("id").between(least, most)).withColumn("seed", F.substring("id", 1, least))
        return at.join(_small(own, small), "seed").where(F.startswith("piece", F.col("id"))).select("doc_id", "id")

    out = found(*classes[0])
    for c in classes[1:]:
        out = out.unionByName(found(*c))
    return out.distinct()


def hybrid_matches(pubs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, ord, term, how) as ``match_hybrid`` defines them, for terms (ord, term, kind, origin) of any number."""
    from pubmill.operators.matching import named_term, strong_tokens

    terms = written(terms.select(F.col("ord").cast("int").alias("ord"), "term", "kind", F.coalesce("origin", F.lit("")).alias("origin")), "terms")
    of = lambda where: terms.where(where)
    listed = lambda df, term: df.select("ord", term.alias("term"), F.lit("").alias("category")).where("term <> ''")
    found = lambda df, how: df.select("doc_id", "ord", F.lit(how).alias("how"))
    numbers = of("kind = 'number'").select("ord", T.digits(F.col("term")).alias("id")).where("id <> ''")
    number = id_matches(pubs, numbers.select("id")).join(numbers, "id")
    word = F.col("term")
    whole = term_matches(pubs, listed(of("kind <> 'number' and origin in ('product', 'monograph')"), word))
    strong = of("kind <> 'number' and origin = 'product'").select("ord", strong_tokens(word).alias("tokens")).where(F.size("tokens") >= 2)
    named = term_matches(pubs, listed(of("kind <> 'number' and origin = 'monograph'"), named_term(word)))
    other = of("kind <> 'number' and origin not in ('product', 'monograph')").select("ord", "term").where("term <> ''")
    # 0: as a hybrid, 1: only as a whole
    kinds = terms.select("ord", "origin")
    rated = whole.join(kinds, "ord").select("doc_id", "ord", F.when(F.col("origin") == "product", 0).otherwise(1).alias("how"))
    for df in (near_matches(pubs, strong), named, loose_matches(pubs, other, once=False)):
        rated = rated.unionByName(found(df, 0))
    hybrid = rated.groupBy("doc_id", "ord").agg(F.min("how").alias("how"))
    both = hybrid.select("doc_id", "ord", F.when(F.col("how") == 0, "hybrid").otherwise("text").alias("how")).unionByName(found(number, "number").distinct())
    return both.join(terms.select("ord", "term"), "ord").select("doc_id", "ord", "term", "how")
