"""Records: canonical projections, contracts, dedup by key, titles, links and their resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import postings as P
from pubmill.operators.matching import ordered_first
from pubmill.operators.titles import fuzzy_titles  # noqa: F401

# The columns that may hold each field, in order of preference.
ALIASES: dict[str, tuple[str, ...]] = {
    "title": ("title", "heading", "listing_title", "name", "abstract"),
    "text": ("full_text", "text", "content", "body", "description"),
    "abstract": ("listing_abstract", "abstract", "description"),
    "url": ("url", "link", "href"),
    "published": ("published", "day", "reference_day"),
    "section": ("section",),
    "organ": ("organ", "agency"),
    "source": ("source",),
}
#: Fields without which a publication is invalid, and those that are only missed.
REQUIRED, WANTED = ("id", "source", "published", "title", "organ", "text"), ("url", "hash")


def base_record(raw: DataFrame, ord_: str, aliases: Mapping[str, Sequence[str]] = ALIASES, source: str = "GAZETTE") -> DataFrame:
    """The canonical record of each raw row: id, hash, ord, the fields of ``aliases``, text_size, status, and the other columns as a map.

    A missing title is the first line of the text, 300 characters of it at most; a
    missing id is made from the source and a hash of what identifies the row.
    """
    field = lambda f: T.first_filled(*(F.col(c).cast("string") for c in aliases[f] if c in raw.columns)) if set(aliases[f]) & set(raw.columns) else F.lit("")
    known = {c for names in aliases.values() for c in names} | {ord_, "id"}
    rest = [x for c in raw.columns if c not in known for x in (F.lit(c), F.col(c).cast("string"))]
    out = raw.select(
        F.col(ord_).alias("ord"),
        (T.first_filled(F.col("id").cast("string")) if "id" in raw.columns else F.lit("")).alias("own_id"),
        *(field(f).alias(f) for f in aliases),
        (F.create_map(*rest) if rest else F.lit(None).cast("map<string,string>")).alias("extra"),
    )
    out = out.withColumn("source", F.when(F.col("source") == "", source).otherwise(F.col("source")))
    out = out.withColumn("title", F.when(F.col("title") != "", F.col("title")).otherwise(F.substring(F.trim(T.first_line(F.col("text"), None)), 1, 300)))
    digest = T.short_hash(F.col("source"), F.col("published"), F.col("section"), F.col("url"), F.substring("text", 1, 300))
    out = out.withColumn("id", F.when(F.col("own_id") != "", F.col("own_id")).otherwise(F.concat_ws("|", "source", digest)))
    out = out.withColumn("hash", F.when(F.col("text") == "", "").otherwise(F.sha2("text", 256)))
    return out.withColumn("text_size", F.length("text").cast("long")).withColumn("status", F.when(F.col("text") == "", "NO_TEXT").otherwise("OK")).drop("own_id")


def validated(base: DataFrame) -> DataFrame:
    """``base`` with errors, warnings and verdict: INVALID with any error, INCOMPLETE with warnings only, else OK."""
    missing = lambda names, word: [F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(f"{word} {c}")) for c in names]
    filled = F.coalesce(F.trim("published"), F.lit("")) != ""
    form = F.when(filled & T.parse_date(F.col("published")).isNull(), F.lit("not a date published"))
    out = base.withColumn("errors", F.array_compact(F.array(*missing(REQUIRED, "missing"), form))).withColumn("warnings", F.array_compact(F.array(*missing(WANTED, "empty"))))
    return out.withColumn("verdict", F.when(F.size("errors") > 0, "INVALID").when(F.size("warnings") > 0, "INCOMPLETE").otherwise("OK"))


def last_filled(df: DataFrame, keys: list[str], ord_: str, columns: list[str]) -> DataFrame:
    """One row a key: of each column the last value that is neither null nor blank."""
    filled = lambda c: F.trim(F.col(c)) != ""
    return df.groupBy(*keys).agg(*(F.max_by(F.when(filled(c), F.col(c)), F.when(filled(c), F.col(ord_))).alias(c) for c in columns))


def union_by_key(frames: Sequence[DataFrame], key: Column, ord_: str) -> DataFrame:
    """All rows, one a key: that of the earliest frame, then of the least ord."""
    every = None
    for place, df in enumerate(frames):
        own = df.withColumn("__place", F.lit(place))
        every = own if every is None else every.unionByName(own, allowMissingColumns=True)
    return ordered_first(every.withColumn("__key", key), ["__key"], [F.col("__place"), F.col(ord_)]).drop("__key", "__place")


def numbered(df: DataFrame, key: str, ord_: str, name: str, width: int = 1 << 20) -> DataFrame:
    """``df`` with its rows' places within each key by an integer ord, from 1; a key of very many rows is numbered in stretches of ``width``.

    Places within a stretch come from a window over that stretch alone, and what lies
    before it from a running sum over the stretches' counts. Null ords come first; rows
    of one ord have places in no stated order.
    """
    cut = df.withColumn("__part", F.coalesce(F.floor(F.col(ord_) / width), F.lit(-(1 << 62))))
    # by the same key as the window, so stretches are shuffled once
    ranked = cut.withColumn("__own", F.row_number().over(W.partitionBy(key, "__part").orderBy(F.col(ord_).asc_nulls_first())))
    counts = ranked.groupBy(key, "__part").agg(F.max("__own").alias("__n"))
    earlier = W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(F.col(key).alias("__key"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    joined = ranked.join(counts, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__of")))
    return joined.select(*df.columns, (F.col("__before") + F.col("__own")).alias(name))


def primary_occurrence(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Of hits (keys, field, place, offset): count and the primary one, those in the full text first, then by field and offset."""
    first = F.min(F.struct((F.col("field") != "full_text").alias("later"), "place", "offset", "field"))
    return hits.groupBy(*keys).agg(F.count("*").alias("n_hits"), first.alias("least")).select(*keys, "n_hits", "least.field", "least.offset")


def useful_text(title: Column, *fields: Column, least: int = 40) -> Column:
    """The first field that is longer than ``least`` characters and not just the title; else ''."""
    good = lambda c: (F.length(F.trim(c)) > least) & (T.comparison_key(c) != T.comparison_key(title))
    return F.coalesce(*(F.when(good(c), F.trim(c)) for c in fields), F.lit(""))


def ranked_url(text: Column, hosts: Sequence[str]) -> Column:
    """Of the addresses in a text, that of the first listed host, the earliest of several; else the earliest of all; null without one."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"https?://[^\s\"'<>)]+"), F.lit(0)))
    of = lambda h: F.get(F.filter(found, lambda u: F.parse_url(u, F.lit("HOST")) == h), F.lit(0))
    return F.coalesce(*map(of, hosts), F.get(found, F.lit(0)))


def title_tokens(title: Column, stop: Sequence[str], least: int = 3) -> Column:
    words = F.array_distinct(F.split(T.comparison_key(title), " "))
    return F.filter(words, lambda t: (F.length(t) >= least) & ~t.rlike("^[0-9]+$") & ~t.isin(*stop))


def title_numbers(title: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(T.comparison_key(title), F.lit("[0-9]+"), F.lit(0)))


def _share(found: Column, of: Column) -> Column:
    return F.when(F.size(of) > 0, F.size(found) / F.size(of)).otherwise(0.0)


def same_title(wanted: Column, candidate: Column, stop: Sequence[str], share: float = 0.85) -> Column:
    """Equal or contained; else every number of the wanted title and ``share`` of its words occur in the candidate (as substrings)."""
    a, key = T.comparison_key(wanted), T.comparison_key(candidate)
    tokens, numbers = title_tokens(wanted, stop), title_numbers(wanted)

    def close(b):
        present = F.filter(tokens, lambda t: F.contains(b, t))
        return (F.size(tokens) > 0) & F.forall(numbers, lambda x: F.contains(b, x)) & (_share(present, tokens) >= share)

    return (a != "") & (key != "") & (F.contains(key, a) | T.let(key, close))


def link_score(wanted: Column, link_text: Column, href: Column, stop: Sequence[str], penalty: str = "/law-") -> Column:
    """300 for an equivalent title, up to 120 for words and 160 for numbers found, 100 off for an address of another kind."""
    both = T.comparison_key(F.concat_ws(" ", link_text, href))
    tokens, numbers = title_tokens(wanted, stop), title_numbers(wanted)
    part = lambda x, most: F.floor(_share(T.let(both, lambda b: F.filter(x, lambda t: F.contains(b, t))), x) * most)
    off = F.contains(F.lower(href), F.lit(penalty)) & ~F.contains(T.comparison_key(wanted), F.lit(penalty.strip("/-")))
    return (F.when(same_title(wanted, link_text, stop), 300).otherwise(0) + part(tokens, 120) + part(numbers, 160) - F.when(off, 100).otherwise(0)).cast("long")


def plain_url(url: Column) -> Column:
    """Without fragment and trailing slashes; the viewing page of a PDF is the PDF."""
    bare = F.rtrim(F.substring_index(F.coalesce(url, F.lit("")), "#", 1), F.lit("/"))
    return F.when(F.endswith(F.lower(bare), F.lit(".pdf/view")), F.left(bare, F.length(bare) - 5)).otherwise(bare)


def url_sources(urls: DataFrame, roots: DataFrame, column: str = "url") -> DataFrame:
    """``urls`` with source: that of the first of the roots (ord, root, source) that an address is, or lies below; null without one.

    Roots are looked up by every folder above the address, so there is no search
    through them. A root that ends in "/" is the same without.
    """
    own = roots.where("root is not null").groupBy(plain_url(F.col("root")).alias("folder")).agg(F.min(F.struct("ord", "source")).alias("first"))
    steps = F.split(plain_url(F.col(column)), "/")
    above = T.let(steps, lambda s: F.transform(F.sequence(F.lit(1), F.size(s)), lambda k: F.array_join(F.slice(s, F.lit(1), k), "/")))
    tried = urls.select(column, F.explode(F.array_distinct(above)).alias("folder")).distinct()
    found = tried.join(F.broadcast(own) if P.fits(own, "folder") else own, "folder").groupBy(column).agg(F.min("first").alias("first"))
    return urls.join(found, column, "left").withColumn("source", F.col("first.source")).drop("first")


def of_source(name: Column, wanted: Sequence[str], refused: Sequence[str] = ()) -> Column:
    """Whether a source's normalised name holds one of the wanted parts and none of the refused ones."""
    norm = T.normalise(name)
    holds = lambda parts: F.exists(F.lit(list(parts)), lambda p: F.contains(norm, p)) if parts else F.lit(False)
    return holds(wanted) & ~holds(refused)


def term_categories(terms: DataFrame, vocabulary: DataFrame, column: str = "term", otherwise: str = "product") -> DataFrame:
    """``terms`` with category: of the vocabularies (word, category, prio) that list the normalised term, the one of least prio; else ``otherwise``.

    An equi-join, whatever the number of words.
    """
    first = vocabulary.groupBy(T.normalise(F.col("word")).alias("__key")).agg(F.min(F.struct("prio", "category"))["category"].alias("category"))
    keyed = terms.withColumn("__key", T.normalise(F.col(column)))
    known = F.broadcast(first) if P.fits(first, "__key", "category") else first
    return keyed.join(known, "__key", "left").withColumn("category", F.coalesce("category", F.lit(otherwise))).drop("__key")


def resolve(wanted: DataFrame, cache: DataFrame, candidates: DataFrame) -> DataFrame:
    """(key, url, how) for wanted (key): from cache (key, url, found), found ones only, else the best candidate.

    Candidates are (key, url, score, valid); of the valid ones that of highest score,
    then least url, wins. Without any the key is MISSING.
    """
    best = candidates.where("valid").groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("less"), "url"))["url"].alias("best"))
    held = cache.where("found").groupBy("key").agg(F.min("url").alias("cached"))
    out = wanted.select("key").join(held, "key", "left").join(best, "key", "left")
    how = F.when(F.col("cached").isNotNull(), "CACHE").when(F.col("best").isNotNull(), "FOUND").otherwise("MISSING")
    return out.select("key", F.coalesce("cached", "best").alias("url"), how.alias("how"))


def guarded(left: DataFrame, right: DataFrame, keys: Sequence[list[str]], value: str) -> DataFrame:
    """``left`` with ``value`` of right by the first of the key lists that names exactly one of its rows; how is that list, or null.

    A key of right that several rows share names none. Null parts match nothing; rows with them are dealt over
    the tasks by a hash of the row, since all of them would meet in one. ``left`` is read past a hashed part of the keys, a row each, and not sorted.
    """
    out, row = left, F.xxhash64(*left.columns)
    for i, on in enumerate(keys):
        alone = right.groupBy(*on).agg(F.count("*").alias("rows"), F.min(value).alias(f"__v{i}")).where("rows = 1").select(*on, f"__v{i}", F.lit(0).cast("long").alias("__deal"))
        null = reduce(Column.__or__, (F.col(c).isNull() for c in on))
        out = out.withColumn("__deal", F.when(null, row).otherwise(F.lit(0).cast("long"))).join(alone.hint("shuffle_hash"), [*on, "__deal"], "left").drop("__deal")
    v = [F.col(f"__v{i}") for i in range(len(keys))]
    how = F.coalesce(*(F.when(x.isNotNull(), F.lit("+".join(on))) for x, on in zip(v, keys, strict=True)))
    return out.select(*left.columns, F.coalesce(*v).alias(value), how.alias("how"))


#: Digits of a process number in groups: close together, or with up to 40 other characters between groups.
STRICT = r"(?<![0-9])[0-9]{5}[^0-9]{0,12}[0-9]{6}[^0-9]{0,12}[0-9]{4}[^0-9]{0,12}[0-9]{2}(?![0-9])"
WIDE = r"(?<![0-9])[0-9]{5}[^0-9]{0,40}[0-9]{6}[^0-9]{0,40}[0-9]{4}[^0-9]{0,40}[0-9]{2}(?![0-9])"


def pattern_join(pages: DataFrame, portfolio: DataFrame) -> DataFrame:
    """(doc, page, process, how) of monitored numbers on pages (doc, page, text): STRICT, or WIDE_REVIEW where no strict one is on the page."""
    found = lambda p, how: pages.select("doc", "page", F.explode(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias("raw"), F.lit(how).alias("how"))
    both = found(STRICT, 0).unionByName(found(WIDE, 1)).select("doc", "page", T.digits(F.col("raw")).alias("process"), "how")
    first = both.groupBy("doc", "page", "process").agg(F.min("how").alias("how")).join(portfolio, "process")
    return first.select("doc", "page", "process", F.when(F.col("how") == 0, "STRICT").otherwise("WIDE_REVIEW").alias("how"))


def digest_rows(pubs: DataFrame) -> DataFrame:
    """One row for each process of a publication (id, title, processes), one with a null process for a publication without any."""
    return pubs.select("id", "title", F.explode_outer(F.when(F.size("processes") > 0, F.array_distinct("processes"))).alias("process"))
