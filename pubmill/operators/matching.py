"""Watchlist matching over publications, exclusions, rescues and the ordered context tree."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import postings as P

#: A list of up to this many terms goes to every task with the plan; a longer one is looked up by postings.
BROADCAST_TERMS = 200
#: Digits that an id has at least.
LEAST_ID = 5
# The demonstration watchlist (term, category), in order.
WATCHLIST = (
    ("licensed under", "licence"), ("public license", "licence"), ("mit license", "licence"), ("apache license version 2 0", "licence"),
    ("tion", "fragment"), ("the", "article"), ("der", "article"), ("les", "article"), ("que", "pronoun"), ("mail0 example com", "contact"),
    ("cc by nc 4 0", "licence"), ("version 3", "version"), ("and of", "phrase"), ("nicht", "negation"), ("pour", "preposition"),
)
EXCLUDED, RESCUED = ("nicht", "pour", "para"), ("public license", "mit license")
LEVELS = ("CRITICAL", "STRONG", "MEDIUM", "LOW", "NONE")


def publications(docs: DataFrame, most: int | None = None) -> DataFrame:
    """Documents as publications: id, title (first ``most`` characters of the first line, all with None), body and their normalised forms."""
    title = T.first_line(F.col("text"), most)
    pubs = docs.select("doc_id", F.col("lang").alias("section"), F.col("source").alias("organ"), title.alias("title"), "text")
    return T.once(pubs, norm=T.normalise(F.col("text")), norm_title=T.normalise(F.col("title")))


def watchlist(spark: SparkSession, terms=WATCHLIST) -> DataFrame:
    rows = [(i + 1, t, c) for i, (t, c) in enumerate(terms)]
    return spark.createDataFrame(rows, "ord int, term string, category string")


def with_hits(pubs: DataFrame, terms: DataFrame, size: int | None = None) -> DataFrame:
    """``pubs`` with hits: the terms (ord, term, category) that its norm holds as a whole, by ord.

    A watchlist is measured, unless ``size`` says that it is long. Up to BROADCAST_TERMS
    terms become one array, filled in a single pass: no join. A longer one is looked up
    by each term's rarest token (``postings.term_matches``).
    """
    most = BROADCAST_TERMS
    kind = "array<struct<ord:int,term:string,category:string>>"
    inside = lambda t: T.has_term(F.col("norm"), t["term"])
    own = terms.select(F.col("ord").cast("int").alias("ord"), "term", "category")
    rows = [] if size is not None and size > most else own.orderBy("ord").limit(most + 1).collect()  # bounded
    if (size is None or size <= most) and len(rows) <= most:
        hit = lambda r: F.when(F.contains("__padded", F.lit(f" {r['term']} ")), F.struct(*(F.lit(v).alias(k) for k, v in r.asDict().items())))
        hits = F.array_compact(F.array(*map(hit, rows))) if rows else F.array()
        return pubs.withColumn("__padded", F.concat(F.lit(" "), "norm", F.lit(" "))).withColumn("hits", hits.cast(kind)).drop("__padded")
    hit = F.struct("ord", "term", "category")
    found = P.term_matches(pubs, own).groupBy(F.col("doc_id").alias("__doc")).agg(F.array_sort(F.collect_set(hit)).cast(kind).alias("__t"))
    joined = pubs.join(found, pubs["doc_id"].eqNullSafe(found["__doc"]), "left")
    # publications that share an id hold each their own
    return joined.withColumn("hits", F.filter(F.coalesce("__t", F.array().cast(kind)), inside)).drop("__t", "__doc")


def match(pubs: DataFrame, terms: DataFrame, size: int | None = None) -> DataFrame:
    """(doc_id, ord, term, category), one row a publication and term that it holds as a whole."""
    # outer, and filtered after, since the optimiser would compute all hits once more to leave out publications without any
    return with_hits(pubs, terms, size).select("doc_id", F.inline_outer("hits")).where("ord is not null")


def match_ids(pubs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, id) of each id (digits only) that a publication's digits, all put together, hold; see ``postings.id_matches``. Shorter ids than LEAST_ID are none."""
    return P.id_matches(pubs, ids.where(F.length("id") >= LEAST_ID))


def strong_tokens(term: Column) -> Column:
    """Tokens of a normalised term that identify a product: four characters or more, not all digits."""
    return F.array_distinct(F.filter(F.split(term, " "), lambda t: (F.length(t) >= 4) & ~t.rlike("^[0-9]+$")))


def all_near(tokens: Column, wanted: Column, within: int = 12) -> Column:
    """Every wanted token occurs at most ``within`` positions from one occurrence of some wanted token; two tokens at least.

    Around each wanted occurrence only the tokens in reach are looked at.
    """
    reach = lambda ts, i: F.slice(ts, F.greatest(i - within, F.lit(0)) + 1, F.least(i, F.lit(within)) + within + 1)
    places = lambda ts: F.filter(F.sequence(F.lit(0), F.size(ts) - 1), lambda i: F.array_contains(wanted, F.get(ts, i)))
    close = T.let(tokens, lambda ts: F.exists(places(ts), lambda i: F.size(F.array_except(wanted, reach(ts, i))) == 0))
    return F.when((F.size(wanted) >= 2) & (F.size(F.array_except(wanted, tokens)) == 0), close).otherwise(False)


def named_term(term: Column) -> Column:
    """A monograph's term without its leading code; '' where it has none but that."""
    return F.regexp_replace(term, r"^[a-z]?[0-9]+ ", "")


def hybrid_hit(norm: Column, digits: Column, term: Column, kind: Column, origin: Column, padded: Column | None = None, may_be_near: Column | None = None) -> Column:
    """How a number or hybrid term matches: number, hybrid, text, or null.

    Numbers are searched in the text's digits. A product holds as a whole or by its
    strong tokens near each other; a monograph as a whole without its leading code;
    another hybrid by every token as a substring, else as a whole term.
    ``padded`` is the norm between spaces, ``may_be_near`` a cheap test that a text with all strong tokens passes.
    """
    holds = lambda t: T.has_term(norm, t) if padded is None else F.contains(padded, F.concat(F.lit(" "), t, F.lit(" ")))
    tokens = F.split(norm, " ")
    whole = holds(term)
    near = all_near(tokens, strong_tokens(term))
    product = whole | (near if may_be_near is None else may_be_near & near)
    named = named_term(term)
    monograph = (named != "") & holds(named)
    loose = F.forall(F.split(term, " "), lambda t: F.contains(norm, t))
    found = F.when(origin == "product", product).when(origin == "monograph", monograph).otherwise(loose)
    return F.when(kind == "number", F.when((T.digits(term) != "") & F.contains(digits, T.digits(term)), "number")).otherwise(F.when(found, "hybrid").when(whole, "text"))


def match_hybrid(pubs: DataFrame, terms: DataFrame, size: int | None = None) -> DataFrame:
    """(doc_id, ord, term, how) for number and hybrid terms (ord, term, kind, origin).

    Up to BROADCAST_TERMS terms are tried in one pass over the texts; more, or where ``size`` says so, go by postings.
    """
    rows = terms.where("term <> ''").orderBy("ord").limit(BROADCAST_TERMS + 1).collect()  # bounded
    if (size or len(rows)) > BROADCAST_TERMS:
        return P.hybrid_matches(pubs, terms)
    if not rows:
        return pubs.select("doc_id", F.lit(0).alias("ord"), F.lit("").alias("term"), F.lit("").alias("how")).limit(0)
    pubs = T.once(pubs.select("doc_id", "text", "norm"), digits=T.digits(F.col("text"))).withColumn("__padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    found = pubs.select("doc_id", F.explode(F.array(*map(_hybrid, rows))).alias("h"))
    return found.select("doc_id", "h.*").where("how is not null")


def _hybrid(r) -> Column:
    """Of a term's row: ord, term and how, null without a match, over norm, digits and __padded."""
    strong = [t for t in r["term"].split(" ") if len(t) >= 4]
    may = reduce(Column.__and__, (F.contains("__padded", F.lit(f" {t} ")) for t in strong if not (t.isascii() and t.isdigit())), F.lit(True))
    how = hybrid_hit(F.col("norm"), F.col("digits"), F.lit(r["term"]), F.lit(r["kind"]), F.lit(r["origin"]), F.col("__padded"), may)
    return F.struct(F.lit(r["ord"]).alias("ord"), F.lit(r["term"]).alias("term"), how.alias("how"))


def match_all(pubs: DataFrame, hybrids: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, term, kind) of ``match_hybrid`` and, of kind direct, of ``match``; short lists in one pass over the texts."""
    rows = hybrids.where("term <> ''").orderBy("ord").limit(BROADCAST_TERMS + 1).collect()  # bounded
    if not rows or len(rows) > BROADCAST_TERMS:
        hybrid = match_hybrid(pubs, hybrids).select("doc_id", "term", F.col("how").alias("kind"))
        return hybrid.unionByName(match(pubs, terms).select("doc_id", "term", F.lit("direct").alias("kind")))
    pubs = with_hits(T.once(pubs.select("doc_id", "text", "norm"), digits=T.digits(F.col("text"))), terms)
    pubs = pubs.withColumn("__padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    one = lambda term, kind: F.struct(term.alias("term"), kind.alias("kind"))
    hybrid = F.array(*(one(h["term"], h["how"]) for h in map(_hybrid, rows)))
    direct = F.transform("hits", lambda h: one(h["term"], F.lit("direct")))
    return pubs.select("doc_id", F.explode(F.concat(hybrid, direct)).alias("h")).select("doc_id", "h.*").where("kind is not null")


def near(norm: Column, first: str, second: str, within: int = 12) -> Column:
    """Both tokens occur, at most ``within`` positions apart; one pass over the tokens."""
    far = F.lit(-(within + 1))
    begin = F.struct(F.lit(0).alias("i"), far.alias("a"), far.alias("b"), F.lit(False).alias("hit"))

    def step(at, x):
        a, b = F.when(x == first, at["i"]).otherwise(at["a"]), F.when(x == second, at["i"]).otherwise(at["b"])
        met = ((x == first) & (at["i"] - b <= within)) | ((x == second) & (at["i"] - a <= within))
        return F.struct((at["i"] + 1).alias("i"), a.alias("a"), b.alias("b"), (at["hit"] | met).alias("hit"))

    both = T.has_term(norm, F.lit(first)) & T.has_term(norm, F.lit(second))
    return both & F.aggregate(F.split(norm, " "), begin, step, lambda at: at["hit"])


def any_term(norm: Column, terms) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | T.has_term(norm, F.lit(t))
    return out


def exclusion(pubs: DataFrame, excluded=EXCLUDED, rescued=RESCUED) -> DataFrame:
    """status of each publication: title exclusion first, rescued by its body or not; and the first excluding term of the list."""
    out, back = any_term(F.col("norm_title"), excluded), any_term(F.col("norm"), rescued)
    by = F.get(F.filter(F.lit(list(excluded)), lambda t: T.has_term(F.col("norm_title"), t)), F.lit(0)) if excluded else F.lit(None).cast("string")
    return pubs.withColumn("status", F.when(~out, "OPEN").when(back, "RESCUED").otherwise("EXCLUDED")).withColumn("excluded_by", by)


def without_excluded(hits: Column, excluded=EXCLUDED) -> Column:
    """Hits whose own term is no excluding term."""
    return F.filter(hits, lambda h: ~h["term"].isin(*excluded)) if excluded else hits


def context_level(cats: Column) -> Column:
    """The ordered tree: the first rule that holds gives the level."""
    has = lambda c: F.coalesce(F.array_contains(cats, c), F.lit(False))
    leaf = lambda level, rank: F.struct(F.lit(level).alias("level"), F.lit(rank).alias("rank"))
    return (
        F.when(has("licence") & has("version"), leaf("CRITICAL", 12))
        .when(has("licence") & has("contact"), leaf("STRONG", 11))
        .when(has("licence"), leaf("STRONG", 9))
        .when(has("contact"), leaf("MEDIUM", 6))
        .when(has("negation") | has("preposition"), leaf("LOW", 3))
        .when(F.coalesce(F.size(cats), F.lit(0)) > 0, leaf("LOW", 1))
        .otherwise(leaf("NONE", 0))
    )


def scored(docs: DataFrame, most: int | None = None, terms: DataFrame | None = None) -> DataFrame:
    """Publications with hits, status, level and rank, from one pass over the texts: excluded ones have no level."""
    pubs = with_hits(exclusion(publications(docs, most)), watchlist(docs.sparkSession) if terms is None else terms)
    cats = F.array_distinct(F.transform("hits", lambda h: h["category"]))
    tree = context_level(F.when(F.col("status") != "EXCLUDED", cats))
    return pubs.select("doc_id", "section", "organ", "title", "status", "hits", F.size("hits").cast("long").alias("n_terms"), tree["level"].alias("level"), tree["rank"].cast("long").alias("rank"))


def ordered_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key in a stated order: what 'first wins' means once rows are distributed.

    The least of (order, row), so rows combine before they are shuffled and no key is gathered.
    """
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.struct(*df.columns).alias("row"))
    return df.groupBy(*keys).agg(F.min(place).alias("__least")).select("__least.row.*")
