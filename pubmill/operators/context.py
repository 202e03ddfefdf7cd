"""Context classifiers as rule tables over vocabulary facets; the first rule that holds decides.

A facet is the set of a vocabulary's terms that a publication holds: those its
matches name and those found whole in its normalised text. Rules name the facets
they need; vocabularies are parameters, so the tables below are only defaults.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubmill.functions import text as T

# Neutral demonstration vocabularies, one a facet.
VOCABULARY: dict[str, tuple[str, ...]] = {
    "company": ("mit license", "ment", "erinst"),
    "regulator": ("auf", "los", "con", "que"),
    "technical": ("version 3", "einer", "thansh"),
    "act": ("nded", "inti", "chber"),
    "event": ("than", "des", "apache license version 2 0"),
    "activity": ("ching", "heon", "schst", "fur"),
    "sector": ("ines", "orti", "los"),
    "admin": ("dem", "elle", "public license"),
    "weak": ("der",),
    "generic": ("les", "tion"),
    "process": ("pour",),
}
# Regulators by the conjunction that their sector rule asks for, and the terms that these name.
SECTORS: dict[str, tuple[str, ...]] = {
    "dropped": ("con",),
    "environment": ("auf",),
    "metrology": ("los",),
    "trade": ("fur",),
    "health": ("que",),
    "strong_events": ("than",),
    "seizures": ("than", "des"),
    "inspections": ("heon", "ching"),
    "trade_events": ("des",),
    "trade_activities": ("schst", "fur"),
    "health_events": ("des", "than"),
    "health_acts": ("nded", "inti"),
    "product_activities": ("heon", "ching"),
    "traded_products": ("les",),
    "pharma": ("bezu", "enbe"),
    "broad_health": ("auto", "elle"),
}


def held_terms(text: Column, terms: Sequence[str]) -> Column:
    """The terms that a padded normalised text holds whole, in the order given."""
    found = [F.when(F.contains(text, F.lit(f" {t} ")), F.lit(t)) for t in terms]  # compiled, unlike a filter over a list of terms
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def facets(pubs: DataFrame, vocabulary: Mapping[str, Sequence[str]] = VOCABULARY) -> DataFrame:
    """``pubs`` (norm, hits: array of structs with term and category) with facets, an array of terms for each.

    ``product`` holds the matched terms of category product that no other vocabulary
    claims; weak and generic hold matched terms only.
    """
    padded = F.col("__padded")
    matched = F.array_distinct(F.transform("hits", lambda m: m["term"]))
    own = lambda name: F.array_intersect(matched, F.lit(list(vocabulary[name])))
    columns = [F.array_sort(own(f) if f in ("weak", "generic") else F.array_union(own(f), held_terms(padded, vocabulary[f]))).alias(f) for f in vocabulary]
    claimed = sorted({t for f in ("generic", "weak", "regulator", "technical", "act", "event", "process") for t in vocabulary[f]})
    products = F.transform(F.filter("hits", lambda m: m["category"] == "product"), lambda m: m["term"])
    product = F.array_sort(F.array_distinct(F.array_except(products, F.lit(claimed)))).alias("product")
    pubs = pubs.withColumn("__padded", F.concat(F.lit(" "), "norm", F.lit(" ")))
    return pubs.withColumn("facets", F.struct(*columns, product)).drop("__padded")


def any_of(name: str) -> Column:
    return F.size(F.col("facets")[name]) > 0


def meets(facet: str, terms: Sequence[str]) -> Column:
    return F.arrays_overlap(F.col("facets")[facet], F.lit(list(terms)))


class Rule(NamedTuple):
    name: str
    level: str
    rank: int
    relevant: bool
    needs: tuple[str, ...]


# The leaves of the context tree in order, with level, rank and the facets each needs.
CONTEXT_RULES = (
    Rule("administrative", "NONE", 0, False, ("downgraded",)),
    Rule("company and event", "CRITICAL", 12, True, ("company", "event")),
    Rule("company and regulator", "STRONG", 11, True, ("company", "regulator")),
    Rule("company and act", "STRONG", 10, True, ("company", "act")),
    Rule("company and product", "STRONG", 9, True, ("company", "product")),
    Rule("company and activity", "MEDIUM_HIGH", 8, True, ("company", "activity")),
    Rule("company and process", "MEDIUM_HIGH", 7, True, ("company", "process")),
    Rule("company", "MEDIUM", 6, True, ("company",)),
    Rule("product, event and regulator", "STRONG", 8, True, ("product", "event", "regulator")),
    Rule("product, regulator and activity", "MEDIUM_HIGH", 7, True, ("product", "regulator", "activity")),
    Rule("product, regulator and act", "MEDIUM", 6, True, ("product", "regulator", "act")),
    Rule("sector", "SECTOR", 6, False, ("monitored",)),
    Rule("product and event", "REVIEW", 4, False, ("product", "event")),
    Rule("product and strong regulation", "REVIEW", 3, False, ("product", "strong")),
    Rule("any match", "LOW", 1, False, ("matched",)),
    Rule("no match", "NONE", 0, False, ()),
)
# The older tree over match categories, in order.
LEGACY_RULES = (
    Rule("company and regulation", "STRONG", 10, True, ("c:company", "c:regulatory|technical")),
    Rule("product and regulation", "MEDIUM", 7, True, ("c:product", "c:regulatory|technical")),
    Rule("company and product", "MEDIUM_HIGH", 6, True, ("c:company", "c:product")),
    Rule("process and context", "MEDIUM", 5, True, ("c:process", "c:technical|regulatory|company")),
    Rule("any match", "LOW", 1, False, ("matched",)),
    Rule("no match", "NONE", 0, False, ()),
)


def downgraded() -> Column:
    """Administrative vocabulary without company, regulator or sector terms."""
    return any_of("admin") & ~any_of("company") & ~any_of("regulator") & ~any_of("sector")


def monitored(sectors: Mapping[str, Sequence[str]] = SECTORS, sector_terms: Sequence[str] = VOCABULARY["sector"]) -> Column:
    """The sector rule of the first regulator group that the publication names; none holds without such a group.

    Pharmaceutical and broad health words count as plain substrings.
    """
    s = sectors
    goods = any_of("sector") | meets("generic", s["traded_products"]) | any_of("product")
    within = lambda name: reduce(lambda a, b: a | b, [F.contains("norm", F.lit(t)) for t in s[name]], F.lit(False))
    environment = meets("event", s["strong_events"]) & goods & (meets("activity", s["product_activities"]) | any_of("technical") | any_of("sector"))
    metrology = meets("event", s["seizures"]) & meets("activity", s["inspections"]) & goods
    trade = meets("event", s["trade_events"]) & meets("activity", s["trade_activities"])
    context = goods | meets("activity", s["product_activities"]) | meets("act", s["health_acts"])
    health = ~within("pharma") & meets("event", s["health_events"]) & context & ~(within("broad_health") & ~goods)
    return (
        F.when(meets("regulator", s["dropped"]), False)
        .when(meets("regulator", s["environment"]), environment)
        .when(meets("regulator", s["metrology"]), metrology)
        .when(meets("regulator", s["trade"]), trade)
        .when(meets("regulator", s["health"]), health)
        .otherwise(False)
    )


def _need(name: str) -> Column:
    if name.startswith("c:"):
        return F.exists("hits", lambda m: m["category"].isin(*name[2:].split("|")))
    plain = {"downgraded": downgraded, "monitored": monitored, "matched": lambda: F.size("hits") > 0, "strong": lambda: any_of("regulator") | any_of("technical")}
    plain["process"] = lambda: any_of("process") | F.exists("hits", lambda m: m["category"] == "process")
    return plain[name]() if name in plain else any_of(name)


def decide(rules: Sequence[Rule]) -> Column:
    """The first rule that holds, as a struct (rule, level, rank, relevant); null if none does."""
    out = None
    for r in rules:
        leaf = F.struct(F.lit(r.name).alias("rule"), F.lit(r.level).alias("level"), F.lit(r.rank).cast("long").alias("rank"), F.lit(r.relevant).alias("relevant"))
        holds = reduce(lambda a, b: a & b, map(_need, r.needs), F.lit(True))
        out = F.when(holds, leaf) if out is None else out.when(holds, leaf)
    return out


def ambiguous_product(padded: Column, word: str, contexts: Sequence[str], vetoes: Sequence[str] = ()) -> Column:
    """A word of several meanings counts as a product only beside one of its contexts and none of its vetoes."""
    holds = lambda terms: F.size(held_terms(padded, terms)) > 0
    vetoed = holds(vetoes) if vetoes else F.lit(False)
    return holds([word]) & holds(contexts) & ~vetoed


class Section(NamedTuple):
    section: str
    relevance: str
    needs: tuple[str, ...]


# Sections of a bulletin in order, with relevance and what each needs.
SECTIONS = (
    Section("DIRECT", "HIGH", ("company",)),
    Section("STANDARDS", "MEDIUM", ("certified", "valid_product")),
    Section("PRODUCTS", "MEDIUM", ("strong_product",)),
    Section("PRODUCTS", "LOW", ("ambiguous_valid",)),
    Section("STANDARDS", "LOW", ("certified",)),
    Section("TRADE", "LOW", ("trade",)),
    Section("REGULATORS", "LOW", ("regulator",)),
    Section("SECTOR", "LOW", ("upstream_sector",)),
    Section("DISCARDED", "DISCARDED", ()),
)
#: Pieces of evidence kept for each kind.
EVIDENCE = 10


def _told(name: str) -> Column:
    return F.transform(F.slice(F.col(name), 1, EVIDENCE), lambda t: F.concat(F.lit(f"{name}: "), t))


def curate(found: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """``found`` (an array of terms for each name that ``sections`` need) with section, relevance and evidence of the first that holds.

    Evidence names the kind and term of what the section needs, at most EVIDENCE of each.
    """
    out = None
    for s in sections:
        lines = [_told(name) for name in s.needs]
        leaf = F.struct(F.lit(s.section).alias("section"), F.lit(s.relevance).alias("relevance"), (F.concat(*lines) if lines else F.array().cast("array<string>")).alias("evidence"))
        holds = reduce(lambda a, b: a & b, [F.size(name) > 0 for name in s.needs], F.lit(True))
        out = F.when(holds, leaf) if out is None else out.when(holds, leaf)
    return found.withColumn("curated", out).select(*found.columns, "curated.*")


def traced_terms(evidence: Column, most: int = 80) -> Column:
    """The term after the first colon of each piece of evidence, those over ``most`` characters left out, each once by its comparison key."""
    after = F.transform(evidence, lambda e: F.trim(F.regexp_extract(e, r"^[^:]*:(.*)$", 1)))
    return T.ordered_distinct(F.filter(after, lambda t: (t != "") & (F.length(t) <= most)))


def excerpt_round(padded: Column, word: Column, margin: int = 40) -> Column:
    """What stands round the first whole occurrence of a word in a padded normalised text, ``margin`` characters on each side; null without one."""
    at = F.instr(padded, F.concat(F.lit(" "), word, F.lit(" ")))
    lo = F.greatest(at - margin, F.lit(1))
    hi = F.least(at + F.length(word) + (margin + 2), F.length(padded) + 1)
    return F.when(at > 0, F.substring(padded, lo, hi - lo))


def context_note(word: Column, excerpt: Column, phrases: Mapping[str, Sequence[str]]) -> Column:
    """GENERIC where the excerpt holds a set phrase of its keyword, else an empty string; display only."""
    out = F.when(F.lit(False), "")
    for key, known in phrases.items():
        out = out.when((word == key) & reduce(lambda a, b: a | b, [F.contains(excerpt, F.lit(p)) for p in known]), "GENERIC")
    return out.otherwise("")


def synthesis(direct: Column, medium: Column, low: Column) -> Column:
    """The summary sentence of a bulletin by what it counts."""
    return (
        F.when(direct > 0, F.format_string("%d direct, %d of medium relevance", direct, medium))
        .when(medium > 0, F.format_string("no direct, %d of medium relevance", medium))
        .when(low > 0, F.format_string("%d of low relevance only", low))
        .otherwise("nothing relevant")
    )
