"""Queries of the context classifiers, hybrid matching and curation."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import context as C
from pubmill.operators import matching as M
from pubmill.plans.base import n, norm_sql, query, table, values

# The terms that these queries monitor, with their categories.
TERMS = (
    ("than", "product"), ("ment", "company"), ("los", "regulatory"), ("des", "product"), ("heble", "product"), ("rein", "product"), ("einer", "technical"),
    ("pour", "process"), ("der", "product"), ("les", "product"), ("ines", "product"), ("inor", "product"), ("ench", "product"), ("orti", "legacy"),
)
_LINE = "split_part(coalesce(text, ''), chr(10), 1)"
_HOLDS = lambda terms, on="pad": f"list_filter([{', '.join(map(repr, terms))}]::VARCHAR[], lambda t: contains({on}, ' ' || t || ' '))"
_MATCHED = lambda terms: f"list_filter([{', '.join(map(repr, terms))}]::VARCHAR[], lambda t: list_contains(matched, t))"
_V, _S = C.VOCABULARY, C.SECTORS
_CLAIMED = sorted({t for f in ("generic", "weak", "regulator", "technical", "act", "event", "process") for t in _V[f]})
_PRODUCTS = [t for t, c in TERMS if c == "product" and t not in _CLAIMED]
_HITS = f"""d AS (SELECT doc_id, {norm_sql('text')} AS norm, ' ' || {norm_sql('text')} || ' ' AS pad FROM documents),
h AS (SELECT *, {_HOLDS([t for t, _ in TERMS])} AS matched FROM d)"""
_FACETS = f"""{_HITS}, f AS (SELECT *, {', '.join(f"{_MATCHED(t) if k in ('weak', 'generic') else _HOLDS(t)} AS {k}" for k, t in _V.items())},
  {_MATCHED(_PRODUCTS)} AS product FROM h)"""
_HAS = lambda f: f"len({f}) > 0"
_MEETS = lambda f, name: f"list_has_any({f}, [{', '.join(map(repr, _S[name]))}]::VARCHAR[])"
_INSIDE = lambda name: "(" + " OR ".join(f"contains(norm, {t!r})" for t in _S[name]) + ")"
_GOODS = f"({_HAS('sector')} OR {_MEETS('generic', 'traded_products')} OR {_HAS('product')})"
_DOWN = f"({_HAS('admin')} AND NOT {_HAS('company')} AND NOT {_HAS('regulator')} AND NOT {_HAS('sector')})"
_SECTOR = f"""CASE WHEN {_MEETS('regulator', 'dropped')} THEN false
 WHEN {_MEETS('regulator', 'environment')} THEN {_MEETS('event', 'strong_events')} AND {_GOODS}
  AND ({_MEETS('activity', 'product_activities')} OR {_HAS('technical')} OR {_HAS('sector')})
 WHEN {_MEETS('regulator', 'metrology')} THEN {_MEETS('event', 'seizures')} AND {_MEETS('activity', 'inspections')} AND {_GOODS}
 WHEN {_MEETS('regulator', 'trade')} THEN {_MEETS('event', 'trade_events')} AND {_MEETS('activity', 'trade_activities')}
 WHEN {_MEETS('regulator', 'health')} THEN NOT {_INSIDE('pharma')} AND {_MEETS('event', 'health_events')}
   AND ({_GOODS} OR {_MEETS('activity', 'product_activities')} OR {_MEETS('act', 'health_acts')}) AND NOT ({_INSIDE('broad_health')} AND NOT {_GOODS})
 ELSE false END"""
_CATEGORY = lambda *names: "len(list_filter(matched, lambda t: t IN (" + ", ".join(repr(t) for t, c in TERMS if c in names) + "))) > 0"
_NEED = {
    "downgraded": _DOWN,
    "monitored": f"({_SECTOR})",
    "matched": "len(matched) > 0",
    "strong": f"({_HAS('regulator')} OR {_HAS('technical')})",
    "process": f"({_HAS('process')} OR {_CATEGORY('process')})",
}


def _case(rules, column):
    def need(name):
        return _CATEGORY(*name[2:].split("|")) if name.startswith("c:") else _NEED.get(name, _HAS(name))

    literal = lambda r: str(getattr(r, column)).lower() if isinstance(getattr(r, column), bool) else repr(getattr(r, column))
    return "CASE " + " ".join(f"WHEN {' AND '.join(map(need, r.needs)) or 'true'} THEN {literal(r)}" for r in rules) + " END"


def _tree_sql(rules):
    return f"WITH {_FACETS} SELECT doc_id, {_case(rules, 'name')} AS rule, {_case(rules, 'level')} AS level, ({_case(rules, 'rank')})::BIGINT AS rank, {_case(rules, 'relevant')} AS relevant FROM f"


def _faceted(spark, d):
    terms = M.watchlist(spark, TERMS)
    return C.facets(M.with_hits(M.publications(table(spark, d, "documents")), terms))


@query(_tree_sql(C.CONTEXT_RULES))
def q_context_tree(spark, d):
    return _faceted(spark, d).select("doc_id", C.decide(C.CONTEXT_RULES).alias("x")).select("doc_id", "x.*")


@query(_tree_sql(C.LEGACY_RULES))
def q_legacy_score(spark, d):
    return _faceted(spark, d).select("doc_id", C.decide(C.LEGACY_RULES).alias("x")).select("doc_id", "x.*")


@query(f"WITH {_FACETS} SELECT doc_id, {_DOWN} AS downgraded FROM f")
def q_admin_downgrade(spark, d):
    return _faceted(spark, d).select("doc_id", C.downgraded().alias("downgraded"))


@query(f"WITH {_FACETS} SELECT doc_id, {_SECTOR} AS monitored FROM f")
def q_sector_monitor(spark, d):
    return _faceted(spark, d).select("doc_id", C.monitored().alias("monitored"))


@query(f"WITH {_FACETS} SELECT doc_id, {', '.join(f'array_to_string(list_sort({k}), chr(44)) AS {k}' for k in (*_V, 'product'))} FROM f")
def q_facets(spark, d):
    joined = [F.array_join(F.col("facets")[k], ",").alias(k) for k in (*_V, "product")]
    return _faceted(spark, d).select("doc_id", *joined)


# Number and hybrid terms with kind and origin.
HYBRIDS = (
    (1, "200", "number", ""), (2, "version 3", "hybrid", ""), (3, "17 than", "hybrid", "monograph"), (4, "ther thre 500", "hybrid", "product"),
    (5, "with this", "hybrid", "product"), (6, "2 0", "hybrid", ""), (7, "mit license 1", "hybrid", ""), (8, "that from", "hybrid", "product"),
)


def _strong(term):
    return [t for t in dict.fromkeys(term.split(" ")) if len(t) >= 4 and not t.isdigit()]


def _hybrid_sql(ord_, term, kind, origin):
    whole = f"contains(pad, ' {term} ')"
    if kind == "number":
        return f"SELECT doc_id, {ord_} AS ord, '{term}' AS term, 'number' AS how FROM t WHERE contains(digits, '{term}')"
    loose = " AND ".join(f"contains(norm, '{t}')" for t in term.split(" "))
    if origin == "monograph":
        loose = f"contains(pad, ' {term.split(' ', 1)[1]} ')"
    if origin == "product":
        words = _strong(term)
        places = "list_filter(range(len(toks)), lambda i: toks[i + 1] IN (" + ", ".join(map(repr, words)) + "))"
        close = " AND ".join(f"len(list_filter(range(len(toks)), lambda j: toks[j + 1] = '{w}' AND abs(j - a) <= 12)) > 0" for w in words)
        loose = whole if len(words) < 2 else f"({whole} OR len(list_filter({places}, lambda a: {close})) > 0)"
    return f"SELECT doc_id, {ord_} AS ord, '{term}' AS term, CASE WHEN {loose} THEN 'hybrid' ELSE 'text' END AS how FROM t WHERE {loose} OR {whole}"


@query(f"""WITH t AS (SELECT doc_id, {norm_sql('text')} AS norm, ' ' || {norm_sql('text')} || ' ' AS pad, string_split({norm_sql('text')}, ' ') AS toks,
 regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') AS digits FROM documents)
{' UNION ALL '.join(_hybrid_sql(*h) for h in HYBRIDS)}""")
def q_match_hybrid(spark, d):
    terms = spark.createDataFrame(HYBRIDS, "ord int, term string, kind string, origin string")
    return M.match_hybrid(M.publications(table(spark, d, "documents")), terms)


@query("""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') AS digits FROM documents),
i AS (SELECT DISTINCT (o_orderkey * 37 % 90000 + 10000)::VARCHAR AS id FROM orders)
SELECT doc_id, id FROM d JOIN i ON contains(digits, id)""")
def q_match_ids(spark, d):
    ids = table(spark, d, "orders").select((F.col("o_orderkey") * 37 % 90000 + 10000).cast("string").alias("id")).distinct()
    return M.match_ids(table(spark, d, "documents"), ids)


_EXCLUDING = ("des", "the", "der")
_OPEN = f"list_filter(['des', 'the', 'der'], lambda t: contains(' ' || {norm_sql(_LINE)} || ' ', ' ' || t || ' '))"


@query(f"""WITH e AS (SELECT doc_id, {_OPEN} AS out, {_HOLDS(M.RESCUED)} AS back, {_HOLDS([t for t, _ in TERMS])} AS matched
 FROM (SELECT *, ' ' || {norm_sql('text')} || ' ' AS pad FROM documents))
SELECT doc_id, CASE WHEN len(out) = 0 THEN 'OPEN' WHEN len(back) > 0 THEN 'RESCUED' ELSE 'EXCLUDED' END AS status, out[1] AS excluded_by,
 len(list_filter(matched, lambda t: t NOT IN ('des', 'the', 'der')))::BIGINT AS n_hits FROM e""")
def q_title_exclusion(spark, d):
    pubs = M.exclusion(M.publications(table(spark, d, "documents")), _EXCLUDING)
    hits = F.size(M.without_excluded(F.col("hits"), _EXCLUDING)).cast("long")
    return M.with_hits(pubs, M.watchlist(spark, TERMS)).select("doc_id", "status", "excluded_by", hits.alias("n_hits"))


# Words of several meanings, with the contexts that make them products and what vetoes them.
AMBIGUOUS = (("rein", ("than", "heble"), ()), ("inor", ("ines", "the"), ("des",)), ("ench", ("los", "que"), ("elle",)))
_AMBIGUOUS = [f"({' AND '.join([_HAS(_HOLDS([w])), _HAS(_HOLDS(c)), *(['NOT ' + _HAS(_HOLDS(v))] if v else [])])})" for w, c, v in AMBIGUOUS]


@query(f"WITH {_HITS} SELECT doc_id, {', '.join(f'{sql} AS {w}' for sql, (w, _, _) in zip(_AMBIGUOUS, AMBIGUOUS, strict=True))} FROM d")
def q_ambiguous_product(spark, d):
    pubs = M.publications(table(spark, d, "documents")).withColumn("pad", F.concat(F.lit(" "), "norm", F.lit(" ")))
    return pubs.select("doc_id", *(C.ambiguous_product(F.col("pad"), w, c, v).alias(w) for w, c, v in AMBIGUOUS))


# What the sections of a bulletin look for.
_FOUND = {
    "company": _V["company"], "certified": ("einer", "version 3"), "strong_product": ("heble", "than"),
    "trade": ("schst", "fur"), "regulator": ("auf", "los"), "upstream_sector": ("orti",),
}
_VALID = "[" + ", ".join(f"CASE WHEN {sql} THEN '{w}' END" for sql, (w, _, _) in zip(_AMBIGUOUS, AMBIGUOUS, strict=True)) + "]"


def _curation_sql():
    def need(s):
        return " AND ".join(_HAS(x) for x in s.needs) or "true"

    evidence = lambda s: " || ".join(f"list_transform({x}[1:10], lambda t: '{x}: ' || t)" for x in s.needs) or "[]::VARCHAR[]"
    case = lambda of: "CASE " + " ".join(f"WHEN {need(s)} THEN {of(s)}" for s in C.SECTIONS) + " END"
    found = ", ".join(f"{_HOLDS(t)} AS {k}" for k, t in _FOUND.items())
    return f"""WITH {_HITS}, a AS (SELECT doc_id, {found}, list_filter({_VALID}, lambda t: t IS NOT NULL) AS ambiguous_valid FROM d),
c AS (SELECT *, strong_product || ambiguous_valid AS valid_product FROM a),
e AS (SELECT doc_id, {case(lambda s: repr(s.section))} AS section, {case(lambda s: repr(s.relevance))} AS relevance, {case(evidence)} AS evidence FROM c)"""


def _curated(spark, d):
    pubs = M.publications(table(spark, d, "documents")).withColumn("pad", F.concat(F.lit(" "), "norm", F.lit(" ")))
    valid = F.array_compact(F.array(*(F.when(C.ambiguous_product(F.col("pad"), w, c, v), w) for w, c, v in AMBIGUOUS)))
    found = pubs.select("doc_id", *(C.held_terms(F.col("pad"), t).alias(k) for k, t in _FOUND.items()), valid.alias("ambiguous_valid"))
    return C.curate(found.withColumn("valid_product", F.concat("strong_product", "ambiguous_valid")))


@query(f"{_curation_sql()} SELECT doc_id, section, relevance, array_to_string(evidence, '; ') AS evidence FROM e")
def q_curation(spark, d):
    return _curated(spark, d).select("doc_id", "section", "relevance", F.array_join("evidence", "; ").alias("evidence"))


@query(f"""{_curation_sql()} SELECT doc_id, array_to_string(list_distinct(list_transform(evidence, lambda x: trim(split_part(x, ': ', 2)))), '') IS NOT NULL
  AND len(evidence) > 0 AS traced, len(list_distinct(list_transform(evidence, lambda x: trim(split_part(x, ': ', 2)))))::BIGINT AS n_terms FROM e""")
def q_traceability(spark, d):
    terms = C.traced_terms(F.col("evidence"))
    return _curated(spark, d).select("doc_id", (F.size("evidence") > 0).alias("traced"), F.size(terms).cast("long").alias("n_terms"))


@query(f"""{_curation_sql()}, k AS (SELECT d.source, count_if(relevance = 'HIGH') AS a, count_if(relevance = 'MEDIUM') AS b, count_if(relevance = 'LOW') AS c
 FROM e JOIN documents d USING (doc_id) GROUP BY d.source)
SELECT source, CASE WHEN a > 0 THEN a || ' direct, ' || b || ' of medium relevance' WHEN b > 0 THEN 'no direct, ' || b || ' of medium relevance'
 WHEN c > 0 THEN c || ' of low relevance only' ELSE 'nothing relevant' END AS summary FROM k""")
def q_synthesis(spark, d):
    source = table(spark, d, "documents").select("doc_id", "source")
    count = lambda level: F.count_if(F.col("relevance") == level)
    counted = _curated(spark, d).join(source, "doc_id").groupBy("source").agg(count("HIGH").alias("a"), count("MEDIUM").alias("b"), count("LOW").alias("c"))
    return counted.select("source", C.synthesis(F.col("a"), F.col("b"), F.col("c")).alias("summary"))


# Words with the set phrases in which they say little.
_PHRASES = {"than": ("than the", "than that"), "with": ("with a",), "des": ("des les", "en des"), "der": ("der die", "und der")}
_NOTES = " ".join(f"WHEN word = '{w}' AND ({' OR '.join(f'contains(excerpt, {p!r})' for p in ps)}) THEN 'GENERIC'" for w, ps in _PHRASES.items())


@query(f"""WITH d AS (SELECT doc_id, ' ' || {norm_sql('text')} || ' ' AS pad FROM documents), k(word) AS (VALUES {', '.join(f"('{w}')" for w in _PHRASES)}),
a AS (SELECT doc_id, word, pad, instr(pad, ' ' || word || ' ') AS i FROM d, k),
e AS (SELECT doc_id, word, CASE WHEN i > 0 THEN substr(pad, greatest(i - 40, 1), least(i + length(word) + 42, length(pad) + 1) - greatest(i - 40, 1)) END AS excerpt FROM a)
SELECT doc_id, word, excerpt IS NOT NULL AS held, CASE {_NOTES} ELSE '' END AS note FROM e""")
def q_context_note(spark, d):
    pubs = M.publications(table(spark, d, "documents")).select("doc_id", F.concat(F.lit(" "), "norm", F.lit(" ")).alias("pad"))
    rows = pubs.select("*", F.explode(F.lit(list(_PHRASES))).alias("word")).withColumn("excerpt", C.excerpt_round(F.col("pad"), F.col("word")))
    return rows.select("doc_id", "word", F.col("excerpt").isNotNull().alias("held"), C.context_note(F.col("word"), F.col("excerpt"), _PHRASES).alias("note"))


_LEVELS = ("CRITICAL", "STRONG", "MEDIUM_HIGH", "MEDIUM", "SECTOR", "REVIEW", "LOW", "NONE")


@query(f"""WITH {_FACETS}, t AS (SELECT doc_id, {_case(C.CONTEXT_RULES, 'level')} AS level, {_case(C.CONTEXT_RULES, 'relevant')} AS relevant
  FROM f) SELECT doc_id, level IN ('CRITICAL', 'STRONG', 'MEDIUM_HIGH', 'MEDIUM') AS executive, level = 'SECTOR' AS sector, level = 'REVIEW'
  AND level <> 'SECTOR' AS review FROM t""")
def q_view_predicates(spark, d):
    level = F.col("x.level")
    tree = _faceted(spark, d).select("doc_id", C.decide(C.CONTEXT_RULES).alias("x"))
    return tree.select("doc_id", level.isin(*_LEVELS[:4]).alias("executive"), (level == "SECTOR").alias("sector"), (level == "REVIEW").alias("review"))


@query(f"""WITH {_FACETS}, t AS (SELECT doc_id, {_case(C.CONTEXT_RULES, 'level')} AS level, matched FROM f),
b(place, level) AS (VALUES {values(enumerate(_LEVELS))})
SELECT b.place, b.level, count(t.doc_id) AS n_docs, round(coalesce(100.0::DOUBLE * count(t.doc_id) / nullif((SELECT count(*) FROM t), 0), 0), 2) AS share,
 coalesce(sum(len(matched)), 0)::BIGINT AS n_terms FROM b LEFT JOIN t ON t.level = b.level GROUP BY 1, 2""")
def q_report_complement(spark, d):
    tree = _faceted(spark, d).select("doc_id", "hits", C.decide(C.CONTEXT_RULES).alias("x"))
    counts = tree.groupBy("x.level").agg(n().alias("k"), F.sum(F.size("hits")).alias("terms"))
    counts = counts.withColumn("total", F.sum("k").over(W.partitionBy()))  # a row for each level
    rows = spark.createDataFrame(list(enumerate(_LEVELS)), "place int, level string").join(counts, "level", "left")
    share = F.round(F.coalesce(F.lit(100.0) * F.col("k") / F.col("total"), F.lit(0.0)), 2)
    return rows.select("place", "level", F.coalesce("k", F.lit(0)).cast("bigint").alias("n_docs"), share.alias("share"), F.coalesce("terms", F.lit(0)).cast("bigint").alias("n_terms"))
