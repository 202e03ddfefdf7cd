"""Queries of records, titles, links and digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import highlights as H
from pubmill.operators import records as R
from pubmill.operators.signature import tree_signature
from pubmill.plans.base import n, norm_sql, query, table, values

_LINE = "split_part(coalesce(text, ''), chr(10), 1)"
_KEY = lambda c: f"trim(regexp_replace({norm_sql(c)}, '[^a-z0-9]+', ' ', 'g'))"

_SPELT = "CASE o_orderkey % 6 WHEN 0 THEN o_orderkey || '.0' WHEN 1 THEN o_custkey || 'e2' WHEN 2 THEN 'No ' || o_orderkey || '/' || o_custkey WHEN 3 THEN ' ' || o_orderkey || ' ' WHEN 4 THEN o_orderkey || '.50' ELSE 'none' END"


def _spelt():
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    kinds = [F.concat(k, F.lit(".0")), F.concat(c, F.lit("e2")), F.concat(F.lit("No "), k, F.lit("/"), c), F.concat(F.lit(" "), k, F.lit(" ")), F.concat(k, F.lit(".50")), F.lit("none")]
    return F.element_at(F.array(*kinds), (F.col("o_orderkey") % 6 + 1).cast("int"))


@query(f"""WITH t AS (SELECT o_orderkey, {_SPELT} AS spelt
  FROM orders), v AS (SELECT *, CASE WHEN regexp_matches(spelt, '^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$') THEN trim(spelt)::DOUBLE END AS x FROM t)
SELECT o_orderkey, CASE WHEN x = floor(x) THEN x::BIGINT::VARCHAR ELSE regexp_replace(spelt, '[^0-9]', '', 'g') END AS digits FROM v""")
def q_number_digits(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.number_digits(_spelt()).alias("digits"))


@query(f"""SELECT page_id, trim(regexp_replace({norm_sql('url')}, '[^a-z0-9]+', ' ', 'g')) AS page_key, strip_accents(lower(trim(regexp_replace(html,
  '\\s+', ' ', 'g')))) AS plain,
 trim(regexp_replace(lower(regexp_replace(strip_accents(html), '[^\\x00-\\x7F]', '', 'g')), '[^a-z0-9/.-]+', ' ', 'g')) AS title FROM pages""")
def q_other_norms(spark, d):
    head = F.col("html")
    return table(spark, d, "pages").select("page_id", T.page_norm(F.col("url")).alias("page_key"), T.accent_norm(head).alias("plain"), T.title_norm(head).alias("title"))


@query(f"""SELECT doc_id, CASE WHEN length(l) > 30 THEN substr(l, 1, 30) || '...' ELSE l END AS after, CASE WHEN length(l) > 30 THEN substr(l, 1, 27) || '...' ELSE l END AS within,
 CASE WHEN length(l) > 30 THEN rtrim(substr(l, 1, 30)) || '...' ELSE l END AS trimmed FROM (SELECT doc_id, {_LINE} AS l FROM documents)""")
def q_shorten(spark, d):
    line = T.first_line(F.col("text"), None)
    return table(spark, d, "documents").select("doc_id", *(T.shorten(line, 30, rule).alias(rule) for rule in ("after", "within", "trimmed")))


@query("""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 2 THEN ' ' || strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m.%Y') END AS spelt FROM orders)
SELECT o_orderkey, coalesce(try_strptime(trim(spelt), '%Y-%m-%d')::DATE, try_strptime(trim(spelt), '%d/%m/%Y')::DATE) AS day FROM t""")
def q_date_parse(spark, d):
    form = lambda f: F.date_format("o_orderdate", f)
    kind = F.col("o_orderkey") % 4
    spelt = F.when(kind == 0, form("yyyy-MM-dd")).when(kind == 1, form("dd/MM/yyyy")).when(kind == 2, F.concat(F.lit(" "), form("dd/MM/yyyy"))).otherwise(form("MM.yyyy"))
    return table(spark, d, "orders").select("o_orderkey", T.parse_date(spelt).alias("day"))


@query("SELECT event_type, replace(printf('%.2f', round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM events), 2)), '.', ',') || '%' AS share FROM events GROUP BY 1")
def q_percent_text(spark, d):
    counts = table(spark, d, "events").groupBy("event_type").agg(n().alias("k"))
    total = counts.agg(F.sum("k").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("event_type", T.percent_text(F.round(F.lit(100.0) * F.col("k") / F.col("total"), 2)).alias("share"))


@query(f"""WITH t AS (SELECT doc_id, string_split({_LINE}, ' ') AS w FROM documents), k AS (SELECT doc_id, w, list_transform(w, lambda x: {_KEY('x')}) AS keys FROM t)
SELECT doc_id, array_to_string(list_transform(list_filter(range(len(w)), lambda i: keys[i + 1] <> ''
  AND list_position(keys, keys[i + 1]) = i + 1), lambda i: w[i + 1]), ' ') AS words FROM k""")
def q_ordered_distinct(spark, d):
    words = T.ordered_distinct(F.split(T.first_line(F.col("text"), None), " "))
    return table(spark, d, "documents").select("doc_id", F.array_join(words, " ").alias("words"))


_ACTS = ("licen", "than", "deau")


@query(f"""SELECT doc_id, CASE WHEN regexp_matches({_KEY('l')}, 'licen|than|deau') THEN 'ACT'
  WHEN len(regexp_extract_all(l, '\\b[A-Z][a-z]+')) >= 3 AND len(regexp_split_to_array(trim(l), '\\s+')) <= 6 THEN 'PERSON' ELSE 'OTHER' END AS kind
FROM (SELECT doc_id, {_LINE} AS l FROM documents)""")
def q_title_kind(spark, d):
    line = T.first_line(F.col("text"), None)
    return table(spark, d, "documents").select("doc_id", T.title_kind(line, _ACTS).alias("kind"))


_FLAT = "strip_accents(lower(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))))"


@query(f"""SELECT doc_id, regexp_matches(t, '(^|[^a-z0-9])public\\s+license($|[^a-z0-9])') AS licence, regexp_matches(t, '(^|[^a-z0-9])than($|[^a-z0-9])') AS than
  FROM (SELECT doc_id, {_FLAT} AS t FROM documents)""")
def q_flexible_term(spark, d):
    plain = T.accent_norm(F.col("text"))
    return table(spark, d, "documents").select("doc_id", T.flexible_term(plain, "public license").alias("licence"), T.flexible_term(plain, "than").alias("than"))


# Raw rows as three producers spell them: the title under one of two names or missing, some texts missing, one in five with an id.
_RAW = f"""r AS (SELECT doc_id AS ord, CASE WHEN doc_id % 5 = 0 THEN 'own-' || doc_id ELSE '' END AS id, CASE
  WHEN doc_id % 3 = 0 THEN substr({_LINE}, 1, 50) END AS title, CASE WHEN doc_id % 3 = 1 THEN substr({_LINE}, 1, 40) END AS heading,
 CASE WHEN doc_id % 11 <> 0 THEN text END AS body, CASE WHEN doc_id % 7 = 0 THEN '' ELSE source END AS agency, CASE
  WHEN doc_id % 4 = 0 THEN '2024-01-0' || (doc_id % 9 + 1) WHEN doc_id % 4 = 1 THEN 'May 2024' ELSE '0' || (doc_id % 9 + 1) || '/02/2024' END AS day,
 CASE WHEN doc_id % 2 = 0 THEN 'http://x.example/' || doc_id END AS link, lang FROM documents)"""
_F = lambda *c: "coalesce(" + ", ".join(f"nullif(trim({x}), '')" for x in c) + ", '')"
_BASE = f"""{_RAW}, a AS (SELECT ord, trim(id) AS own, {_F('title', 'heading')} AS t, {_F('body')} AS text, {_F('agency')} AS organ, {_F('day')} AS published,
  {_F('link')} AS url, lang FROM r),
b AS (SELECT ord, CASE WHEN own <> '' THEN own
  ELSE 'GAZETTE|' || substr(sha256('GAZETTE|' || published || '||' || url || '|' || substr(text, 1, 300)), 1, 20) END AS id, CASE
  WHEN t <> '' THEN t ELSE substr(trim({_LINE}), 1, 300) END AS title, text, organ, published, url,
 CASE WHEN text = '' THEN '' ELSE sha256(text) END AS hash, length(text)::BIGINT AS text_size, CASE WHEN text = '' THEN 'NO_TEXT' ELSE 'OK' END AS status, lang FROM a)"""


def _base(spark, d):
    k, line = F.col("doc_id"), T.first_line(F.col("text"), None)
    digit = (k % 9 + 1).cast("string")
    day = F.when(k % 4 == 0, F.concat(F.lit("2024-01-0"), digit)).when(k % 4 == 1, "May 2024").otherwise(F.concat(F.lit("0"), digit, F.lit("/02/2024")))
    raw = table(spark, d, "documents").select(
        k.alias("ord"),
        F.when(k % 5 == 0, F.concat(F.lit("own-"), k.cast("string"))).otherwise("").alias("id"),
        F.when(k % 3 == 0, F.substring(line, 1, 50)).alias("title"),
        F.when(k % 3 == 1, F.substring(line, 1, 40)).alias("heading"),
        F.when(k % 11 != 0, F.col("text")).alias("body"),
        F.when(k % 7 == 0, "").otherwise(F.col("source")).alias("agency"),
        day.alias("day"),
        F.when(k % 2 == 0, F.concat(F.lit("http://x.example/"), k.cast("string"))).alias("link"),
        "lang",
    )
    return R.base_record(raw, "ord")


@query(f"WITH {_BASE} SELECT ord, id, title, published, url, organ, hash, text_size, status, lang FROM b")
def q_base_record(spark, d):
    return _base(spark, d).select("ord", "id", "title", "published", "url", "organ", "hash", "text_size", "status", F.col("extra")["lang"].alias("lang"))


@query(f"""WITH {_BASE}, v AS (SELECT id, list_filter([{', '.join(f"CASE WHEN trim({c}) = '' THEN 'missing {c}' END" for c in ('id', 'published', 'title', 'organ', 'text'))},
  CASE WHEN published <> '' AND try_strptime(published, '%Y-%m-%d') IS NULL
  AND try_strptime(published, '%d/%m/%Y') IS NULL THEN 'not a date published' END], lambda x: x IS NOT NULL) AS e,
 list_filter([{', '.join(f"CASE WHEN {c} = '' THEN 'empty {c}' END" for c in ('url', 'hash'))}], lambda x: x IS NOT NULL) AS w FROM b)
SELECT id, array_to_string(e, ';') AS errors, array_to_string(w, ';') AS warnings, CASE WHEN len(e) > 0 THEN 'INVALID'
  WHEN len(w) > 0 THEN 'INCOMPLETE' ELSE 'OK' END AS verdict FROM v""")
def q_contract(spark, d):
    return R.validated(_base(spark, d)).select("id", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"), "verdict")


@query("""SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS priority, arg_max(o_orderstatus,
  o_orderkey) FILTER (o_orderkey % 2 = 0) AS status FROM orders GROUP BY 1""")
def q_last_filled(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    o = o.select("o_custkey", "o_orderkey", F.when(k % 3 != 0, F.col("o_orderpriority")).otherwise(" ").alias("priority"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("status"))
    return R.last_filled(o, ["o_custkey"], "o_orderkey", ["priority", "status"])


@query("""WITH u AS (SELECT 0 AS place, o_orderkey AS ord, o_custkey, o_orderdate::DATE AS day, 'closed' AS origin FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 1, o_orderkey, o_custkey, o_orderdate::DATE, 'any' FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, day ORDER BY place, ord) AS k FROM u) SELECT ord, o_custkey, day, origin FROM r WHERE k = 1""")
def q_union_by_key(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("ord"), "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    closed = o.where("o_orderstatus = 'F'").drop("o_orderstatus").withColumn("origin", F.lit("closed"))
    return R.union_by_key([closed, o.drop("o_orderstatus").withColumn("origin", F.lit("any"))], F.struct("o_custkey", "day"), "ord")


@query(f"""WITH f AS (SELECT doc_id, unnest(['title', 'full_text', 'organ']) AS field, unnest([0, 1, 2]) AS place, unnest([lower({_LINE}), lower(coalesce(text, '')), lower(coalesce(source, ''))]) AS x FROM documents),
h AS (SELECT doc_id, field, place, term, (length(x) - length(replace(x, term, ''))) // length(term) AS k, instr(x, term) - 1 AS pos FROM f, (VALUES ('the'), ('src1')) t(term)),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY field <> 'full_text', place, pos) AS r, sum(k) OVER (PARTITION BY doc_id) AS n_hits FROM h WHERE k > 0)
SELECT doc_id, n_hits::BIGINT AS n_hits, field, pos AS "offset" FROM p WHERE r = 1""")
def q_primary_occurrence(spark, d):
    docs = table(spark, d, "documents")
    fields = [("title", T.first_line(F.col("text"), None)), ("full_text", F.col("text")), ("organ", F.col("source"))]
    hits = None
    for place, (name, text) in enumerate(fields):
        spans = docs.select("doc_id", F.explode(H.all_occurrences(text, ["the", "src1"])).alias("s"))
        one = spans.select("doc_id", F.lit(name).alias("field"), F.lit(place).alias("place"), F.col("s.start").cast("long").alias("offset"))
        hits = one if hits is None else hits.unionByName(one)
    return R.primary_occurrence(hits, ["doc_id"])


@query("SELECT user_id, arg_max(event_type, struct_pack(ts := ts, event_id := event_id)) AS kind, max(ts)::DATE AS day FROM events GROUP BY 1")
def q_latest_artifact(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("kind"), F.to_date(F.max("ts")).alias("day"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' ORDER BY coalesce(l_linestatus, ''), l_shipdate, l_orderkey, l_linenumber")
def q_result_order(spark, d):
    rows = table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return rows.orderBy(F.coalesce("l_linestatus", F.lit("")), "l_shipdate", "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber")


@query(f"""SELECT doc_id, CASE WHEN length(trim(b)) > 40 AND {_KEY('b')} <> {_KEY('t')} THEN 'second'
  WHEN length(trim(c)) > 40 AND {_KEY('c')} <> {_KEY('t')} THEN 'text' ELSE '' END AS useful
FROM (SELECT doc_id, {_LINE} AS t, split_part(coalesce(text, ''), chr(10), 2) AS b, coalesce(text, '') AS c FROM documents)""")
def q_useful_text(spark, d):
    whole = F.coalesce("text", F.lit(""))
    second = F.coalesce(F.try_element_at(F.split(whole, "\n"), F.lit(2)), F.lit(""))
    rows = table(spark, d, "documents").select("doc_id", second.alias("b"), whole.alias("c"), R.useful_text(T.first_line(F.col("text"), None), second, whole).alias("u"))
    return rows.select("doc_id", F.when(F.col("u") == "", "").when(F.col("u") == F.trim("b"), "second").otherwise("text").alias("useful"))


@query(r"""WITH u AS (SELECT page_id, list_distinct(regexp_extract_all(url || ' ' || html, 'https?://[^\s"''<>)]+')) AS us, regexp_extract_all(url || ' ' || html,
  'https?://[^\s"''<>)]+') AS o FROM pages)
SELECT page_id, coalesce(list_filter(o, lambda x: regexp_extract(x, '://([^/:?#]+)', 1) = 'ththre.example.com')[1], o[1]) AS best FROM u""")
def q_ranked_url(spark, d):
    return table(spark, d, "pages").select("page_id", R.ranked_url(F.concat_ws(" ", "url", "html"), ["ththre.example.com"]).alias("best"))


@query("""SELECT page_id, len(regexp_extract_all(html, '(?i)<p[ >]'))::BIGINT AS paragraphs, regexp_matches(html, '(?i)<table') AS has_table, len(regexp_extract_all(html,
  '(?i)<a '))::BIGINT AS links FROM pages""")
def q_counts_in_text(spark, d):
    count = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    return table(spark, d, "pages").select("page_id", count("(?i)<p[ >]").alias("paragraphs"), F.col("html").rlike("(?i)<table").alias("has_table"), count("(?i)<a ").alias("links"))


_STOP = ("the", "and", "that")
_NEXT = f"""t AS (SELECT doc_id, {_LINE} AS title
  FROM documents), c AS (SELECT a.doc_id, a.title AS wanted, CASE WHEN a.doc_id % 3 = 0 THEN 'See: ' || a.title || ' 77'
  WHEN a.doc_id % 3 = 1 THEN substr(a.title, 1, 45) ELSE b.title END AS link,
 CASE WHEN a.doc_id % 4 = 0 THEN '/law-' || a.doc_id ELSE '/doc/' || a.doc_id END AS href FROM t a JOIN t b ON b.doc_id = a.doc_id + 1)"""
_TOKENS = f"list_filter(list_distinct(string_split({_KEY('wanted')}, ' ')), lambda t: length(t) >= 3 AND NOT regexp_full_match(t, '[0-9]+') AND t NOT IN ('the', 'and', 'that'))"
_PARTS = f"""{_NEXT}, k AS (SELECT *, {_KEY('wanted')} AS a, {_KEY('link')} AS b, {_KEY("link || ' ' || href")} AS ab, {_TOKENS} AS toks,
  list_distinct(regexp_extract_all({_KEY('wanted')}, '[0-9]+')) AS nums FROM c),
s AS (SELECT *, a <> '' AND b <> '' AND (contains(b, a) OR (len(toks) > 0 AND len(list_filter(nums, lambda x: NOT contains(b, x))) = 0
  AND len(list_filter(toks, lambda x: contains(b, x)))::DOUBLE / len(toks) >= 0.85)) AS same FROM k),
p AS (SELECT *, ((CASE WHEN same THEN 300 ELSE 0 END) + (CASE WHEN len(toks) > 0 THEN floor(len(list_filter(toks, lambda x: contains(ab, x)))::DOUBLE / len(toks) * 120) ELSE 0 END)
 + (CASE WHEN len(nums) > 0 THEN floor(len(list_filter(nums, lambda x: contains(ab, x)))::DOUBLE / len(nums) * 160) ELSE 0 END) - (CASE
  WHEN contains(lower(href), '/law-') AND NOT contains(a, 'law') THEN 100 ELSE 0 END))::BIGINT AS score FROM s)"""


def _links(spark, d):
    titles = table(spark, d, "documents").select("doc_id", T.first_line(F.col("text"), None).alias("title"))
    after = titles.select((F.col("doc_id") - 1).alias("doc_id"), F.col("title").alias("next"))
    k = F.col("doc_id")
    link = F.when(k % 3 == 0, F.concat(F.lit("See: "), "title", F.lit(" 77"))).when(k % 3 == 1, F.substring("title", 1, 45)).otherwise(F.col("next"))
    href = F.concat(F.when(k % 4 == 0, "/law-").otherwise("/doc/"), k.cast("string"))
    return titles.join(after, "doc_id").select("doc_id", F.col("title").alias("wanted"), link.alias("link"), href.alias("href"))


@query(f"WITH {_PARTS} SELECT doc_id, same FROM s")
def q_title_equivalence(spark, d):
    return _links(spark, d).select("doc_id", R.same_title(F.col("wanted"), F.col("link"), _STOP).alias("same"))


@query(f"WITH {_PARTS} SELECT doc_id, score FROM p")
def q_link_score(spark, d):
    return _links(spark, d).select("doc_id", R.link_score(F.col("wanted"), F.col("link"), F.col("href"), _STOP).alias("score"))


@query(f"""WITH {_PARTS}, w AS (SELECT DISTINCT doc_id % 300 AS key FROM p), h AS (SELECT doc_id AS key, href AS url
  FROM p WHERE doc_id % 10 = 1 AND doc_id < 300 AND doc_id % 20 <> 11),
b AS (SELECT doc_id % 300 AS key, arg_min(href, struct_pack(a := -score, b := href)) AS url FROM p WHERE same GROUP BY 1)
SELECT w.key, coalesce(h.url, b.url) AS url, CASE WHEN h.url IS NOT NULL THEN 'CACHE' WHEN b.url IS NOT NULL THEN 'FOUND' ELSE 'MISSING' END AS how FROM w
  LEFT JOIN h ON h.key = w.key LEFT JOIN b ON b.key = w.key""")
def q_link_resolution(spark, d):
    links, key = _links(spark, d), (F.col("doc_id") % 300).alias("key")
    score, same = R.link_score(F.col("wanted"), F.col("link"), F.col("href"), _STOP), R.same_title(F.col("wanted"), F.col("link"), _STOP)
    candidates = links.select(key, F.col("href").alias("url"), score.alias("score"), same.alias("valid"))
    cache = links.where("doc_id % 10 = 1 and doc_id < 300").select(F.col("doc_id").alias("key"), F.col("href").alias("url"), (F.col("doc_id") % 20 != 11).alias("found"))
    return R.resolve(candidates.select("key").distinct(), cache, candidates)


@query(None)
def fuzzy_title(spark, d):
    """The document whose first line is most like each benchmark item."""
    records = table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.first_line(F.col("text"), None).alias("title"))
    return R.fuzzy_titles(records, table(spark, d, "benchmark").select(F.col("item_id").alias("key"), F.col("text").alias("title")))


@query("""WITH r AS (SELECT o_orderkey AS key, o_custkey AS title, o_orderpriority AS process, o_clerk FROM (SELECT *, 'doc-' || o_orderkey AS o_clerk
  FROM orders WHERE o_orderkey % 3 = 0)),
l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS key, o_custkey AS title, o_orderpriority AS process FROM orders),
a AS (SELECT key, min(o_clerk) AS v FROM r GROUP BY 1 HAVING count(*) = 1), b AS (SELECT title, min(o_clerk) AS v
  FROM r GROUP BY 1 HAVING count(*) = 1), c AS (SELECT title, process, min(o_clerk) AS v FROM r GROUP BY 1, 2 HAVING count(*) = 1)
SELECT l.id, coalesce(a.v, b.v, c.v) AS page, CASE WHEN a.v IS NOT NULL THEN 'key' WHEN b.v IS NOT NULL THEN 'title' WHEN c.v IS NOT NULL THEN 'title+process' END AS how
FROM l LEFT JOIN a ON a.key = l.key LEFT JOIN b ON b.title = l.title LEFT JOIN c ON c.title = l.title AND c.process = l.process""")
def q_guarded_association(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("title"), F.col("o_orderpriority").alias("process"))
    right = o.where("id % 3 = 0").select(F.col("id").alias("key"), "title", "process", F.concat(F.lit("doc-"), F.col("id").cast("string")).alias("page"))
    left = o.select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("key"), "title", "process")
    return R.guarded(left, right, [["key"], ["title"], ["title", "process"]], "page").select("id", "page", "how")


_PROC = "lpad((o_orderkey % 100000)::VARCHAR, 5, '0') AS a, lpad((o_custkey % 1000000)::VARCHAR, 6, '0') AS b, strftime(o_orderdate, '%Y') AS c, lpad((o_orderkey % 97)::VARCHAR, 2, '0') AS e"


@query(f"""WITH t AS (SELECT *, {_PROC} FROM orders), k AS (SELECT DISTINCT a || b || c || e AS process FROM t WHERE o_orderpriority LIKE '1%')
SELECT o_orderkey AS doc, 1 AS page, a || b || c || e AS process, CASE WHEN o_orderkey % 4 = 1 THEN 'WIDE_REVIEW' ELSE 'STRICT' END AS how FROM t
  JOIN k ON k.process = a || b || c || e WHERE o_orderkey % 4 <> 3""")
def q_pattern_join(spark, d):
    pad = lambda c, width: F.lpad(c.cast("string"), width, "0")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", pad(F.col("o_orderkey") % 100000, 5).alias("a"), pad(F.col("o_custkey") % 1000000, 6).alias("b"), F.date_format("o_orderdate", "yyyy").alias("c"), pad(F.col("o_orderkey") % 97, 2).alias("e"))
    kind = F.col("o_orderkey") % 4
    far = F.concat_ws(" of the page, then ", "a", "b", "c", "e")
    text = F.when(kind == 0, F.concat("a", F.lit(" . "), "b", F.lit("/"), "c", F.lit("-"), "e")).when(kind == 1, far).when(kind == 2, F.concat(F.concat("a", "b", "c", "e"), F.lit(" and "), far)).otherwise(F.concat_ws(" - " * 20, "a", "b", "c", "e"))
    portfolio = o.where("o_orderpriority like '1%'").select(F.concat("a", "b", "c", "e").alias("process")).distinct()
    return R.pattern_join(o.select(F.col("o_orderkey").alias("doc"), F.lit(1).alias("page"), F.concat(F.lit("p. "), text, F.lit(" .")).alias("text")), portfolio)


@query("""WITH g AS (SELECT o_custkey AS id, list_sort(list_distinct(list(o_orderpriority) FILTER (o_orderstatus = 'F'))) AS ps FROM orders GROUP BY 1)
SELECT id, 'customer ' || id AS title, unnest(CASE WHEN coalesce(len(ps), 0) > 0 THEN ps ELSE [NULL] END) AS process FROM g""")
def q_digest_rows(spark, d):
    g = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("processes"))
    return R.digest_rows(g.select("id", F.concat(F.lit("customer "), F.col("id").cast("string")).alias("title"), "processes"))


# Roots of listed sources, the first that holds an address decides.
_ROOTS = (
    (1, "https://thther.example.org/en/685", "one page"), (2, "https://thther.example.org/en/", "english"), (3, "https://thther.example.org", "whole host"),
    (4, "http://blog.ththan.example.net/en", "blog"), (5, "https://m.ththth.example.net/en/25", "one page"), (6, "https://blog.tionsh.example.net", "blog"),
)
_PLAIN_URL = lambda c: f"CASE WHEN lower(rtrim(split_part({c}, '#', 1), '/')) LIKE '%.pdf/view' THEN left(rtrim(split_part({c}, '#', 1), '/'), -5) ELSE rtrim(split_part({c}, '#', 1), '/') END"


@query(f"""WITH k(ord, root, source) AS (VALUES {values(_ROOTS)}), r AS (SELECT ord, {_PLAIN_URL('root')} AS root, source FROM k), p AS (SELECT page_id, CASE
  WHEN page_id % 5 = 0 THEN regexp_extract(url, '^[^?#]*') || '/a.PDF/view' ELSE url END AS url FROM pages), u AS (SELECT page_id, {_PLAIN_URL('url')} AS url FROM p),
j AS (SELECT page_id, arg_min(source, ord) AS source FROM u JOIN r ON url = root OR starts_with(url, root || '/') GROUP BY 1)
SELECT page_id, u.url AS plain, source, (contains(u.url, 'blog') OR contains(u.url, 'spam')) AND NOT contains(u.url, 'tionsh') AS listed FROM u LEFT JOIN j USING (page_id)""")
def q_source_predicates(spark, d):
    url = F.when(F.col("page_id") % 5 == 0, F.concat(F.regexp_extract("url", "^[^?#]*", 0), F.lit("/a.PDF/view"))).otherwise(F.col("url"))
    rows = R.url_sources(table(spark, d, "pages").select("page_id", url.alias("url")), spark.createDataFrame(_ROOTS, "ord int, root string, source string"))
    return rows.select("page_id", R.plain_url(F.col("url")).alias("plain"), "source", R.of_source(F.col("url"), ["blog", "spam"], ["tionsh"]).alias("listed"))


@query("""WITH d AS (SELECT p_brand, sha256(p_partkey || '|' || p_name) AS d, count(*) AS n FROM part GROUP BY 1, 2),
l AS (SELECT p_brand, d[1:1] AS spot, sha256(string_agg(d || ':' || n, ',' ORDER BY d || ':' || n)) AS d FROM d GROUP BY 1, 2), f AS (SELECT p_brand, sha256(string_agg(spot || d, '' ORDER BY spot)) AS s FROM l GROUP BY 1),
e AS (SELECT sha256(p_brand || '=' || s) || ':1' AS d FROM f), r AS (SELECT d[1:1] AS spot, sha256(string_agg(d, ',' ORDER BY d)) AS d FROM e GROUP BY 1)
SELECT sha256(string_agg(spot || d, '' ORDER BY spot)) AS signature FROM r""")
def q_config_signature(spark, d):
    files = tree_signature(table(spark, d, "part"), F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name"), "p_brand")
    return tree_signature(files, F.concat_ws("=", "p_brand", "signature"))


@query("""WITH t AS (SELECT user_id, event_type, event_id, value FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM t)
SELECT user_id, count(*) AS kept, sum(value)::DOUBLE AS total, string_agg(event_type, ',' ORDER BY event_type) AS kinds
  FROM (SELECT user_id, event_type, round(value, 2) AS value FROM r WHERE k = 1) GROUP BY 1""")
def q_relevant_rollup(spark, d):
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.round(F.min_by("value", "event_id"), 2).alias("value"))
    return first.groupBy("user_id").agg(n().alias("kept"), F.sum("value").alias("total"), F.array_join(F.sort_array(F.collect_list("event_type")), ",").alias("kinds"))


@query("""WITH p AS (SELECT ts::DATE AS day, user_id % 3 AS purpose, count(*) AS pending FROM events WHERE event_type = 'error' GROUP BY 1, 2)
SELECT day, string_agg(purpose::VARCHAR, ',' ORDER BY purpose) AS purposes, sum(pending)::BIGINT AS pending FROM p GROUP BY day""")
def q_pending_by_date(spark, d):
    p = table(spark, d, "events").where("event_type = 'error'").groupBy(F.to_date("ts").alias("day"), (F.col("user_id") % 3).alias("purpose")).agg(n().alias("pending"))
    return p.groupBy("day").agg(F.array_join(F.transform(F.sort_array(F.collect_list("purpose")), lambda x: x.cast("string")), ",").alias("purposes"), F.sum("pending").alias("pending"))
