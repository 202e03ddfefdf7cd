"""The engine's queries on the driver tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import highlights as H
from pubmill.operators import matching as M
from pubmill.operators import monitoring as O
from pubmill.operators import postings as P
from pubmill.operators import records as R
from pubmill.plans.base import ORACLE_SQL, QUERIES, n, query, table  # noqa: F401
from pubmill.plans.base import norm_sql as _norm
from pubmill.plans.base import values as _in
from pubmill.sources.archive import strip_html

_LINE = "split_part(coalesce(text, ''), chr(10), 1)"
_PUBS = f"p AS (SELECT doc_id, lang AS section, source AS organ, {_LINE} AS title, text, {_norm('text')} AS norm, {_norm(_LINE)} AS norm_title FROM documents)"
_TERMS = f"w(ord, term, category) AS (VALUES {_in([(i + 1, t, c) for i, (t, c) in enumerate(M.WATCHLIST)])})"
_MATCH = f"{_PUBS}, {_TERMS}, m AS (SELECT doc_id, ord, term, category FROM p JOIN w ON contains(' ' || norm || ' ', ' ' || term || ' '))"
_OR = lambda c, terms: "(" + " OR ".join(f"contains(' ' || {c} || ' ', ' {t} ')" for t in terms) + ")"
_SCORED = f"""{_MATCH}, x AS (SELECT *, CASE WHEN NOT {_OR('norm_title', M.EXCLUDED)} THEN 'OPEN'
  WHEN {_OR('norm', M.RESCUED)} THEN 'RESCUED' ELSE 'EXCLUDED' END AS status FROM p),
g AS (SELECT doc_id, count(*) AS n_terms, max((category='licence')::INT) AS li, max((category='version')::INT) AS ve, max((category='contact')::INT) AS co,
  max((category IN ('negation','preposition'))::INT) AS np FROM m GROUP BY doc_id),
y AS (SELECT x.doc_id, section, organ, title, status, coalesce(n_terms, 0)::BIGINT AS n_terms,
 CASE WHEN status = 'EXCLUDED' OR g.doc_id IS NULL THEN 0 WHEN li=1 AND ve=1 THEN 12 WHEN li=1 AND co=1 THEN 11 WHEN li=1 THEN 9 WHEN co=1 THEN 6
  WHEN np=1 THEN 3 ELSE 1 END::BIGINT AS rank FROM x LEFT JOIN g USING (doc_id)),
s AS (SELECT *, CASE WHEN rank=12 THEN 'CRITICAL' WHEN rank>=9 THEN 'STRONG' WHEN rank=6 THEN 'MEDIUM' WHEN rank>=1 THEN 'LOW' ELSE 'NONE' END AS level FROM y)"""


def _pubs(spark, d, most=None):
    return M.publications(table(spark, d, "documents"), most)


def _match(spark, d):
    return M.match(_pubs(spark, d), M.watchlist(spark))


def _scored(spark, d, most=None):
    return M.scored(table(spark, d, "documents"), most)


@query(f"WITH {_MATCH} SELECT term, count(*) AS n_docs FROM m GROUP BY term")
def q_norm_terms(spark, d):
    return _match(spark, d).groupBy("term").agg(n().alias("n_docs"))


@query(f"WITH {_MATCH} SELECT doc_id, ord, term, category FROM m")
def q_match_direct(spark, d):
    return _match(spark, d)


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_brand,'[A-Za-z]') AND regexp_matches(p_brand,'[0-9]') THEN 'hybrid'
  WHEN regexp_matches(p_brand,'[0-9]') THEN 'number' ELSE 'text' END AS brand_type, CASE
  WHEN regexp_matches(p_name,'[A-Za-z]') AND regexp_matches(p_name,'[0-9]') THEN 'hybrid' WHEN regexp_matches(p_name,'[0-9]') THEN 'number' ELSE 'text' END AS name_type
  FROM part""")
def q_term_type(spark, d):
    return table(spark, d, "part").select("p_partkey", T.term_type(F.col("p_brand")).alias("brand_type"), T.term_type(F.col("p_name")).alias("name_type"))


# Twelve ordered vocabularies, the first of which that lists a term gives its category.
VOCABULARIES = (
    ("size", ("small", "large", "medium")), ("offer", ("promo", "economy", "small")), ("colour", ("red", "blue")), ("age", ("old", "new", "Promo")),
    ("heat", ("hot", "cold", "red")), ("fastener", ("bolt", "rod")), ("wheel", ("gear", "ring", "widget")), ("tool", ("anvil", "plate")),
    ("gadget", ("gizmo", "widget")), ("phrase", ("red plate", "hot rod", "OLD  ring")), ("hot work", ("hot rod", "hot plate")), ("grade", ("Stándard",)),
)
_VOCABULARY = [(w, c, i) for i, (c, ws) in enumerate(VOCABULARIES) for w in ws]


@query(f"""WITH v(word, category, prio) AS (VALUES {_in(_VOCABULARY)}), k AS (SELECT {_norm('word')} AS word, arg_min(category, prio) AS category FROM v GROUP BY 1),
t AS (SELECT p_partkey, unnest(['type', 'name', 'first', 'second']) AS field, unnest([p_type, p_name, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS term FROM part)
SELECT p_partkey, field, coalesce(category, 'product') AS category FROM t LEFT JOIN k ON {_norm('term')} = word""")
def q_term_category(spark, d):
    words = F.split("p_name", " ")
    one = lambda field, term: F.struct(F.lit(field).alias("field"), term.alias("term"))
    fields = F.array(one("type", F.col("p_type")), one("name", F.col("p_name")), one("first", words[0]), one("second", F.coalesce(F.get(words, F.lit(1)), F.lit(""))))
    terms = table(spark, d, "part").select("p_partkey", F.inline(fields))
    return R.term_categories(terms, spark.createDataFrame(_VOCABULARY, "word string, category string, prio int")).select("p_partkey", "field", "category")


@query("SELECT arg_min(doc_id, doc_id) AS doc_id, substr(sha256(coalesce(text,'')),1,20) AS hash, count(*) AS copies FROM documents GROUP BY 2")
def q_base_dedup(spark, d):
    rows = table(spark, d, "documents").select("doc_id", T.short_hash(F.col("text")).alias("hash"))
    return rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), n().alias("copies"))


@query("""SELECT doc_id, regexp_replace(coalesce(text,''),'[^0-9]','','g') AS digits, contains(regexp_replace(coalesce(text,''),'[^0-9]','','g'), '200') AS has_number
  FROM documents""")
def q_match_number(spark, d):
    digits = T.digits(F.col("text"))
    return table(spark, d, "documents").select("doc_id", digits.alias("digits"), F.contains(digits, F.lit("200")).alias("has_number"))


@query(f"""WITH {_PUBS}, t AS (SELECT doc_id, unnest(string_split(norm,' ')) AS tok, generate_subscripts(string_split(norm,' '),1) AS i FROM p) SELECT DISTINCT a.doc_id
  FROM t a JOIN t b ON a.doc_id=b.doc_id AND a.tok='the' AND b.tok='from' AND abs(a.i-b.i)<=12""")
def q_match_proximity(spark, d):
    return _pubs(spark, d).where(M.near(F.col("norm"), "the", "from")).select("doc_id")


# Pairs of words that should stand near each other.
PAIRS = tuple((i + 1, a, b) for i, (a, b) in enumerate((
    ("the", "from"), ("that", "with"), ("than", "the"), ("and", "that"), ("der", "die"), ("und", "das"), ("les", "des"), ("que", "los"), ("para", "por"), ("con", "las"),
    ("the", "the"), ("license", "version"), ("licensed", "under"), ("public", "license"), ("mit", "license"), ("auf", "der"), ("einer", "zu"), ("pour", "les"), ("no", "such"), ("of", "in"),
)))


@query(f"""WITH {_PUBS}, k(ord, a, b) AS (VALUES {_in(PAIRS)}), t AS (SELECT doc_id, unnest(string_split(norm, ' ')) AS tok, generate_subscripts(string_split(norm, ' '), 1) AS i FROM p),
w AS (SELECT * FROM t WHERE tok IN (SELECT a FROM k UNION SELECT b FROM k))
SELECT DISTINCT x.doc_id, ord FROM k JOIN w x ON x.tok = a JOIN w y ON y.doc_id = x.doc_id AND y.tok = b AND abs(x.i - y.i) <= 12""")
def q_match_near(spark, d):
    pairs = spark.createDataFrame(PAIRS, "ord int, a string, b string")
    return P.near_matches(_pubs(spark, d), pairs.select("ord", F.array("a", "b").alias("tokens")))


# A list as long as the tables: the first two words of every document, and a term that no text holds beside each.
_LONG = f"""{_PUBS}, u AS (SELECT DISTINCT split_part(norm, ' ', 1) || ' ' || split_part(norm, ' ', 2) AS term FROM p WHERE contains(norm, ' ')),
b AS (SELECT DISTINCT doc_id, list_reduce([x, y], lambda s, w: s || ' ' || w) AS term FROM (SELECT doc_id, unnest(t[:-2]) AS x, unnest(t[2:]) AS y FROM (SELECT doc_id, string_split(norm, ' ') AS t FROM p) WHERE len(t) > 1)),
m AS (SELECT doc_id, term FROM b JOIN u USING (term))"""


def _long_matches(spark, d):
    pubs = _pubs(spark, d)
    words = F.split("norm", " ")
    own = pubs.where(F.contains("norm", F.lit(" "))).select(F.concat_ws(" ", words[0], words[1]).alias("term")).distinct()
    kind = F.element_at(F.lit(["even", "third", "other"]), (F.length("term") % 3 + 1).cast("int")).alias("category")
    none = own.select(F.concat(F.lit("nowhere "), "term").alias("term"))
    return P.term_matches(pubs, own.unionByName(none).select(F.xxhash64("term").alias("ord"), "term", kind))


@query(f"WITH {_LONG} SELECT doc_id, term FROM m")
def q_match_long(spark, d):
    return _long_matches(spark, d).select("doc_id", "term")


@query(f"""WITH {_LONG}, f AS (SELECT doc_id, bit_or(CASE length(term) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END)::BIGINT AS facets FROM m GROUP BY 1)
SELECT doc_id, coalesce(facets, 0)::BIGINT AS facets, coalesce(facets & 3 = 3, false) AS both, coalesce(facets & 4 = 0, true) AS no_other FROM p LEFT JOIN f USING (doc_id)""")
def q_facet_bitmaps(spark, d):
    names = ("even", "third", "other")
    held = table(spark, d, "documents").select("doc_id").join(P.facet_bitmaps(_long_matches(spark, d), names), "doc_id", "left")
    bits = F.col("facets")
    return held.select("doc_id", F.coalesce(bits, F.lit(0).cast("long")).alias("facets"), P.in_facets(bits, names, ("even", "third")).alias("both"), P.in_facets(bits, names, (), ("other",)).alias("no_other"))


# Two pieces of each benchmark item's words, to be found also inside words.
@query(f"""WITH {_PUBS}, w AS (SELECT item_id, string_split({_norm('text')}, ' ') AS t FROM benchmark),
k AS (SELECT item_id AS ord, substr(t[1], 1, 5) || ' ' || substr(t[3], 2, 4) AS term FROM w UNION ALL SELECT item_id + 1000000, substr(t[2], 1, 4) || ' ' || substr(t[5], 1, 6) FROM w)
SELECT doc_id, ord, 'hybrid' AS how FROM p JOIN k ON len(list_filter(string_split(term, ' '), lambda x: NOT contains(norm, x))) = 0""")
def q_match_hybrid_long(spark, d):
    t = F.split(T.normalise(F.col("text")), " ")
    part = lambda i, at, n: F.substring(F.coalesce(F.get(t, F.lit(i)), F.lit("")), at, n)
    both = F.array(F.struct(F.col("item_id").alias("ord"), F.concat(part(0, 1, 5), F.lit(" "), part(2, 2, 4)).alias("term")), F.struct((F.col("item_id") + 1_000_000).alias("ord"), F.concat(part(1, 1, 4), F.lit(" "), part(4, 1, 6)).alias("term")))
    terms = table(spark, d, "benchmark").select(F.inline(both)).select(F.col("ord").cast("int").alias("ord"), "term", F.lit("hybrid").alias("kind"), F.lit("").alias("origin"))
    return P.hybrid_matches(_pubs(spark, d), terms).select("doc_id", F.col("ord").cast("long").alias("ord"), "how")


@query(f"WITH {_SCORED} SELECT status, count(*) AS n_docs FROM s GROUP BY status")
def q_exclusion_rescue(spark, d, most=None):
    return M.exclusion(_pubs(spark, d, most)).groupBy("status").agg(n().alias("n_docs"))


@query(f"WITH {_SCORED} SELECT doc_id, status, n_terms, level, rank FROM s")
def q_context_score(spark, d, most=None):
    return _scored(spark, d, most).select("doc_id", "status", "n_terms", "level", "rank")


@query(f"""WITH {_SCORED} SELECT count(*) AS n_docs, count_if(n_terms>0) AS n_matched, sum(n_terms)::BIGINT AS n_terms, count_if(rank>=9) AS n_relevant,
  round(count_if(n_terms>0)*100.0::DOUBLE/count(*),2) AS match_rate FROM s""")
def q_audit_summary(spark, d, most=None):
    rate = F.round(F.count_if(F.col("n_terms") > 0) * F.lit(100.0) / F.count("*"), 2)
    return _scored(spark, d, most).agg(n().alias("n_docs"), F.count_if(F.col("n_terms") > 0).alias("n_matched"), F.sum("n_terms").alias("n_terms"), F.count_if(F.col("rank") >= 9).alias("n_relevant"), rate.alias("match_rate"))


@query(f"WITH {_MATCH}, c AS (SELECT term, count(*) AS n_docs, min(doc_id) AS first_doc FROM m GROUP BY term) SELECT * FROM c ORDER BY n_docs DESC, first_doc, term LIMIT 50")
def q_top_terms(spark, d):
    return _match(spark, d).groupBy("term").agg(n().alias("n_docs"), F.min("doc_id").alias("first_doc")).orderBy(F.desc("n_docs"), "first_doc", "term").limit(50)


@query(f"""WITH {_SCORED} SELECT s.doc_id, CASE WHEN toxic=1 THEN 'SUSPECT' WHEN quality=1 AND rank>=9 THEN 'HIGH'
  WHEN quality IS NULL THEN 'UNREVIEWED' ELSE 'LOW' END AS confidence FROM s LEFT JOIN labels l ON s.doc_id=l.doc_id WHERE n_terms>0""")
def q_confidence(spark, d, most=None):
    labels = table(spark, d, "labels")
    c = F.when(F.col("toxic") == 1, "SUSPECT").when((F.col("quality") == 1) & (F.col("rank") >= 9), "HIGH").when(F.col("quality").isNull(), "UNREVIEWED").otherwise("LOW")
    return _scored(spark, d, most).where("n_terms > 0").join(labels, "doc_id", "left").select("doc_id", c.alias("confidence"))


@query(f"WITH {_MATCH} SELECT m.doc_id, m.term FROM m JOIN labels l ON m.doc_id=l.doc_id WHERE l.quality=0 OR l.toxic=1")
def q_fp_list(spark, d):
    suspect = table(spark, d, "labels").where("quality = 0 or toxic = 1").select("doc_id")
    return _match(spark, d).join(suspect, "doc_id").select("doc_id", "term")


@query(f"""WITH {_SCORED}, b(place, level) AS (VALUES {_in(list(enumerate((*M.LEVELS, 'RESERVED'))))}) SELECT b.place, b.level, count(s.doc_id) AS n_docs FROM b
  LEFT JOIN s ON s.level=b.level GROUP BY 1, 2""")
def q_bucketed(spark, d, most=None):
    dim = spark.createDataFrame(list(enumerate((*M.LEVELS, "RESERVED"))), "place int, level string")
    counts = _scored(spark, d, most).groupBy("level").agg(n().alias("n_docs"))
    return F.broadcast(dim).join(counts, "level", "left").select("place", "level", F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"))


_PROC = "lpad((o_orderkey % 100000)::VARCHAR,5,'0') AS a, lpad((o_custkey % 1000000)::VARCHAR,6,'0') AS b, strftime(o_orderdate,'%Y') AS c, lpad((o_orderkey % 97)::VARCHAR,2,'0') AS e"
_FOUND = f"""t AS (SELECT o_orderkey, o_orderpriority, a||b||c||e AS process, 'Proc. ' || CASE o_orderkey % 4 WHEN 0 THEN a||'.'||b||'/'||c||'-'||e
  WHEN 1 THEN a||' '||b||' '||c||' '||e ELSE a||b||c||e END || CASE o_orderkey % 4 WHEN 3 THEN '7' ELSE ' ' END AS text FROM (SELECT *, {_PROC} FROM orders)),
k AS (SELECT DISTINCT process FROM t WHERE o_orderpriority LIKE '1%'), h AS (SELECT t.process, o_orderkey AS pub_id, 1::BIGINT AS n_hits FROM t
  JOIN k ON t.process=k.process WHERE o_orderkey % 4 <> 3)"""


def _processes(spark, d):
    """Orders as publications whose text holds a process number, in four spellings, one of them glued to a further digit."""
    pad = lambda c, width: F.lpad(c.cast("string"), width, "0")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", pad(F.col("o_orderkey") % 100000, 5).alias("a"), pad(F.col("o_custkey") % 1000000, 6).alias("b"), F.date_format("o_orderdate", "yyyy").alias("c"), pad(F.col("o_orderkey") % 97, 2).alias("e"))
    kind = F.col("o_orderkey") % 4
    spelt = F.when(kind == 0, F.concat("a", F.lit("."), "b", F.lit("/"), "c", F.lit("-"), "e")).when(kind == 1, F.concat_ws(" ", "a", "b", "c", "e")).otherwise(F.concat("a", "b", "c", "e"))
    o = o.withColumn("process", F.concat("a", "b", "c", "e")).withColumn("text", F.concat(F.lit("Proc. "), spelt, F.when(kind == 3, "7").otherwise(" ")))
    portfolio = o.where(F.col("o_orderpriority").startswith("1")).select("process").distinct()
    return o.select(F.col("o_orderkey").alias("pub_id"), "text"), portfolio


@query(f"WITH {_FOUND} SELECT * FROM h")
def q_process_hits(spark, d):
    return O.process_hits(*_processes(spark, d))


@query(f"""WITH {_FOUND} SELECT k.process, count(h.pub_id) AS n_pubs, coalesce(sum(n_hits),0)::BIGINT AS n_hits, CASE
  WHEN count(h.pub_id)>0 THEN 'FOUND' ELSE 'NOT_FOUND' END AS status FROM k LEFT JOIN h USING (process) GROUP BY k.process""")
def q_process_summary(spark, d):
    pubs, portfolio = _processes(spark, d)
    return O.process_summary(portfolio, O.process_hits(pubs, portfolio))


@query("""SELECT conv_id, turn, CASE WHEN role='user' THEN substr(text,1,40) ELSE last_value(CASE
  WHEN role='user' THEN substr(text,1,40) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent
  FROM conversations""")
def q_parent_inherit(spark, d):
    c = table(spark, d, "conversations").withColumn("title", F.substring("text", 1, 40))
    return O.inherit(c, "conv_id", "turn", F.col("role") == "user", "title").select("conv_id", "turn", "parent")


@query("""WITH a AS (SELECT conv_id, arg_min(substr(text,1,60), turn) AS head, count(*) AS parts, string_agg(DISTINCT role, ',' ORDER BY role) AS roles
  FROM conversations GROUP BY conv_id) SELECT * FROM a""")
def q_merge_groups(spark, d):
    c = table(spark, d, "conversations")
    return c.groupBy("conv_id").agg(F.min_by(F.substring("text", 1, 60), "turn").alias("head"), n().alias("parts"), F.array_join(F.sort_array(F.collect_set("role")), ",").alias("roles"))


@query("""SELECT o_orderkey, coalesce(c.c_name, s.s_name, 'unknown') AS name, CASE WHEN c.c_custkey IS NOT NULL THEN 1
  WHEN s.s_suppkey IS NOT NULL THEN 2 ELSE 3 END AS probe FROM orders LEFT JOIN customer c ON c.c_custkey=o_custkey AND c.c_acctbal>0
  LEFT JOIN supplier s ON s.s_suppkey=o_custkey""")
def q_multikey_enrich(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("by_id"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("by_url"))
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k")).join(c, "k", "left").join(s, "k", "left")
    probe = F.when(F.col("by_id").isNotNull(), 1).when(F.col("by_url").isNotNull(), 2).otherwise(3)
    return o.select("o_orderkey", F.coalesce("by_id", "by_url", F.lit("unknown")).alias("name"), probe.alias("probe"))


@query("""WITH s AS (SELECT o_custkey, o_orderkey, (CASE WHEN o_orderstatus='F' THEN 100 ELSE 40 END + CASE
  WHEN o_orderpriority LIKE '1%' THEN 60 ELSE 20 END)::BIGINT AS score FROM orders), b AS (SELECT *, max(score) OVER (PARTITION BY o_custkey) AS best
  FROM s) SELECT o_custkey, count(*) AS kept, min(o_orderkey) AS first_order, max(score) AS best FROM b WHERE score>=best-20 GROUP BY 1""")
def q_best_candidate(spark, d):
    score = F.when(F.col("o_orderstatus") == "F", 100).otherwise(40) + F.when(F.col("o_orderpriority").startswith("1"), 60).otherwise(20)
    s = table(spark, d, "orders").select("o_custkey", "o_orderkey", score.cast("bigint").alias("score"))
    best = s.groupBy("o_custkey").agg(F.max("score").alias("best"))  # pre-aggregates before the shuffle, unlike a window
    return s.join(best, "o_custkey").where("score >= best - 20").groupBy("o_custkey").agg(n().alias("kept"), F.min("o_orderkey").alias("first_order"), F.max("score").alias("best"))


@query(f"WITH {_SCORED} SELECT section, level, status, count(*) AS n_docs FROM s GROUP BY GROUPING SETS ((section),(level),(status),())")
def q_view_groupingsets(spark, d, most=None):
    by = [F.col(c) for c in ("section", "level", "status")]
    return _scored(spark, d, most).groupingSets([[by[0]], [by[1]], [by[2]], []], *by).agg(n().alias("n_docs"))


@query("""SELECT event_type, ts::DATE AS day, count(*) AS n_events, round(sum(value),2) AS total
  FROM events WHERE dayofweek(ts) BETWEEN 1 AND 5 GROUP BY ROLLUP(event_type, ts::DATE)""")
def q_period_rollup(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts")).where(O.business_day(F.col("day")))
    return e.rollup("event_type", "day").agg(n().alias("n_events"), F.round(F.sum("value"), 2).alias("total"))


@query("""WITH x AS (SELECT strftime(ts,'%Y-%m') AS month, ts::DATE AS day, count_if(event_type='error') AS errors, count(*) AS total
  FROM events GROUP BY 1,2) SELECT month, count(*) AS days, count_if(errors>0) AS days_with_errors, CASE WHEN count_if(errors>0)=0 THEN 'READY' ELSE 'BLOCKED' END AS gate
  FROM x GROUP BY month""")
def q_month_gate(spark, d):
    e = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("month"), F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "error").alias("errors"))
    bad = F.count_if(F.col("errors") > 0)
    return e.groupBy("month").agg(n().alias("days"), bad.alias("days_with_errors"), F.when(bad == 0, "READY").otherwise("BLOCKED").alias("gate"))


@query("""WITH s AS (SELECT event_type, min(ts)::DATE AS lo, max(ts)::DATE AS hi
  FROM events GROUP BY 1), c AS (SELECT event_type, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM s) SELECT event_type, day
  FROM c WHERE dayofweek(day) BETWEEN 1 AND 5""")
def q_business_days(spark, d):
    return O.calendar(table(spark, d, "events").withColumn("day", F.to_date("ts")), "day", "event_type")


@query("""WITH u AS (SELECT DISTINCT user_id FROM events), t AS (SELECT DISTINCT event_type FROM events), g AS (SELECT user_id, event_type
  FROM u, t), e AS (SELECT user_id, event_type, count(*) AS found
  FROM events GROUP BY 1,2) SELECT g.user_id, g.event_type, coalesce(found,0)::BIGINT AS found, CASE WHEN found>0 THEN 'DONE' ELSE 'PENDING' END AS status FROM g
  LEFT JOIN e ON g.user_id=e.user_id AND g.event_type=e.event_type""")
def q_grid_status(spark, d):
    e = table(spark, d, "events")
    kinds = e.select("event_type").distinct()
    grid = e.select("user_id").distinct().join(kinds.agg(F.collect_set("event_type").alias("ks")), how="cross").select("user_id", F.explode("ks").alias("event_type"))
    found = e.groupBy("user_id", "event_type").agg(n().alias("found"))
    return grid.join(found, ["user_id", "event_type"], "left").select("user_id", "event_type", F.coalesce("found", F.lit(0)).cast("bigint").alias("found"), F.when(F.col("found") > 0, "DONE").otherwise("PENDING").alias("status"))


@query("""WITH h AS (SELECT c_custkey AS key, c_acctbal>0 AS active FROM customer WHERE c_custkey % 5 <> 0), w AS (SELECT DISTINCT o_custkey AS key
  FROM orders) SELECT coalesce(h.key,w.key) AS key, CASE WHEN h.key IS NULL THEN 'NEW' WHEN w.key IS NULL AND active THEN 'REMOVED' WHEN w.key IS NULL THEN 'INACTIVE'
  WHEN active THEN 'KEPT' ELSE 'RETURNED' END AS status FROM h FULL JOIN w ON h.key=w.key""")
def q_portfolio_sync(spark, d):
    held = table(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("key"), (F.col("c_acctbal") > 0).alias("active"))
    return O.sync(held, table(spark, d, "orders").select(F.col("o_custkey").alias("key")).distinct())


@query("""WITH s AS (SELECT user_id AS key, max(ts)::DATE AS last FROM events GROUP BY 1), x AS (SELECT max(last) AS top
  FROM s), v AS (SELECT s.*, CASE WHEN date_diff('day', last, top)+1 > 1 AND key % 2 = 1 THEN 'BLOCKED'
  WHEN date_diff('day', last, top)+1 <= 0 THEN 'KEPT' ELSE 'ADVANCED' END AS verdict, top + 1 AS day FROM s, x) SELECT key, last, CASE WHEN (SELECT count(*)
  FROM v WHERE verdict='BLOCKED')=0 AND verdict='ADVANCED' THEN day ELSE last END AS next, verdict FROM v""")
def q_watermark_gap(spark, d):
    state = table(spark, d, "events").groupBy(F.col("user_id").alias("key")).agg(F.to_date(F.max("ts")).alias("last"))
    top = state.agg(F.date_add(F.max("last"), 1).alias("day"))  # one row
    return O.advance(state.crossJoin(F.broadcast(top)), F.col("day"), state.where("key % 2 = 0").select("key"))


@query("""WITH s AS (SELECT user_id AS key, max(ts)::DATE AS last FROM events GROUP BY 1), x AS (SELECT max(last) AS top
  FROM s) SELECT key, greatest(last+1, DATE '2024-01-02') AS start_day, top AS end_day, (date_diff('day', greatest(last+1, DATE '2024-01-02'), top)+1)::BIGINT AS days
  FROM s, x WHERE greatest(last+1, DATE '2024-01-02') <= top""")
def q_catchup_plan(spark, d):
    state = table(spark, d, "events").groupBy(F.col("user_id").alias("key")).agg(F.to_date(F.max("ts")).alias("last"))
    top = state.agg(F.max("last").alias("end_day"))
    plan = state.crossJoin(F.broadcast(top)).withColumn("start_day", F.greatest(F.date_add("last", 1), F.lit("2024-01-02").cast("date")))
    return plan.where("start_day <= end_day").select("key", "start_day", "end_day", (F.datediff("end_day", "start_day") + 1).cast("bigint").alias("days"))


@query("""WITH s AS (SELECT user_id, min(ts)::DATE AS lo, max(ts)::DATE AS hi
  FROM events GROUP BY 1), c AS (SELECT user_id, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day
  FROM s), e AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events) SELECT c.user_id, c.day FROM c
  LEFT JOIN e ON c.user_id=e.user_id AND c.day=e.day WHERE dayofweek(c.day) BETWEEN 1 AND 5 AND e.day IS NULL""")
def q_coverage_gap(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return O.coverage_gaps(O.calendar(e, "day", "user_id"), e, "user_id", "day")


@query("""WITH f AS (SELECT substr(sha256(user_id::VARCHAR||'|'||event_type),1,20) AS key, event_id, props
  FROM events), s AS (SELECT DISTINCT substr(sha256(user_id::VARCHAR||'|error'),1,20) AS key
  FROM events) SELECT f.key, arg_min(props, event_id) AS payload, count(*) AS seen FROM f LEFT JOIN s ON f.key=s.key WHERE s.key IS NULL GROUP BY f.key""")
def q_outbox(spark, d):
    e = table(spark, d, "events")
    found = e.select(T.short_hash(F.col("user_id"), F.col("event_type")).alias("key"), F.col("event_id").alias("ord"), F.col("props").alias("payload"))
    sent = e.select(T.short_hash(F.col("user_id"), F.lit("error")).alias("key")).distinct()
    return O.outbox(found, sent)


@query("""WITH l AS (SELECT user_id, event_type, max(ts) AS ts
  FROM events GROUP BY 1,2) SELECT user_id, count(*) AS stages, arg_max(event_type, struct_pack(ts := ts, event_type := event_type)) AS last_stage, CASE
  WHEN max((event_type='error')::INT)=1 THEN 'ERROR' WHEN count(*)<3 THEN 'PARTIAL' ELSE 'OK' END AS status FROM l GROUP BY user_id""")
def q_last_event(spark, d):
    last = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"))
    status = F.when(F.max((F.col("event_type") == "error").cast("int")) == 1, "ERROR").when(F.count("*") < 3, "PARTIAL").otherwise("OK")
    return last.groupBy("user_id").agg(n().alias("stages"), F.max_by("event_type", F.struct("ts", "event_type")).alias("last_stage"), status.alias("status"))


@query("""SELECT doc_id, CASE WHEN position('the' IN text) > 0 THEN (CASE
  WHEN position('the' IN text)-40 > 1 THEN '...'
  ELSE '' END) || substr(text, greatest(position('the' IN text)-40,1), least(position('the' IN text)+43,
  length(text)+1) - greatest(position('the' IN text)-40,1)) || (CASE
  WHEN least(position('the' IN text)+43, length(text)+1) <= length(text) THEN '...' ELSE '' END) END AS snippet FROM documents""")
def q_snippet(spark, d):
    return table(spark, d, "documents").select("doc_id", T.snippet(F.col("text"), F.lit("the")).alias("snippet"))


@query("SELECT c_nationkey AS nation, 'customer' AS source, c_name AS name FROM customer UNION SELECT s_nationkey, 'supplier', s_name FROM supplier")
def q_union_sources(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("source"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True).distinct()


@query("""WITH c AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'F'), s AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'O')
(SELECT key, 'only closed' AS side FROM c WHERE key NOT IN (SELECT key FROM s)) UNION ALL (SELECT key, 'only open' FROM s WHERE key NOT IN (SELECT key FROM c))""")
def q_symmetric_diff(spark, d):
    o = table(spark, d, "orders")
    keys = lambda status: o.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("key")).distinct()
    return O.difference(keys("F"), keys("O"), "only closed", "only open")


@query(f"""WITH {_SCORED} SELECT term, count_if(level='CRITICAL') AS critical, count_if(level='STRONG') AS strong, count_if(level='MEDIUM') AS medium,
  count_if(level='LOW') AS low, count(*) AS total FROM m JOIN s USING (doc_id) GROUP BY term""")
def q_pivot_terms(spark, d, most=None):
    counts = [F.count_if(F.col("level") == x).alias(x.lower()) for x in M.LEVELS[:4]]
    return _scored(spark, d, most).select("level", F.explode_outer("hits.term").alias("term")).where("term is not null").groupBy("term").agg(*counts, n().alias("total"))


@query(r"SELECT page_id, regexp_extract(url,'://([^/]+)',1) AS host, regexp_extract(url,'[?&]page=([^&]*)',1) AS page, regexp_extract(url,'[?&]ref=([^&]*)',1) AS ref FROM pages")
def q_url_params(spark, d):
    get = lambda k: F.coalesce(F.parse_url("url", F.lit("QUERY"), F.lit(k)), F.lit("")).alias(k)
    return table(spark, d, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), get("page"), get("ref"))


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,'(?is)<(script|style)[^>]*>.*?</(script|style)>',' ','g'),'(?is)<!--.*?-->',' ','g'),'(?i)</p>|<br ?/?>',chr(10),'g'),'<[^>]*>',' ','g') AS t FROM pages), b AS (SELECT page_id, list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x,'[ \t\r]+',' ','g'))) AS l FROM a) SELECT page_id, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS plain FROM b""")
def q_html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", strip_html(F.col("html")).alias("plain"))


@query(rf"""WITH s AS (SELECT doc_id, regexp_replace(substr(replace(trim(regexp_replace({_norm(_LINE)},'[^a-z0-9]+',' ','g')),' ','-'),1,12),'-+$','') AS slug
  FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY doc_id) AS k FROM s) SELECT doc_id, CASE WHEN k=1 THEN slug ELSE slug||'-'||k END AS name
  FROM r""")
def q_slug_dedup(spark, d):
    s = table(spark, d, "documents").select("doc_id", T.slug(T.first_line(F.col("text"), None), 12).alias("slug"))
    return R.numbered(s, "slug", "doc_id", "k").select("doc_id", F.when(F.col("k") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.col("k").cast("string"))).alias("name"))


@query(f"WITH {_SCORED} SELECT doc_id, level FROM s ORDER BY rank DESC, organ, title, doc_id")
def q_relevance_order(spark, d):
    return _scored(spark, d).orderBy(F.desc("rank"), "organ", "title", "doc_id").select("doc_id", "level")


@query(f"WITH {_PUBS}, {_TERMS} SELECT doc_id, sum(length(term))::BIGINT AS score FROM p JOIN w ON contains(norm, term) GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20")
def q_keyword_rank(spark, d):
    bag = F.lit([t for t, _ in M.WATCHLIST])  # terms inside words count; a record has a place among twenty, as a report shows
    score = F.aggregate(F.filter(bag, lambda t: F.contains("norm", t)), F.lit(0), lambda total, t: total + F.length(t))
    return _pubs(spark, d).select("doc_id", score.cast("bigint").alias("score")).where("score > 0").orderBy(F.desc("score"), "doc_id").limit(20)


@query("""SELECT regexp_extract(url,'://([^/]+)',1) AS host, count(*) AS n_pages, round(100.0::DOUBLE*count_if(contains(html,'<table'))/count(*),2) AS with_tables,
  min(length(html))::BIGINT AS least, max(length(html))::BIGINT AS most FROM pages GROUP BY 1""")
def q_page_profile(spark, d):
    p = table(spark, d, "pages")
    return p.groupBy(F.parse_url("url", F.lit("HOST")).alias("host")).agg(n().alias("n_pages"), F.round(F.lit(100.0) * F.count_if(F.contains("html", F.lit("<table"))) / F.count("*"), 2).alias("with_tables"), F.min(F.length("html")).cast("bigint").alias("least"), F.max(F.length("html")).cast("bigint").alias("most"))


@query("SELECT event_id FROM events WHERE ts < (SELECT max(ts)::DATE FROM events) - INTERVAL 10 DAY")
def q_retention(spark, d):
    e = table(spark, d, "events")
    ref = e.agg(F.to_date(F.max("ts")).alias("ref"))
    return e.crossJoin(F.broadcast(ref)).where(F.col("ts") < F.date_sub("ref", 10).cast("timestamp_ntz")).select("event_id")


@query("SELECT user_id, ts::DATE AS day, count(*) AS attempts, max(event_id) AS last_attempt, max(value) AS best FROM events GROUP BY 1,2")
def q_attempt_log(spark, d):
    return table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(n().alias("attempts"), F.max("event_id").alias("last_attempt"), F.max("value").alias("best"))


@query("""SELECT o_custkey, l_shipmonth, count(*) AS lines FROM (SELECT o_custkey, strftime(l_shipdate,'%Y-%m') AS l_shipmonth FROM orders
  JOIN lineitem ON l_orderkey=o_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY) GROUP BY 1,2""")
def q_start_range_join(spark, d):
    o, line = table(spark, d, "orders"), table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    j = o.join(line, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate")) & (F.col("l_shipdate") <= F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
    return j.groupBy("o_custkey", F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")).agg(n().alias("lines"))


_STRONG = ("licensed under", "public license", "mit license", "version 3")
_ESCAPED = "replace(replace(replace(replace(replace(coalesce(text,''),'&','&amp;'),'<','&lt;'),'>','&gt;'),'\"','&quot;'),chr(39),'&#x27;')"


def _strong(c: str) -> str:
    for t in sorted(_STRONG, key=lambda t: (-len(t), t)):
        c = f"regexp_replace({c},'(?i)({t})','<strong>\\1</strong>','g')"
    return c


@query(f"SELECT doc_id, md5({_strong(_ESCAPED)}) AS html_md5 FROM documents")
def q_highlight_terms(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(H.emphasise(F.col("text"), list(_STRONG)).cast("binary")).alias("html_md5"))


@query("""SELECT doc_id, (length(f)-length(replace(f,'version',''))) // 7 AS n_spans, instr(f,'version')-1 AS first_start FROM (SELECT doc_id, lower(text) AS f
  FROM documents) WHERE contains(f,'version')""")
def q_highlight_spans(spark, d):
    s = table(spark, d, "documents").select("doc_id", H.without_overlaps(H.all_occurrences(F.col("text"), ["version", "vers"])).alias("s"))
    s = s.select("doc_id", F.filter("s", lambda x: x["term"] == "version").alias("s")).where(F.size("s") > 0)
    return s.select("doc_id", F.size("s").cast("bigint").alias("n_spans"), F.col("s")[0]["start"].cast("bigint").alias("first_start"))


from pubmill.plans import context_queries, record_queries, report_queries, sink_queries, source_queries, state_queries  # noqa: E402,F401
