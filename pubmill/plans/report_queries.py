"""Queries of reports: confidence, audit lists, excerpts, merged parts, digests, bulletin rows and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import context as C
from pubmill.operators import matching as M
from pubmill.operators import monitoring as O
from pubmill.operators import reports as R
from pubmill.plans import context_queries as Q
from pubmill.plans.base import n, norm_sql, query, table

_LINE = "split_part(coalesce(text, ''), chr(10), 1)"
_ALL = f"""t AS (SELECT doc_id, {norm_sql('text')} AS norm, ' ' || {norm_sql('text')} || ' ' AS pad, string_split({norm_sql('text')}, ' ') AS toks,
  regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') AS digits FROM documents),
m AS (SELECT doc_id, term, how AS kind FROM ({' UNION ALL '.join(Q._hybrid_sql(*h) for h in Q.HYBRIDS)})
 UNION ALL SELECT doc_id, term, 'direct' FROM (SELECT doc_id, unnest({Q._HOLDS([t for t, _ in Q.TERMS])}) AS term FROM t)),
c AS (SELECT *, CASE WHEN kind = 'direct' THEN 'HIGH' WHEN kind = 'number' THEN CASE WHEN length(term) >= 6 THEN 'MEDIUM' ELSE 'LOW' END
 WHEN len(list_filter(string_split(term, ' '), lambda x: length(x) <= 2)) > 0 THEN CASE
  WHEN len(string_split(term, ' ')) >= 3 THEN 'CRITICAL' ELSE 'LOW' END ELSE 'MEDIUM' END AS c FROM m)"""


def _all_matches(spark, d):
    pubs = M.publications(table(spark, d, "documents"))
    return M.match_all(pubs, spark.createDataFrame(Q.HYBRIDS, "ord int, term string, kind string, origin string"), M.watchlist(spark, Q.TERMS))


@query(f"WITH {_ALL} SELECT doc_id, term, kind, c AS confidence FROM c")
def q_match_confidence(spark, d):
    return _all_matches(spark, d).select("doc_id", "term", "kind", R.match_confidence(F.col("kind"), F.col("term")).alias("confidence"))


@query(f"""WITH {_ALL} SELECT doc_id, CASE WHEN bool_or(c = 'CRITICAL') THEN 'CRITICAL' WHEN bool_or(c = 'LOW') AND bool_or(c = 'HIGH') THEN 'MEDIUM'
  WHEN bool_or(c = 'LOW') THEN 'LOW' WHEN bool_or(c = 'MEDIUM') THEN 'MEDIUM' ELSE 'HIGH' END AS confidence,
 count_if(kind <> 'direct' AND c IN ('LOW', 'CRITICAL')) AS n_suspect, CASE
  WHEN bool_or(kind <> 'direct' AND c IN ('LOW', 'CRITICAL')) THEN 'SUSPECT' ELSE 'CONFIRMED' END AS verdict FROM c GROUP BY 1""")
def q_audit_lists(spark, d):
    return R.publication_confidence(_all_matches(spark, d), "doc_id")


@query(f"WITH {Q._HITS} SELECT doc_id FROM h WHERE len(matched) = 0 ORDER BY doc_id LIMIT 20")
def q_without_match(spark, d):
    pubs = M.with_hits(M.publications(table(spark, d, "documents")), M.watchlist(spark, Q.TERMS))
    return pubs.where(F.size("hits") == 0).select("doc_id").orderBy("doc_id").limit(20)  # the report's sample


_ORCHESTRATED = f"""{Q._FACETS}, k AS (SELECT f.doc_id, matched, {Q._case(C.CONTEXT_RULES, 'level')} AS level, {Q._case(C.CONTEXT_RULES, 'relevant')} AS relevant,
 out, {Q._HOLDS(M.RESCUED)} AS back FROM f JOIN (SELECT doc_id, {Q._OPEN} AS out FROM documents) USING (doc_id))"""


@query(f"""WITH {_ORCHESTRATED} SELECT doc_id, CASE WHEN len(out) > 0 AND len(back) = 0 THEN 'EXCLUDED' WHEN len(matched) = 0 THEN 'NO_MATCH' WHEN relevant THEN 'VALID'
  WHEN level = 'SECTOR' THEN 'SECTOR' WHEN level = 'REVIEW' THEN 'REVIEW' ELSE 'FILTERED' END AS status,
 CASE WHEN len(out) > 0 AND len(back) = 0 THEN 'EXCLUDED' ELSE level END AS level, CASE
  WHEN len(out) > 0 AND len(back) = 0 THEN 0 ELSE len(matched) END::BIGINT AS n_matches FROM k""")
def q_match_orchestration(spark, d):
    pubs = M.with_hits(M.exclusion(M.publications(table(spark, d, "documents")), Q._EXCLUDING), M.watchlist(spark, Q.TERMS))
    tree = C.facets(pubs).withColumn("x", C.decide(C.CONTEXT_RULES))
    out, level = F.col("status") == "EXCLUDED", F.col("x.level")
    status = F.when(out, "EXCLUDED").when(F.size("hits") == 0, "NO_MATCH").when(F.col("x.relevant"), "VALID").when(level.isin("SECTOR", "REVIEW"), level).otherwise("FILTERED")
    return tree.select("doc_id", status.alias("status"), F.when(out, "EXCLUDED").otherwise(level).alias("level"), F.when(out, 0).otherwise(F.size("hits")).cast("long").alias("n_matches"))


@query(f"""WITH {Q._FACETS}, t AS (SELECT {Q._case(C.CONTEXT_RULES, 'relevant')} AS relevant, {Q._case(C.CONTEXT_RULES, 'level')} AS level, len(matched) AS k FROM f)
SELECT count(*) AS n_docs, count_if(k > 0) AS n_matched, count_if(relevant) AS n_relevant, greatest(count_if(k > 0) - count_if(relevant) - count_if(level = 'SECTOR'),
  0)::BIGINT AS n_rest, sum(k)::BIGINT AS n_matches,
 round(CASE WHEN count(*) > 0 THEN 100.0::DOUBLE * count_if(relevant) / count(*) ELSE 0 END, 2) AS relevant_rate FROM t""")
def q_executive_summary(spark, d):
    t = Q._faceted(spark, d).select(F.size("hits").alias("k"), C.decide(C.CONTEXT_RULES).alias("x"))
    matched, relevant = F.count_if(F.col("k") > 0), F.count_if("x.relevant")
    rest = F.greatest(matched - relevant - F.count_if(F.col("x.level") == "SECTOR"), F.lit(0))
    rate = F.round(F.when(F.count("*") > 0, F.lit(100.0) * relevant / F.count("*")).otherwise(0.0), 2)
    return t.agg(n().alias("n_docs"), matched.alias("n_matched"), relevant.alias("n_relevant"), rest.cast("bigint").alias("n_rest"), F.sum("k").cast("bigint").alias("n_matches"), rate.alias("relevant_rate"))


@query(f"""{Q._curation_sql()} SELECT section, relevance, source, lang, count(*) AS n_items FROM e
  JOIN (SELECT doc_id, source, lang FROM documents) USING (doc_id) WHERE section <> 'DISCARDED' GROUP BY GROUPING SETS ((section), (relevance), (source), (lang))""")
def q_executive_view(spark, d):
    by = [F.col(c) for c in ("section", "relevance", "source", "lang")]
    items = Q._curated(spark, d).join(table(spark, d, "documents").select("doc_id", "source", "lang"), "doc_id").where("section <> 'DISCARDED'")
    return items.groupingSets([[c] for c in by], *by).agg(n().alias("n_items"))


@query("""WITH b AS (SELECT user_id % 3 AS purpose, ts::DATE AS day, count(*) AS items, count_if(event_type = 'error') AS failed
  FROM events WHERE dayofweek(ts) BETWEEN 1 AND 5 GROUP BY 1, 2)
SELECT purpose, count(*) AS days, sum(items)::BIGINT AS items, count_if(failed = 0) AS complete, count_if(failed > 0) AS partial FROM b GROUP BY ROLLUP(purpose)""")
def q_period_consolidation(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts")).where(O.business_day(F.col("day")))
    days = e.groupBy((F.col("user_id") % 3).alias("purpose"), "day").agg(n().alias("items"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return days.rollup("purpose").agg(n().alias("days"), F.sum("items").alias("items"), F.count_if(F.col("failed") == 0).alias("complete"), F.count_if(F.col("failed") > 0).alias("partial"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderdate::DATE AS day, o_orderstatus AS status, count(*) AS cells
  FROM orders GROUP BY GROUPING SETS ((strftime(o_orderdate, '%Y-%m'), o_orderstatus), (strftime(o_orderdate, '%Y-%m'), o_orderdate::DATE, o_orderstatus))""")
def q_grid_rollup(spark, d):
    month, day, status = F.col("month"), F.col("day"), F.col("status")
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status"))
    return o.groupingSets([[month, status], [month, day, status]], month, day, status).agg(n().alias("cells"))


_CAND = """r AS (SELECT o_custkey AS process, strftime(o_orderdate, '%Y') AS year, o_orderkey AS rec, o_orderpriority AS title, o_orderstatus AS organ,
  (o_orderkey % 10)::VARCHAR AS page, 'f' || o_orderkey % 7 AS file, 'u' || o_orderkey % 5 AS url FROM orders),
o AS (SELECT process, year, rec AS occ, CASE WHEN rec % 4 = 0 THEN substr(title, 1, 3) ELSE title END AS title, organ, CASE
  WHEN rec % 3 = 0 THEN NULL ELSE page END AS page, file, CASE WHEN rec % 8 = 0 THEN '' ELSE url END AS url FROM r WHERE rec % 6 = 0)"""


@query(f"""WITH {_CAND}, k AS (SELECT *, {norm_sql('title')} AS nt FROM r), p AS (SELECT *, {norm_sql('title')} AS nt FROM o),
s AS (SELECT occ, rec, (100 + CASE WHEN p.nt <> '' AND p.nt = k.nt THEN 40
  WHEN p.nt <> '' AND k.nt <> '' AND (contains(p.nt, k.nt) OR contains(k.nt, p.nt)) THEN 20 ELSE 0 END + CASE WHEN p.organ = k.organ THEN 20 ELSE 0 END
 + CASE WHEN p.page = k.page THEN 20 ELSE 0 END + CASE WHEN p.file = k.file THEN 60 ELSE 0 END + CASE
  WHEN p.url <> '' AND p.url = k.url THEN 60 ELSE 0 END)::BIGINT AS score FROM p JOIN k ON p.process = k.process AND p.year = k.year)
SELECT occ, rec, score FROM (SELECT *, max(score) OVER (PARTITION BY occ) AS best FROM s) WHERE score >= best - 20""")
def q_candidate_score(spark, d):
    k = F.col("o_orderkey")
    r = table(spark, d, "orders").select(F.col("o_custkey").alias("process"), F.date_format("o_orderdate", "yyyy").alias("year"), k.alias("rec"), F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("organ"), (k % 10).cast("string").alias("page"), F.concat(F.lit("f"), (k % 7).cast("string")).alias("file"), F.concat(F.lit("u"), (k % 5).cast("string")).alias("url"))
    rec = F.col("rec")
    o = r.where("rec % 6 = 0").select("process", "year", rec.alias("occ"), F.when(rec % 4 == 0, F.substring("title", 1, 3)).otherwise(F.col("title")).alias("title"), "organ", F.when(rec % 3 != 0, F.col("page")).alias("page"), "file", F.when(rec % 8 == 0, "").otherwise(F.col("url")).alias("url"))
    return R.best_candidates(o, r, ["process", "year"])


_AT = lambda t: f"CASE WHEN instr(x, '{t}') > 0 THEN struct_pack(a := greatest(instr(x, '{t}') - 41, 0), b := least(instr(x, '{t}') - 1 + {len(t)} + 40, length(x)), t := '{t}') END"
_COVER = lambda kept, a, b: f"({kept} AND coalesce(least({b}.b, {a}.b) - greatest({b}.a, {a}.a) >= ({b}.b - {b}.a) * 0.8, false))"


@query(f"""WITH a AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), p AS (SELECT doc_id, {_AT('that')} AS s1, {_AT('the')} AS s2, {_AT('with')} AS s3 FROM a),
q AS (SELECT *, s1 IS NOT NULL AS k1, s2 IS NOT NULL AND NOT {_COVER('s1 IS NOT NULL', 's1', 's2')} AS k2
  FROM p), r AS (SELECT *, s3 IS NOT NULL AND NOT {_COVER('k1', 's1', 's3')} AND NOT {_COVER('k2', 's2', 's3')} AS k3 FROM q)
SELECT doc_id, concat_ws(';', CASE WHEN k1 THEN 'that:' || s1.a || ':' || s1.b END, CASE WHEN k2 THEN 'the:' || s2.a || ':' || s2.b END, CASE
  WHEN k3 THEN 'with:' || s3.a || ':' || s3.b END) AS spans FROM r""")
def q_excerpts(spark, d):
    spans = R.excerpts(F.coalesce("text", F.lit("")), ["that", "the", "with"])
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["term"], s["start"].cast("string"), s["end"].cast("string")))
    return table(spark, d, "documents").select("doc_id", F.array_join(shown, ";").alias("spans"))


@query(f"""WITH p AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 999999 ELSE turn END AS page, CASE
  WHEN role = 'user' THEN substr(text, 1, 20) ELSE ' ' END AS title, role, substr(text, 1, 30) AS text, {norm_sql('substr(text, 1, 30)')} AS print FROM conversations),
l AS (SELECT conv_id, arg_min(title, turn) FILTER (trim(title) <> '') AS title, list(role ORDER BY turn, role) AS rs, count(*) AS n_parts, list(text
  ORDER BY page, turn, text) AS ts, list(print ORDER BY page, turn, text) AS ps FROM p GROUP BY 1)
SELECT conv_id, title, array_to_string(list_transform(list_filter(range(len(rs)), lambda i: list_position(rs, rs[i + 1]) = i + 1), lambda i: rs[i + 1]), ',') AS roles, n_parts,
 array_to_string(list_transform(list_filter(range(len(ts)), lambda i: list_position(ps, ps[i + 1]) = i + 1), lambda i: ts[i + 1]), chr(10) || chr(10)) AS text FROM l""")
def q_merge_parts(spark, d):
    turn = F.col("turn")
    parts = table(spark, d, "conversations").select("conv_id", turn.alias("ord"), F.when(turn % 3 == 0, "x").otherwise(turn.cast("string")).alias("page"), F.when(F.col("role") == "user", F.substring("text", 1, 20)).otherwise(" ").alias("title"), "role", F.substring("text", 1, 30).alias("text"))
    return R.merge_parts(parts, "conv_id").select("conv_id", "title", F.array_join("roles", ",").alias("roles"), "n_parts", "text")


_P = "lpad((o_orderkey % 100000)::VARCHAR, 5, '0') AS a, lpad((o_custkey % 1000000)::VARCHAR, 6, '0') AS b, strftime(o_orderdate, '%Y') AS c, lpad((o_orderkey % 97)::VARCHAR, 2, '0') AS e"


@query(f"WITH t AS (SELECT o_orderkey, {_P} FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN '' ELSE a || '.' || b || '/' || c || '-' || e END AS shown FROM t")
def q_process_display(spark, d):
    pad = lambda c, width: F.lpad(c.cast("string"), width, "0")
    o = table(spark, d, "orders").select("o_orderkey", pad(F.col("o_orderkey") % 100000, 5).alias("a"), pad(F.col("o_custkey") % 1000000, 6).alias("b"), F.date_format("o_orderdate", "yyyy").alias("c"), pad(F.col("o_orderkey") % 97, 2).alias("e"))
    kind, bare = F.col("o_orderkey") % 5, F.concat("a", "b", "c", "e")
    spelt = F.when(kind == 0, F.concat("a", F.lit("."), "b", F.lit("/"), "c", F.lit("-"), "e")).when(kind == 1, F.concat_ws(" ", "a", "b", "c", "e")).when(kind == 2, bare).when(kind == 3, F.concat(bare, F.lit(" and "), bare)).otherwise(F.concat(bare, F.lit("7")))
    return o.select("o_orderkey", F.array_join(R.shown_processes(F.concat(F.lit("no. "), spelt, F.lit("."))), ",").alias("shown"))


@query(f"""WITH {Q._HITS}, p AS (SELECT d.doc_id AS id, CASE WHEN d.doc_id % 2 = 0 THEN 'GAZETTE' ELSE 'OTHER' END AS organ, substr({_LINE}, 1, 30) AS title, CASE
  WHEN d.doc_id % 3 <> 0 THEN 'own' || d.doc_id ELSE '' END AS own, CASE WHEN d.doc_id % 5 <> 0 THEN 'list' || d.doc_id END AS list, matched FROM documents d
  JOIN h USING (doc_id))
SELECT 'publication' AS origin, id, organ, title, CASE
  WHEN organ = 'GAZETTE' THEN coalesce(nullif(list, ''), nullif(own, ''), '')
  ELSE coalesce(nullif(own, ''), nullif(list, ''), '') END AS url, array_to_string(list_filter(matched, lambda t: t NOT IN ('than', 'des')), ',') AS terms FROM p
UNION ALL SELECT 'page', page_id, '', substr(html, 1, 15), url, '' FROM pages""")
def q_digest(spark, d):
    k = F.col("doc_id")
    hits = M.with_hits(M.publications(table(spark, d, "documents")), M.watchlist(spark, Q.TERMS))
    pubs = hits.select(k.alias("id"), F.when(k % 2 == 0, "GAZETTE").otherwise("OTHER").alias("organ"), F.substring("title", 1, 30).alias("title"), F.when(k % 3 != 0, F.concat(F.lit("own"), k.cast("string"))).otherwise("").alias("own_url"), F.when(k % 5 != 0, F.concat(F.lit("list"), k.cast("string"))).alias("listing_url"), F.col("hits.term").alias("terms"))
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.substring("html", 1, 15).alias("title"), "url")
    return R.digest(pubs, pages, ["than", "des"]).withColumn("terms", F.array_join("terms", ","))


@query(f"""{Q._curation_sql()}, b AS (SELECT e.*, coalesce(text, '') AS x, trim({_LINE}) AS t FROM e JOIN documents USING (doc_id))
SELECT doc_id AS id, CASE WHEN length(t) > 200 THEN substr(t, 1, 200) || '...' ELSE t END AS title, section, CASE
  WHEN section = 'DISCARDED' THEN 'DISCARDED' ELSE lower(section) END AS relation, relevance AS level,
 md5(CASE WHEN length(trim(x)) > 1000 THEN rtrim(substr(trim(x), 1, 1000)) || '...' ELSE trim(x) END) AS summary, md5(CASE
  WHEN length(x) > 3000 THEN substr(x, 1, 2997) || '...' ELSE x END) AS text FROM b""")
def q_bulletin(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    c = Q._curated(spark, d).join(docs, "doc_id")
    pubs = c.select(F.col("doc_id").alias("id"), T.first_line(F.col("text"), None).alias("title"), "section", F.lower("section").alias("relation"), F.col("relevance").alias("level"), F.lit(None).cast("string").alias("summary"), "text", (F.col("section") == "DISCARDED").alias("discarded"))
    digest = lambda x: F.md5(F.col(x).cast("binary")).alias(x)
    return R.bulletin_row(pubs).select("id", "title", "section", "relation", "level", digest("summary"), digest("text"))


@query(f"""WITH {_ALL}, s AS (SELECT doc_id, string_agg(DISTINCT term, ',' ORDER BY term) AS reasons
  FROM c WHERE kind <> 'direct' AND c IN ('LOW', 'CRITICAL') GROUP BY 1), w AS (SELECT doc_id FROM c GROUP BY 1)
SELECT w.doc_id, split_part(source, 'c', 2) AS organ, md5(substr(coalesce(text, ''), 1, 500)) AS sample, coalesce(reasons, '') AS reasons FROM w
  JOIN documents USING (doc_id) LEFT JOIN s ON s.doc_id = w.doc_id""")
def q_report_rows(spark, d):
    m = _all_matches(spark, d)
    doubt = R.suspect(F.col("kind"), R.match_confidence(F.col("kind"), F.col("term")))
    reasons = m.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set(F.when(doubt, F.col("term")))), ",").alias("reasons"))
    docs = table(spark, d, "documents").select("doc_id", F.split("source", "c")[1].alias("organ"), F.md5(F.substring(F.coalesce("text", F.lit("")), 1, 500).cast("binary")).alias("sample"))
    return docs.join(reasons, "doc_id").select("doc_id", "organ", "sample", "reasons")


_ESC = "replace(replace(replace(replace(replace(coalesce({c},''),'&','&amp;'),'<','&lt;'),'>','&gt;'),'\"','&quot;'),chr(39),'&#x27;')"


@query(f"""WITH a AS (SELECT doc_id, {_ESC.format(c=_LINE)} AS t, {_ESC.format(c='source')} AS o, regexp_replace({_ESC.format(c='text')}, '(?i)(mit license)',
  '<strong>\\1</strong>', 'g') AS b FROM documents)
SELECT doc_id, md5('<article><h1>' || t || '</h1><h2>' || o || '</h2>' || array_to_string(list_transform(list_filter(string_split(b, chr(10)), lambda x: trim(x) <> ''),
  lambda x: '<p>' || x || '</p>'), '') || '</article>') AS page FROM a""")
def q_full_pages(spark, d):
    page = R.full_page(T.first_line(F.col("text"), None), F.col("source"), F.col("text"), ["mit license"])
    return table(spark, d, "documents").select("doc_id", F.md5(page.cast("binary")).alias("page"))


@query(None)
def flexible_spans(spark, d):
    """Terms in any case, accents and spacing, as spans of the original texts."""
    spans = R.flexible_spans(table(spark, d, "documents"), ["public license", "version 3", "licensed under", "than the"])
    return spans.where(F.size("spans") > 0)


_FOLDED = "strip_accents(lower(coalesce(text, '')))"
_GAP = r"[\s\-–—_/.,;:()]*"


@query(rf"""WITH t AS (SELECT doc_id, regexp_extract({_FOLDED}, '(?s)^((?:.*?[^a-z0-9])?)(public{_GAP}license)(?:$|[^a-z0-9])', ['a', 'b']) AS m FROM documents)
SELECT doc_id, length(m.a)::BIGINT AS first_start, (length(m.a) + length(m.b))::BIGINT AS first_end FROM t WHERE m.b <> ''""")
def q_flexible_spans(spark, d):
    spans = R.flexible_spans(table(spark, d, "documents"), ["Públic  licensé"]).where(F.size("spans") > 0)
    first = F.col("spans")[0]
    return spans.select("doc_id", first["start"].cast("long").alias("first_start"), first["end"].cast("long").alias("first_end"))
