"""Queries of archives, collection outcomes, watchlists, catalogs and page structure."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from pubmill.operators import monitoring as O
from pubmill.plans.base import norm_sql, query, table, values
from pubmill.functions import text as T
from pubmill.operators import highlights as H
from pubmill.sources import archive as A
from pubmill.sources import collection as S
from pubmill.sources import pages as P

# Orders as downloads: the key decides the HTTP status, the content and the entries read from it.
_KIND = "o_orderkey % 8"
_OUTCOME = f"""o AS (SELECT o_orderdate::DATE AS day, ['DO1', 'DO2', 'DO3', 'DO1E', 'DO2E', 'DO3E'][(o_orderkey % 6 + 1)::INT] AS edition,
 CASE {_KIND} WHEN 0 THEN 'ABSENT_404' WHEN 1 THEN 'HTTP_ERROR' WHEN 2 THEN 'VALID' WHEN 3 THEN 'VALID_EMPTY' WHEN 4 THEN 'CORRUPT_ARCHIVE'
  WHEN 5 THEN 'SESSION_OR_SERVICE_ERROR' WHEN 6 THEN 'ABSENT_IN_SESSION' ELSE 'UNKNOWN_RESPONSE' END AS outcome, o_orderkey FROM orders)"""


def _outcomes(spark, d, where="true"):
    o, kind = table(spark, d, "orders").where(where), F.col("o_orderkey") % 8
    status = F.when(kind == 0, 404).when(kind == 1, 500).otherwise(200)
    content = F.when(kind.isin(2, 4), F.lit(bytearray(b"PK\x03\x04data"))).when(kind == 3, F.lit(bytearray(b"PK\x05\x06"))).when(kind == 5, F.lit(bytearray(b"<html>Login"))).when(kind == 6, F.lit(bytearray(b"Signed in as x"))).otherwise(F.lit(bytearray(b"\xff\xfe")))
    entries = F.when(kind == 2, 3).when(kind == 3, 0)
    edition = F.element_at(F.lit(list(S.EDITIONS)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select(F.to_date("o_orderdate").alias("day"), edition.alias("edition"), S.download_outcome(status, content, entries).alias("outcome"), "o_orderkey")


@query(f"WITH {_OUTCOME} SELECT o_orderkey, outcome FROM o")
def q_download_outcome(spark, d):
    return _outcomes(spark, d).select("o_orderkey", "outcome")


_DAYS = f"""{_OUTCOME}, c AS (SELECT day, count_if(outcome NOT IN ('VALID', 'VALID_EMPTY', 'ABSENT_404', 'ABSENT_IN_SESSION')) AS failed, count_if(outcome = 'VALID') AS valid,
 count_if(outcome IN ('ABSENT_404', 'ABSENT_IN_SESSION', 'VALID_EMPTY')) AS absent, count_if(outcome = 'ABSENT_404' AND edition IN ('DO1', 'DO2', 'DO3')) AS missing
  FROM o WHERE o_orderkey % 8 IN (0, 2, 3, 6) OR o_orderkey % 64 = 1 GROUP BY day),
s AS (SELECT day, CASE WHEN failed > 0 THEN 'COLLECTION_ERROR' WHEN valid > 0 THEN 'COLLECTED'
  WHEN absent = 6 THEN 'NO_PUBLICATIONS' ELSE 'COLLECTION_ERROR' END AS status, valid, missing FROM c)"""
_SOME = "o_orderkey % 8 in (0, 2, 3, 6) or o_orderkey % 64 = 1"


@query(f"WITH {_DAYS} SELECT * FROM s")
def q_collection_status(spark, d):
    return S.day_status(_outcomes(spark, d, _SOME).select("day", "edition", "outcome"))


@query(f"""WITH {_DAYS} SELECT day, CASE WHEN status = 'COLLECTION_ERROR' OR (status = 'COLLECTED' AND missing > 0) THEN 'REJECTED'
  WHEN status = 'NO_PUBLICATIONS' THEN 'EMPTY' ELSE 'ACCEPTED' END AS verdict FROM s""")
def q_coverage_guard(spark, d):
    return S.covered(_outcomes(spark, d, _SOME).select("day", "edition", "outcome"))


@query(f"SELECT DISTINCT {norm_sql('p_name')} AS term FROM part WHERE {norm_sql('p_name')} <> ''")
def q_single_column(spark, d):
    return S.single_column(table(spark, d, "part"), "p_name")


# Categories of terms with their precedence.
_KNOWN = (("standard anodized tin", "metal", 2), ("economy", "size", 1), ("promo", "offer", 3), ("economy", "offer", 2))


@query(f"""WITH k(term, category, prio) AS (VALUES {values(_KNOWN)}), c AS (SELECT term, arg_min(category, prio) AS category FROM k GROUP BY 1),
t AS (SELECT DISTINCT {norm_sql("split_part(p_type, ' ', 1)")} AS term FROM part)
SELECT t.term, CASE WHEN regexp_matches(t.term, '[A-Za-z]') AND regexp_matches(t.term, '[0-9]') THEN 'hybrid'
  WHEN regexp_matches(t.term, '[0-9]') THEN 'number' ELSE 'text' END AS kind, coalesce(c.category, 'product') AS category FROM t
  LEFT JOIN c USING (term) WHERE t.term <> ''""")
def q_simple_watchlist(spark, d):
    sheet = table(spark, d, "part").select(F.split("p_type", " ")[0].alias("cell"))
    return S.simple_watchlist(sheet, "cell", spark.createDataFrame(_KNOWN, "term string, category string, prio int"))


_MONO = norm_sql("regexp_replace(trim(code), '^[A-Za-z]?[0-9]+\\s*[-–—]\\s*', '')")


@query(f"""WITH m AS (SELECT 'A' || p_partkey || ' - ' || p_brand AS code FROM part WHERE p_partkey % 4 = 0), e AS (SELECT {_MONO} AS term, 0 AS rank, 'monograph' AS origin FROM m
 UNION ALL SELECT {norm_sql('p_brand')}, 1, 'p_brand' FROM part
  UNION ALL SELECT {norm_sql('p_type')}, 2, 'p_type' FROM part) SELECT term, arg_min(origin, rank) AS origin FROM e WHERE term <> '' GROUP BY 1""")
def q_legacy_watchlist(spark, d):
    part = table(spark, d, "part")
    mono = part.where("p_partkey % 4 = 0").select(F.concat(F.lit("A"), F.col("p_partkey").cast("string"), F.lit(" - "), "p_brand").alias("code"))
    return S.legacy_watchlist(mono, F.col("code"), part, ["p_brand", "p_type"])


_NUMBERS = """n AS (SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 10 = 0 THEN ' '
  WHEN o_orderkey % 7 = 0 THEN 'no. ' || o_orderkey
  ELSE lpad((o_custkey % 97)::VARCHAR, 5, '0') || '.' || lpad((o_custkey % 89)::VARCHAR, 6, '0') || '/2024-' || lpad((o_custkey % 83)::VARCHAR, 2, '0') END AS cell
  FROM orders),
p AS (SELECT ord, cell, regexp_replace(cell, '[^0-9]', '', 'g') AS process FROM n WHERE trim(cell) <> '')"""


def _numbers(spark, d):
    pad = lambda m, w: F.lpad((F.col("o_custkey") % m).cast("string"), w, "0")
    k = F.col("o_orderkey")
    cell = F.when(k % 10 == 0, " ").when(k % 7 == 0, F.concat(F.lit("no. "), k.cast("string"))).otherwise(F.concat(pad(97, 5), F.lit("."), pad(89, 6), F.lit("/2024-"), pad(83, 2)))
    return S.process_list(table(spark, d, "orders").select(k.alias("ord"), cell.alias("cell")), "cell", "ord")


@query(f"""WITH {_NUMBERS} SELECT process, substr(process, 1, 5) || '.' || substr(process, 6, 6) || '/' || substr(process, 12, 4) || '-' || substr(process, 16,
  2) AS shown, min(ord) AS ord FROM p WHERE length(process) = 17 GROUP BY process""")
def q_process_list(spark, d):
    return _numbers(spark, d)[0]


@query(f"WITH {_NUMBERS} SELECT ord, cell AS value FROM p WHERE length(process) <> 17")
def q_process_list_errors(spark, d):
    return _numbers(spark, d)[1]


@query("""WITH l AS (SELECT o_custkey AS page, list(o_orderkey ORDER BY o_orderkey) AS ks FROM orders GROUP BY 1), x AS (SELECT page, unnest(ks) AS k, len(ks) AS total FROM l)
SELECT DISTINCT page, 'u' || (k % 50) AS url, 't' AS title, NULL AS problem FROM x WHERE page % 5 <> 0 AND page % 7 <> 0 AND k % 3 <> 0 UNION ALL
SELECT page, NULL, NULL, CASE WHEN page % 7 = 0 THEN 'totals differ' ELSE 'items missing' END FROM l WHERE page % 5 = 0 OR page % 7 = 0""")
def q_catalog(spark, d):
    item = F.struct(F.concat(F.lit("u"), (F.col("o_orderkey") % 50).cast("string")).alias("id"), F.lit("File").alias("type"), F.lit("application/pdf").alias("mime_type"), F.lit("t").alias("title"), F.when(F.col("o_orderkey") % 3 != 0, "published").otherwise("draft").alias("review_state"))
    pages = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("page")).agg(F.to_json(F.collect_list(item)).alias("items"), F.count("*").alias("k"))
    total = lambda x: F.concat(F.lit(', "items_total": '), x.cast("string"))
    again = F.when(F.col("page") % 7 == 0, total(F.col("k") + 1)).otherwise("")
    html = F.concat(F.lit('<script>{"items": '), "items", total(F.when(F.col("page") % 5 == 0, F.col("k") + 2).otherwise(F.col("k"))), again, F.lit("}</script>"))
    return S.catalog(pages.select("page", html.alias("html")))


@query("""SELECT o_orderkey AS key, CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 1 END::BIGINT AS found, CASE
  WHEN o_orderkey % 4 = 2 THEN 'JSONDecodeError' END AS error FROM orders""")
def q_payload_scan(spark, d):
    k = F.col("o_orderkey")
    one = F.concat(F.lit('{"title": "t'), k.cast("string"), F.lit('", "text": "x"}'))
    json = F.when(k % 4 == 0, F.concat(F.lit("["), one, F.lit(', {"more": {"list": ['), one, F.lit("]}}]"))).when(k % 4 == 1, F.concat(F.lit('{"records": ['), one, F.lit(', {"title": "alone"}]}'))).when(k % 4 == 2, "{not json").otherwise(F.concat(F.lit('{"a": [[{"name": "n", "url": "u"}]], "b": 1}')))
    rows = S.payload_scan(table(spark, d, "orders").select(k.alias("key"), json.alias("json")))
    return rows.groupBy("key").agg(F.count("publication").cast("bigint").alias("found"), F.max("error").alias("error"))


@query(r"""SELECT source, lang, count(*) AS n_pubs, count_if(doc_id % 2 = 0) AS with_url, count_if(doc_id % 2 <> 0) AS without_url, count_if(len(regexp_extract_all(text,
  '\n')) >= 1) AS several_acts, count_if(doc_id % 5 = 0) AS continued
FROM documents WHERE trim(coalesce(text, '')) <> '' GROUP BY 1, 2""")
def q_source_summary(spark, d):
    k = F.col("doc_id")
    pubs = table(spark, d, "documents").select("source", "lang", "text", F.when(k % 2 == 0, "http://x").alias("url"), (F.regexp_count("text", F.lit("\n")) + 1).alias("acts"), (k % 5 == 0).alias("continued"))
    return S.source_summary(pubs, "source", "lang")


# Pages as they are, and of every fourth one with a table, of every fifth one with who signed, of every tenth one nothing but a comment.
_TEXT = lambda c: f"trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace({c}, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&'), '\\s+', ' ', 'g'))"


@query(f"""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 10 = 3 THEN '' ELSE html END AS html, page_id % 10 <> 3 AND page_id % 4 = 0 AS has_table, page_id % 10 <> 3 AND page_id % 5 = 0 AS signed FROM pages),
b AS (SELECT page_id, len(regexp_extract_all(html, '(?i)<(p|h1|h2|h3|h4|li|blockquote)[ >]')) AS blocks FROM p)
SELECT page_id, CASE WHEN blocks > 0 THEN 'OK' ELSE 'NO_ARTICLE' END AS status, {_TEXT("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS title, blocks, (has_table::INT)::BIGINT AS tables,
 CASE WHEN has_table THEN 'no|' || page_id || ';address|' || url ELSE '' END AS cells, CASE WHEN signed THEN 'Signed by ' || page_id ELSE '' END AS signatures FROM p JOIN b USING (page_id)""")
def q_page_blocks(spark, d):
    k = F.col("page_id").cast("string")
    grid = F.concat(F.lit("<table><tr><th>no<td>"), k, F.lit("</tr><tr><td>address</td><td>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</td></tr></table>"))
    signed = F.concat(F.lit('<p class="x signed">Signed by '), k, F.lit("</p>"))
    html = F.concat("html", F.when(F.col("page_id") % 4 == 0, grid).otherwise(""), F.when(F.col("page_id") % 5 == 0, signed).otherwise(""))
    pages = table(spark, d, "pages").select(F.col("page_id").alias("key"), F.when(F.col("page_id") % 10 == 3, "<!-- <p>none</p> -->").otherwise(html).alias("html"))
    parsed = P.parse_pages(pages)
    cells = F.array_join(F.flatten(F.transform("tables", lambda t: F.transform(t, lambda r: F.array_join(r, "|")))), ";")
    return parsed.select(F.col("key").cast("long").alias("page_id"), "status", "title", F.size("blocks").cast("bigint").alias("blocks"), F.size("tables").cast("bigint").alias("tables"), cells.alias("cells"), F.array_join("signatures", ";").alias("signatures"))


@query("""WITH x AS (SELECT o_orderkey % 25 AS user_id, o_orderdate::DATE AS day
  FROM orders) SELECT user_id, count(DISTINCT day) AS days, min(day) AS first_day, max(day) AS last_day FROM x WHERE dayofweek(day) BETWEEN 1 AND 5 GROUP BY 1""")
def q_covered_days(spark, d):
    x = table(spark, d, "orders").select((F.col("o_orderkey") % 25).alias("user_id"), F.to_date("o_orderdate").alias("day")).where(O.business_day(F.col("day")))
    return x.groupBy("user_id").agg(F.countDistinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def _as_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of up to A.BATCH characters of XML texts (doc_id, xml), entries named by id, and an entry that is no XML file."""
    for batch in batches:
        ids, texts = batch["doc_id"], batch["xml"]
        at = 0
        while at < len(batch):
            held, size = io.BytesIO(), 0
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("readme.txt", "none")
                while at < len(batch) and size < A.BATCH:
                    k, xml = ids[at].as_py(), texts[at].as_py()
                    z.writestr(f"g{k % 7}-{k}.XML", xml)
                    at, size = at + 1, size + len(xml)
            yield pa.RecordBatch.from_arrays([pa.array(["a.zip"]), pa.array([held.getvalue()])], ["path", "content"])


def _publications(spark, d):
    """Documents as XML: a title for two of three, the text as body, tags in odd cases and with a namespace, every eleventh malformed."""
    k, body = F.col("doc_id"), H.escape_html(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n -~ -퟿]", ""))
    line = H.escape_html(T.first_line(F.col("text"), 50))
    title = F.when(k % 3 == 0, F.concat(F.lit("<x:IDENTIFICA> "), line, F.lit("</x:IDENTIFICA>"))).when(k % 3 == 1, F.concat(F.lit("<Ementa>"), line, F.lit("</Ementa><ementa>second</ementa>"))).otherwise("")
    xml = F.concat(F.lit('<a xmlns:x="u">'), title, F.lit("<b><Texto>"), body, F.lit("</Texto></b>"), F.when(k % 11 == 0, "<open>").otherwise(""), F.lit("</a>"))
    return table(spark, d, "documents").select(k, xml.alias("xml"))


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[^\n -~\x{a0}-\x{d7ff}]', '', 'g') AS body, substr(split_part(coalesce(text, ''), chr(10), 1), 1, 50) AS line FROM documents)
SELECT doc_id, 'g' || doc_id % 7 AS xml_group, doc_id::INT AS xml_index, CASE WHEN doc_id % 11 = 0 THEN 'malformed' END AS problem, CASE WHEN doc_id % 11 = 0 THEN NULL
  WHEN doc_id % 3 <> 2 AND trim(line) <> '' THEN trim(line) WHEN trim(body, ' ' || chr(10)) <> '' THEN substr(trim(body, ' ' || chr(10)), 1, 80) ELSE 'Untitled' END AS title,
 CASE WHEN doc_id % 11 <> 0 THEN md5(trim(body, ' ' || chr(10))) END AS body_md5 FROM t""")
def q_archive_entries(spark, d):
    """Archives made of all documents, read back entry by entry."""
    rows = A.zip_entries(_publications(spark, d).mapInArrow(_as_archives, "path string, content binary"))
    parsed = A.parse_publications(rows).select("xml_name", "title", F.btrim("texto", F.lit(" \n")).alias("texto"))
    name = F.regexp_extract("xml_name", "^(g[0-9]+)-([0-9]+)", 1), F.regexp_extract("xml_name", "^(g[0-9]+)-([0-9]+)", 2)
    out = rows.select("xml_name", "error").join(parsed, "xml_name", "left")
    problem = F.when(F.startswith("error", F.lit("malformed XML")), "malformed")
    return out.select(name[1].cast("long").alias("doc_id"), name[0].alias("xml_group"), name[1].cast("int").alias("xml_index"), problem.alias("problem"), "title", F.md5(F.col("texto").cast("binary")).alias("body_md5"))


@query("SELECT doc_id % 7 AS grp, count(*) AS entries, max(doc_id)::INT AS last FROM documents WHERE doc_id % 11 <> 0 GROUP BY 1")
def q_entry_groups(spark, d):
    """Group and index that entries' file names end in."""
    rows = A.parse_publications(A.zip_entries(_publications(spark, d).mapInArrow(_as_archives, "path string, content binary")))
    return rows.groupBy(F.substring("xml_group", 2, 9).cast("long").alias("grp")).agg(F.count("*").cast("bigint").alias("entries"), F.max("xml_index").alias("last"))
