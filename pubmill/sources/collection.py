"""Collection outcomes, watchlist and process-list scans, catalogs, payloads and file inventories."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.sinks import written

# The editions of a day, and those that a weekday must have.
EDITIONS, REGULAR = ("DO1", "DO2", "DO3", "DO1E", "DO2E", "DO3E"), ("DO1", "DO2", "DO3")
# What the body of a response that is no archive says.
MARKERS = (("signed in", "ABSENT_IN_SESSION"), ("login", "SESSION_OR_SERVICE_ERROR"), ("unavailable", "SESSION_OR_SERVICE_ERROR"))
ZIP_START = bytearray(b"PK\x03\x04")
ZIP_EMPTY = bytearray(b"PK\x05\x06")


def download_outcome(status: Column, content: Column, xml_files: Column) -> Column:
    """What one download of an edition came to, from its HTTP status, its bytes and the XML entries they hold (null if unreadable)."""
    start = F.substring(content, 1, 4)
    archive = (start == F.lit(ZIP_START)) | (start == F.lit(ZIP_EMPTY))
    # text of up to a kilobyte is enough to tell a page from an archive
    body = F.lower(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"))
    out = F.when(status == 404, "ABSENT_404").when(F.coalesce(status, F.lit(0)) != 200, "HTTP_ERROR").when(F.coalesce(archive, F.lit(False)) & xml_files.isNull(), "CORRUPT_ARCHIVE")
    out = out.when(archive & (xml_files > 0), "VALID").when(archive, "VALID_EMPTY")
    for marker, name in MARKERS:
        out = out.when(F.contains(body, F.lit(marker)), name)
    return out.otherwise("UNKNOWN_RESPONSE")


def day_status(outcomes: DataFrame, editions: int = len(EDITIONS)) -> DataFrame:
    """(day, status, valid, missing) of outcomes (day, edition, outcome): any failure is COLLECTION_ERROR, else any archive with entries COLLECTED,
    else NO_PUBLICATIONS where all editions are absent or empty; anything else proves nothing and is an error too."""
    of = lambda *names: F.count_if(F.col("outcome").isin(*names))
    absent = of("ABSENT_404", "ABSENT_IN_SESSION", "VALID_EMPTY")
    counted = outcomes.groupBy("day").agg(
        F.count_if(~F.col("outcome").isin("VALID", "VALID_EMPTY", "ABSENT_404", "ABSENT_IN_SESSION")).alias("failed"),
        of("VALID").alias("valid"),
        absent.alias("absent"),
        F.count_if((F.col("outcome") == "ABSENT_404") & F.col("edition").isin(*REGULAR)).alias("missing"),
    )
    status = F.when(F.col("failed") > 0, "COLLECTION_ERROR").when(F.col("valid") > 0, "COLLECTED").when(F.col("absent") == editions, "NO_PUBLICATIONS").otherwise("COLLECTION_ERROR")
    return counted.select("day", status.alias("status"), "valid", "missing")


def covered(outcomes: DataFrame) -> DataFrame:
    """The guard before a scan: (day, verdict), REJECTED where a regular edition is missing, an edition failed or nothing came."""
    days = day_status(outcomes)
    verdict = F.when((F.col("status") == "COLLECTION_ERROR") | ((F.col("status") == "COLLECTED") & (F.col("missing") > 0)), "REJECTED").when(F.col("status") == "NO_PUBLICATIONS", "EMPTY").otherwise("ACCEPTED")
    return days.select("day", verdict.alias("verdict"))


def single_column(sheet: DataFrame, column: str) -> DataFrame:
    """The distinct normalised values of a sheet's column, in order; blank ones go."""
    return sheet.select(T.normalise(F.col(column)).alias("term")).where("term <> ''").distinct().orderBy("term")


def simple_watchlist(sheet: DataFrame, column: str, categories: DataFrame) -> DataFrame:
    """(term, kind, category) of a one-column sheet; the category is that of least prio in categories (term, category, prio), else 'product'."""
    known = categories.groupBy("term").agg(F.min_by("category", "prio").alias("category"))
    terms = single_column(sheet, column).join(known, "term", "left")
    return terms.select("term", T.term_type(F.col("term")).alias("kind"), F.coalesce("category", F.lit("product")).alias("category"))


def legacy_watchlist(monographs: DataFrame, code: str, processes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(term, origin): monograph names without their leading code, and the values of several text columns; each term once, monographs first."""
    name = F.regexp_replace(F.trim(code), "^[A-Za-z]?[0-9]+\\s*[-–—]\\s*", "")
    rows = monographs.select(T.normalise(name).alias("term"), F.lit("monograph").alias("origin"))
    cells = F.explode(F.array(*(F.struct(T.normalise(F.col(c)).alias("term"), F.lit(c).alias("origin")) for c in columns)))
    every = rows.unionByName(processes.select(cells.alias("x")).select("x.*")).where("term <> ''")
    rank = F.when(F.col("origin") == "monograph", 0).otherwise(F.array_position(F.lit(list(columns)), F.col("origin")))
    return every.groupBy("term").agg(F.min_by("origin", rank).alias("origin"))


def process_list(sheet: DataFrame, column: str, ord_: str) -> tuple[DataFrame, DataFrame]:
    """(process, shown, ord) of the valid 17-digit numbers, each once, and the invalid rows (ord, value); blank cells are neither."""
    rows = sheet.where(F.trim(F.col(column)) != "").select(F.col(ord_).alias("ord"), F.col(column).alias("value"), T.digits(F.col(column)).alias("process"))
    good = rows.where(F.length("process") == 17).groupBy("process").agg(F.min("ord").alias("ord"))
    return good.select("process", T.process_number(F.col("process")).alias("shown"), "ord"), rows.where(F.length("process") != 17).select("ord", "value")


CATALOG = "array<struct<id:string,type:string,mime_type:string,title:string,review_state:string>>"


def catalog(pages: DataFrame) -> DataFrame:
    """(page, url, title, problem) of pages (page, html) that embed a catalog: an array ``items`` beside its ``items_total``.

    Published PDF files come once for each address; where the items do not add up to
    the total, or a page states totals that differ, the page gives one row with a problem.
    """
    # the parser stops where the array ends, whatever brackets its items hold
    raw = F.regexp_extract("html", r'(?s)"items"\s*:\s*(\[.*)', 1)
    totals = F.array_distinct(F.regexp_extract_all("html", F.lit(r'"items_total"\s*:\s*([0-9]+)'), F.lit(1)))
    read = pages.select("page", F.from_json(F.when(raw != "", raw), CATALOG).alias("items"), totals.alias("totals")).where("size(totals) > 0")
    wrong = F.when(F.col("items").isNull(), "no items").when(F.size("totals") > 1, "totals differ").when(F.size("items") != F.col("totals")[0].cast("int"), "items missing")
    held = F.filter("items", lambda x: (x["type"] == "File") & (x["mime_type"] == "application/pdf") & (x["review_state"] == "published"))
    read = read.select("page", wrong.alias("problem"), F.when(wrong.isNull(), held).alias("held"))
    rows = read.select("page", "problem", F.explode_outer("held").alias("x")).where("problem is not null or x is not null")
    return rows.groupBy("page", F.col("x.id").alias("url"), "problem").agg(F.min("x.title").alias("title")).select("page", "url", "title", "problem")


_TITLE, _BODY = {"title", "name", "abstract"}, {"text", "full_text", "content", "summary", "description"}
_ORIGIN = {"organ", "source", "url", "link", "published"}
#: Containers within containers that a payload may have.
DEPTH = 50


def publications_within(value, depth: int = 0) -> Iterator[dict]:
    """Every object, at any place, that has a title and a text or an origin."""
    if depth > DEPTH:
        raise ValueError(f"nested deeper than {DEPTH}")
    if isinstance(value, dict):
        keys = value.keys()
        if keys & _TITLE and keys & (_BODY | _ORIGIN):
            yield value
        value = value.values()
    elif not isinstance(value, list):
        return
    for inner in value:
        if isinstance(inner, (dict, list)):
            yield from publications_within(inner, depth + 1)


def json_depth(text: Column) -> Column:
    """How deep a JSON text's containers nest, from its brackets outside strings; one pass."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    outside = F.array_join(F.filter(F.split(plain, '"'), lambda p, i: i % 2 == 0), "")
    marks = F.split(F.regexp_replace(outside, r"[^\[\]{}]+", ""), "")
    step = lambda x: F.when(x.isin("[", "{"), 1).when(x.isin("]", "}"), -1).otherwise(0)
    grown = lambda at, x: F.struct((at["d"] + step(x)).alias("d"), F.greatest(at["most"], at["d"] + step(x)).alias("most"))
    return F.aggregate(marks, F.struct(F.lit(0).alias("d"), F.lit(0).alias("most")), grown, lambda at: at["most"])


def payload_scan(payloads: DataFrame) -> DataFrame:
    """(key, place, publication as JSON, error) of payloads (key, json): what looks like a publication anywhere in each.

    place counts them from the outside in and from first to last, the fields of an object by
    name. Each level of nesting is one explode of VARIANT values, as many as the deepest payload has. A payload that is no JSON (or
    names a field twice), or nested deeper than DEPTH, gives one row with an error; null gives none.
    """
    spark = payloads.sparkSession
    read = payloads.select(F.col("key").cast("long").alias("key"), F.col("json").alias("__json")).where("__json is not null")
    read = T.once(read.withColumn("__id", F.monotonically_increasing_id()), __depth=json_depth(F.col("__json")))
    deep = F.col("__depth") > DEPTH + 1
    read = written(read.select("key", "__id", "__depth", F.try_parse_json(F.when(~deep, F.col("__json"))).alias("__v")), "payloads")  # parsed once
    wrong = F.when(deep, "ValueError").when(F.col("__v").isNull(), "JSONDecodeError")
    levels = min(DEPTH + 1, read.agg(F.coalesce(F.max(F.when(~deep, F.col("__depth"))), F.lit(0))).first()[0])
    held = lambda names: reduce(lambda a, b: a | b, (F.try_variant_get("__v", f"$.{n}", "variant").isNotNull() for n in sorted(names)))
    alike = F.coalesce(held(_TITLE) & held(_BODY | _ORIGIN), F.lit(False))
    none, text = F.lit(None).cast("variant"), F.lit(None).cast("string")
    one = lambda publication, v: F.struct(publication.alias("publication"), v.alias("v"))
    rows = read.where(wrong.isNull()).select("key", "__id", F.array().cast("array<int>").alias("path"), text.alias("publication"), "__v")
    for _ in range(levels):
        # a publication is set aside, and its parts are looked at as well
        parts = F.when(F.col("publication").isNotNull(), F.array(one(F.col("publication"), none))).when(alike, F.array(one(F.to_json("__v"), none), one(text, F.col("__v")))).otherwise(F.array(one(text, F.col("__v"))))
        rows = rows.select(F.col("key").alias("__key"), "__id", "path", F.inline(parts)).withColumnRenamed("v", "__v")
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("__v").outer()))
        path = F.when(F.col("pos").isNotNull(), F.concat("path", F.array("pos"))).otherwise(F.col("path"))
        rows = rows.select(F.col("__key").alias("key"), "__id", path.alias("path"), "publication", F.col("value").alias("__v")).where("publication is not null or __v is not null")
    place = F.row_number().over(W.partitionBy("__id").orderBy("path")) - 1
    found = rows.where("publication is not null").select("key", place.cast("long").alias("place"), "publication", text.alias("error"))
    return found.unionByName(read.where(wrong.isNotNull()).select("key", F.lit(None).cast("long").alias("place"), text.alias("publication"), wrong.alias("error")))


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, bytes, modified, kind, records) of the files under a path; records of a JSON file are its items, or those of its first list."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    text = F.decode("content", "UTF-8")
    name = F.element_at(F.split("path", "/"), -1)
    whole = F.try_parse_json(F.when(F.endswith(name, F.lit(".json")), text))
    size = F.coalesce(F.json_array_length(text), F.json_array_length(F.get_json_object(text, "$.publications")), F.json_array_length(F.get_json_object(text, "$.records")))
    kind = F.when(~F.endswith(name, F.lit(".json")), "OTHER").when(whole.isNull(), "INVALID").otherwise("JSON")
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), kind.alias("kind"), F.when(kind == "JSON", size).cast("long").alias("records"))


def with_text(pubs: DataFrame) -> DataFrame:
    """Publications whose text is not blank."""
    return pubs.where(F.trim(F.coalesce("text", F.lit(""))) != "")


def source_summary(pubs: DataFrame, *keys: str) -> DataFrame:
    """Of publications (keys, text, url, acts, continued): those with text, with and without address, with several acts, continued."""
    k = lambda c: F.count_if(c).cast("bigint")
    filled = F.coalesce(F.trim("url"), F.lit("")) != ""
    return with_text(pubs).groupBy(*keys).agg(F.count("*").alias("n_pubs"), k(filled).alias("with_url"), k(~filled).alias("without_url"), k(F.col("acts") > 1).alias("several_acts"), k(F.col("continued")).alias("continued"))
