"""Report projections: confidence of matches, audit lists, candidates, excerpts, merged parts, digests, bulletin rows and pages."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import highlights as H

#: Spans that a task gathers before it gives them on.
SPANS_HELD = 100_000


def match_confidence(kind: Column, term: Column) -> Column:
    """HIGH for direct and process matches; numbers by their digits; hybrids by tokens of one or two characters."""
    tokens = F.split(T.normalise(term), " ")
    short = F.exists(tokens, lambda t: F.length(t).between(1, 2))
    number = F.when(F.length(T.digits(term)) >= 6, "MEDIUM").otherwise("LOW")
    hybrid = F.when(short & (F.size(tokens) >= 3), "CRITICAL").when(short, "LOW").otherwise("MEDIUM")
    return F.when(kind.isin("direct", "process"), "HIGH").when(kind == "number", number).when(kind.isin("hybrid", "text"), hybrid).otherwise("MEDIUM")


def suspect(kind: Column, confidence: Column) -> Column:
    """Short numbers, and hybrids of short tokens."""
    return kind.isin("number", "hybrid", "text") & confidence.isin("LOW", "CRITICAL")


def publication_confidence(matches: DataFrame, key: str) -> DataFrame:
    """(key, confidence, n_suspect, verdict) of matches (key, kind, term): critical first, low tempered by high, then medium, then high."""
    c = match_confidence(F.col("kind"), F.col("term"))
    rated = matches.withColumn("c", c).withColumn("suspect", suspect(F.col("kind"), F.col("c")))
    has = lambda level: F.bool_or(F.col("c") == level)
    score = F.when(has("CRITICAL"), "CRITICAL").when(has("LOW") & has("HIGH"), "MEDIUM").when(has("LOW"), "LOW").when(has("MEDIUM"), "MEDIUM").otherwise("HIGH")
    verdict = F.when(F.bool_or("suspect"), "SUSPECT").otherwise("CONFIRMED")
    return rated.groupBy(key).agg(score.alias("confidence"), F.count_if("suspect").cast("long").alias("n_suspect"), verdict.alias("verdict"))


def best_candidates(occurrences: DataFrame, records: DataFrame, on: list[str], margin: int = 20) -> DataFrame:
    """(occ, rec, score) of occurrences and records (on, title, organ, page, file, url): those within ``margin`` of an occurrence's best.

    100, and 40 for an equal title or 20 for a contained one, 20 for the organ, 20 for
    the page, 60 for the file and 60 for the address.

    Strong keys (file, address, equal title) are looked up first, by equi-joins. A pair that shares
    none of them has 160 points at most, so weaker keys (organ, page) are tried only for
    occurrences whose best so far could be equalled within the margin; and a pair that shares none of those either
    has 120, so only what is still open then meets all records of its ``on``. No pair is written that cannot win.
    """
    keys = ("title", "organ", "page", "file", "url")
    norm = lambda df, p: df.select(*on, *(F.col(c).alias(f"{p}{c}") for c in keys), F.nullif(T.normalise(F.col("title")), F.lit("")).alias(f"{p}norm"), "occ" if p else "rec")
    o, r = norm(occurrences, "o_"), norm(records, "")
    same = lambda c: (F.coalesce(f"o_{c}", F.lit("")) != "") & (F.col(f"o_{c}") == F.col(c))
    a, b = F.col("o_norm"), F.col("norm")
    points = F.when(a == b, 40).when(F.contains(a, b) | F.contains(b, a), 20).otherwise(0)
    for c, p in (("organ", 20), ("page", 20), ("file", 60), ("url", 60)):
        points = points + F.when(same(c), p).otherwise(0)

    def by(left: DataFrame, *names: str) -> DataFrame:
        """Scored pairs that share one of the keys."""
        out = None
        for c in names:
            held = left.where(F.coalesce(f"o_{c}", F.lit("")) != "").withColumn("__key", F.col(f"o_{c}"))
            pairs = held.join(r.withColumn("__key", F.col(c)), [*on, "__key"]).select("occ", "rec", (points + 100).cast("long").alias("score"))
            out = pairs if out is None else out.unionByName(pairs)
        return out.distinct()

    def best(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("occ").agg(F.max("score").alias("best"))

    def open_to(found: DataFrame, points_left: int) -> DataFrame:
        """The occurrences for which so many points may still be within the margin."""
        settled = best(found).where(F.col("best") - margin > points_left).select("occ")
        return o.join(settled, "occ", "left_anti")

    strong = by(o, "file", "url", "norm")
    weak = by(open_to(strong, 160), "organ", "page").unionByName(strong).distinct()
    rest = open_to(weak, 120).join(r, on).select("occ", "rec", (points + 100).cast("long").alias("score"))
    scored = weak.unionByName(rest).distinct()
    return scored.join(best(scored), "occ").where(F.col("score") >= F.col("best") - margin).select("occ", "rec", "score")


def excerpts(text: Column, terms: Sequence[str], margin: int = 40, share: float = 0.8) -> Column:
    """(term, start, end) around the first occurrence of each term, in order; one that an earlier covers by ``share`` is left out."""
    found = []
    for t in terms:
        at = F.instr(text, t) - 1
        lo, hi = F.greatest(at - margin, F.lit(0)), F.least(at + len(t) + margin, F.length(text))
        found.append(F.when(at >= 0, F.struct(lo.cast("int").alias("start"), hi.cast("int").alias("end"), F.lit(t).alias("term"))))
    return H.without_covered(F.array_compact(F.array(*found)).cast(H.SPANS), share)


def merge_parts(parts: DataFrame, key: str) -> DataFrame:
    """(key, title, roles, n_parts, text) of parts (key, ord, page, title, role, text).

    The first title that is not blank, the roles in order of first occurrence, and the
    texts by numeric page (others last), each once by its first 3000 normalised
    characters, with a blank line between.
    """
    page = F.coalesce(F.when(F.col("page").rlike("^[0-9]{1,9}$"), F.col("page").cast("int")), F.lit(999_999))
    filled = F.trim("title") != ""
    one = F.struct(page.alias("page"), "ord", "text", F.substring(T.normalise(F.col("text")), 1, 3000).alias("print"))
    role = F.struct("ord", "role")
    g = parts.groupBy(key).agg(F.min_by(F.when(filled, F.col("title")), F.when(filled, F.col("ord"))).alias("title"), F.array_sort(F.collect_list(role)).alias("roles"), F.array_sort(F.collect_list(one)).alias("parts"))
    printed = F.array_sort(F.transform("parts", lambda p, i: F.struct(p["print"].alias("print"), i.alias("i"), p["text"].alias("text"))))
    first = T.let(printed, lambda s: F.filter(s, lambda p, j: (j == 0) | (F.get(s, j - 1)["print"] != p["print"])))
    kept = F.array_sort(F.transform(first, lambda p: F.struct(p["i"].alias("i"), p["text"].alias("text"))))
    return g.select(key, "title", F.array_distinct(F.transform("roles", lambda r: r["role"])).alias("roles"), F.size("parts").cast("long").alias("n_parts"), F.array_join(F.transform(kept, lambda p: p["text"]), "\n\n").alias("text"))


def shown_processes(text: Column) -> Column:
    """Process numbers in a text, as they are shown: punctuated, spaced or bare 17 digits, each once in order."""
    form = r"(?<![0-9])[0-9]{5}[. ]?[0-9]{6}[/ ]?[0-9]{4}[- ]?[0-9]{2}(?![0-9])"
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(form), F.lit(0)), lambda x: T.process_number(T.digits(x))))


def digest(pubs: DataFrame, pages: DataFrame, hidden: Sequence[str]) -> DataFrame:
    """Publications (id, organ, title, own_url, listing_url, terms) and pages (id, title, url) as rows (origin, id, organ, title, url, terms).

    A publication of the gazette shows its listing's address first, another its own; terms come once each, without hidden ones.
    """
    url = F.when(F.col("organ") == "GAZETTE", T.first_filled(F.col("listing_url"), F.col("own_url"))).otherwise(T.first_filled(F.col("own_url"), F.col("listing_url")))
    terms = F.filter(T.ordered_distinct(F.col("terms")), lambda t: ~T.normalise(t).isin(*hidden))
    first = pubs.select(F.lit("publication").alias("origin"), "id", "organ", "title", url.alias("url"), terms.alias("terms"))
    other = pages.select(F.lit("page").alias("origin"), "id", F.lit("").alias("organ"), "title", T.first_filled(F.col("url")).alias("url"), F.array().cast("array<string>").alias("terms"))
    return first.unionByName(other)


def bulletin_row(pubs: DataFrame) -> DataFrame:
    """Rows of a bulletin (id, title, section, relation, level, summary, text) of publications (and discarded); a discarded one says so in all three."""
    out = lambda c: F.when(F.col("discarded"), "DISCARDED").otherwise(F.coalesce(c, F.lit(""))).alias(c)
    return pubs.select("id", T.shorten(T.first_filled(F.col("title")), 200).alias("title"), out("section"), out("relation"), out("level"), T.shorten(T.first_filled(F.col("summary"), F.col("text")), 1000, "trimmed").alias("summary"), T.shorten(F.coalesce("text", F.lit("")), 3000, "within").alias("text"))


def full_page(title: Column, organ: Column, body: Column, terms: list[str]) -> Column:
    """A publication as a page: escaped heading and organ, a paragraph for each line that is not blank, terms emphasised."""
    lines = F.filter(F.split(H.emphasise(body, terms), "\n"), lambda x: F.trim(x) != "")
    paragraphs = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    return F.concat(F.lit("<article><h1>"), H.escape_html(title), F.lit("</h1><h2>"), H.escape_html(organ), F.lit("</h2>"), paragraphs, F.lit("</article>"))


class _Folds(dict):
    """What each character folds to, worked out when it is first met."""

    def __missing__(self, code: int) -> str:
        self[code] = "".join(x for x in unicodedata.normalize("NFKD", chr(code)).lower() if not unicodedata.combining(x))
        return self[code]


_FOLDS = _Folds()


def folds(text: str) -> tuple[str, np.ndarray | None]:
    """The text without accents, in small letters, and for each of its characters the place it comes from; no places where all stay."""
    plain = text.translate(_FOLDS)
    if text.isascii():
        return plain, None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, which = np.unique(codes, return_inverse=True)
    sizes = np.array([len(_FOLDS[int(c)]) for c in kinds])
    return plain, None if (sizes == 1).all() else np.repeat(np.arange(len(codes)), sizes[which])


def folded(text: str) -> tuple[str, list[int]]:
    """``folds`` with every place."""
    plain, place = folds(text)
    return plain, list(range(len(plain))) if place is None else place.tolist()


def flexible_spans(docs: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(doc_id, spans) of documents (doc_id, text): terms as wholes in any case and with any accents, white space or punctuation between their words.

    Offsets are those of the original text. Of overlapping spans the earliest stays, of those that start together the longest.
    """
    patterns = []
    for term in sorted(dict.fromkeys(terms), key=lambda t: (-len(t), t)):
        words = re.findall(r"[a-z0-9]+", folded(term)[0])
        if words:
            patterns.append((term, re.compile(r"(?<![a-z0-9])" + r"[\s\-–—_/.,;:()]*".join(words) + r"(?![a-z0-9])")))

    def find(text: str) -> list[dict]:
        plain, place = folds(text)
        of = (lambda i: i) if place is None else (lambda i: int(place[i]))
        found = sorted((of(m.start()), -(of(m.end() - 1) + 1), t) for t, p in patterns for m in p.finditer(plain))
        kept, end = [], 0
        for a, b, t in found:
            if a >= end:
                kept.append({"start": a, "end": -b, "term": t})
                end = -b
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string())]))
        for batch in batches:
            ids, spans, size = [], [], 0
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids.append(doc)
                spans.append(find(text.as_py() or ""))
                size += len(spans[-1])
                if size > SPANS_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])
                    ids, spans, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans {H.SPANS}")
