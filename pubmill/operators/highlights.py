"""Term occurrences as spans, overlap rules over them, and emphasised text."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,term:string>>"


def all_occurrences(text: Column, terms: list[str]) -> Column:
    """Spans (start, end exclusive, term) of each term, in the order of the terms; ASCII letters in any case; null and empty texts have none."""
    patterns = [(t, re.compile(re.escape(t), re.IGNORECASE | re.ASCII)) for t in terms if t]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string())]))

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        starts, ends, names, sizes = [], [], [], [0]
        for text in texts:
            for t, pattern in patterns:
                at = [m.start() for m in pattern.finditer(text.as_py() or "")]
                starts += at
                ends += [i + len(t) for i in at]
                names += [t] * len(at)
            sizes.append(len(starts))
        spans = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(names, pa.string())], ["start", "end", "term"])
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans).cast(kind)

    return find(text) if patterns else F.array().cast(SPANS)


def occurrences(text: Column, term: str) -> Column:
    return all_occurrences(text, [term])


def without_overlaps(spans: Column) -> Column:
    """By start, of several at one start the longest: each span that begins at or after the last kept one's end."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (s["start"] - s["end"]).alias("less"), s["term"].alias("term"), s["end"].alias("end"))))
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["term"].alias("term"))
    free = lambda kept, s: F.coalesce(F.try_element_at(kept, F.lit(-1))["end"], F.lit(0)) <= s["start"]
    return F.aggregate(ranked, F.array().cast(SPANS), lambda kept, s: F.when(free(kept, s), F.concat(kept, F.array(plain(s)).cast(SPANS))).otherwise(kept))


def without_covered(spans: Column, share: float = 0.8) -> Column:
    """In the order given: each span of which no kept one covers ``share`` of the length or more."""
    overlap = lambda a, b: F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])
    covered = lambda kept, s: F.exists(kept, lambda x: overlap(x, s) >= (s["end"] - s["start"]) * F.lit(share))
    return F.aggregate(spans, F.array().cast(SPANS), lambda kept, s: F.when(covered(kept, s), kept).otherwise(F.concat(kept, F.array(s).cast(SPANS))))


def escape_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain in "&<>\"'":
        out = F.replace(out, F.lit(plain), F.lit(html.escape(plain)))
    return out


def emphasise(text: Column, terms: list[str]) -> Column:
    """The escaped text with each term in <strong>, the longest terms first; a shorter term inside a longer one nests."""
    out = escape_html(text)
    for term in sorted(terms, key=lambda t: (-len(t), t)):
        out = F.regexp_replace(out, f"(?i)({re.escape(html.escape(term))})", "<strong>$1</strong>")
    return out
