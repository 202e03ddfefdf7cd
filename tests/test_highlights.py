import html
import random
import re

from pyspark.sql import functions as F

from pubmill.operators import highlights as H

TERMS = ["abc", "ab", "c a", "B+"]


def texts():
    rng = random.Random(3)
    return [None, "", "ab", "ABCab+", "é<ab> & 'c A'", *("".join(rng.choice("abcABC +<é") for _ in range(rng.choice([5, 40, 300]))) for _ in range(40))]


def found(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [(m.start(), m.end(), t) for t in TERMS for m in re.finditer(re.escape(t.lower()), low)]


def greedy(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (s[0], s[0] - s[1], s[2])):
        if not kept or kept[-1][1] <= s[0]:
            kept.append(s)
    return kept


def uncovered(spans):
    kept = []
    for s in spans:
        if not any(min(k[1], s[1]) - max(k[0], s[0]) >= 0.8 * (s[1] - s[0]) for k in kept):
            kept.append(s)
    return kept


def emphasised(text):
    out = html.escape(text or "")
    for t in sorted(TERMS, key=lambda t: (-len(t), t)):
        out = re.sub(f"({re.escape(html.escape(t))})", r"<strong>\1</strong>", out, flags=re.I | re.A)
    return out


def test_spans_and_emphasis_equal_plain_versions(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "id int, text string").withColumn("spans", H.all_occurrences(F.col("text"), TERMS))
    rows = df.select("text", "spans", H.without_overlaps(F.col("spans")).alias("free"), H.without_covered(F.col("spans")).alias("open"), H.emphasise(F.col("text"), TERMS).alias("html")).collect()
    assert len(rows) == len(texts())
    for r in rows:
        want = found(r.text)
        assert [tuple(s) for s in r.spans] == want
        assert [tuple(s) for s in r.free] == greedy(want)
        assert [tuple(s) for s in r.open] == uncovered(want)
        assert r.html == emphasised(r.text)
    assert any(len(r.free) < len(r.spans) for r in rows) and any(len(r.open) < len(r.spans) for r in rows)
