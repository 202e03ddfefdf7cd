"""Fuzzy titles against brute force, for lists without a limit."""

import difflib
import random

import pytest

from pubmill.functions import text as T
from pubmill.operators import records as R
from pubmill.operators.titles import shared_least

SF = "/root/testdata/sf0.01"


def brute(records, asked, least):
    want = {}
    for k, b in asked:
        m = difflib.SequenceMatcher(None, "", b)
        best = None
        for i, a in records:
            if not a or not b:
                continue
            s = 0.99 if b in a else 0.95 if a in b else 0.0
            m.set_seq1(a)
            if m.real_quick_ratio() >= least:
                s = max(s, m.ratio())
            if s >= least and (best is None or (-s, i) < best):
                best = (-s, i)
        if best:
            want[k] = (best[1], round(-best[0], 9))
    return want


def some_titles(rng, n):
    words = ["portaria", "no", "resolucao", "da", "anvisa", "rdc", "altera", "dispoe", "sobre", "a", "o", "de", "2024", *(str(i) for i in range(40)), "agua", "saude"]
    return [" ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 4, 8, 12]))) for _ in range(n)]


def spoilt(rng, t):
    t = list(t)
    for _ in range(rng.choice([0, 1, 2, 5])):
        at = rng.randrange(len(t) + 1)
        t[at : at + rng.choice([0, 1])] = rng.choice(["", "x", " ", "q7"])
    return " ".join("".join(t).split())


@pytest.mark.parametrize("least", [0.82, 0.95, 0.6])
def test_equal_brute_force(spark, least):
    rng = random.Random(7)
    titles = some_titles(rng, 250) + ["a", "ab", "abc", "x y", "the same " * 30, "the same " * 30 + "end"]
    asked = [spoilt(rng, rng.choice(titles)) for _ in range(150)] + ["", "a", "b", "ab", "zz", "the same " * 29 + "and more", "y"]
    titles, asked = [" ".join(t.split()) for t in titles], [" ".join(t.split()) for t in asked]
    want = brute(list(enumerate(titles)), list(enumerate(asked)), least)
    records = spark.createDataFrame(list(enumerate(titles)), "id long, title string").repartition(4)
    got = R.fuzzy_titles(records, spark.createDataFrame(list(enumerate(asked)), "key long, title string"), least)
    assert {r.key: (r.id, round(r.score, 9)) for r in got.collect()} == want and len(want) > 50


def test_a_thousand_whole_titles(spark):
    """Every first line of the documents, whole, against itself spoilt: more titles than any list was allowed before."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", T.normalise(T.first_line(docs["text"], None)).alias("t")).collect()
    rng = random.Random(3)
    titles = [(r.doc_id, r.t) for r in rows if len(r.t) <= 400]
    asked = [(k, spoilt(rng, t)) for k, t in titles][:1000]
    got = R.fuzzy_titles(spark.createDataFrame(titles, "id long, title string"), spark.createDataFrame(asked, "key long, title string"))
    found = {r.key: (r.id, round(r.score, 9)) for r in got.collect()}
    some = rng.sample(asked, 60)
    want = brute(titles, some, 0.82)
    assert {k: found[k] for k, _ in some if k in found} == want and len(found) > 600


def test_bound_on_shared_grams():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 14)))
        b = spoilt(rng, a) or "a"
        r = difflib.SequenceMatcher(None, a, b).ratio()
        for q in (1, 2):
            grams = lambda t: [t[i : i + q] for i in range(len(t) - q + 1)]  # noqa: E731, B023
            x, y = grams(a), grams(b)
            assert sum(min(x.count(g), y.count(g)) for g in set(x)) >= shared_least(len(a), len(b), r, q)


def test_nulls_and_empty_tables(spark):
    none = spark.createDataFrame([], "id long, title string")
    asked = spark.createDataFrame([(1, "abc"), (None, "abc"), (2, None)], "key long, title string")
    assert R.fuzzy_titles(none, asked).count() == 0
    records = spark.createDataFrame([(4, "abc"), (3, "ABC!"), (None, "abc"), (5, None)], "id long, title string")
    assert [tuple(r) for r in R.fuzzy_titles(records, asked).collect()] == [(1, 3, 1.0)]


def test_contained_titles_of_a_short_list_write_no_grams(spark, monkeypatch):
    """What one title holds of the other is found without grams of the records, and is what plain Python finds."""
    import random

    from pubmill.operators import titles

    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice(("ab", "cd", "abcdefgh", "x", "longer")) for _ in range(n))
    records = [(i, some(rng.choice((1, 2, 3, 5, 12)))) for i in range(300)]
    asked = [(i, some(rng.choice((3, 4, 6)))) for i in range(40)]
    left, right = (spark.createDataFrame(rows, "id long, title string") for rows in (records, asked))
    want = {(i, j) for i, a in records for j, b in asked if a in b or b in a}
    assert set(map(tuple, titles.contained_in_few(left, right).collect())) == want and len(want) > 100
    monkeypatch.setattr(titles, "_pieces", None)
    assert titles.fuzzy_titles(left, right.withColumnRenamed("id", "key")).count() > 0
