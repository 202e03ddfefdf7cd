"""Postings against the one-pass forms and plain Python: long lists, pairs, ids and hybrid terms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import matching as M
from pubmill.operators import postings as P

SF = "/root/testdata/sf0.01"


def pubs_of(spark, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return M.publications(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5))


def some_texts(seed, n=250):
    rng = random.Random(seed)
    words = ["the", "of", *(f"w{i}" for i in range(60)), "abc", "abcd", "xabcx", "17", "500", "a1", "é", "Ção"]
    return [" ".join(rng.choice(words if rng.random() < 0.6 else words[:3]) for _ in range(rng.choice([0, 1, 5, 40]))) for _ in range(n)] + [None, "", "the of the", "the of the"]


@pytest.mark.parametrize("small", [True, False])
def test_long_lists_agree_with_one_pass(spark, small, monkeypatch):
    monkeypatch.setattr(P, "HOT", 10_000)  # nearly every token is salted
    texts = some_texts(1)
    terms = ["the", "of the", "the of the", "w1 w2", "abc", "abcd abc", "no such", "w3", "17", "w4 no", "c", "", *(f"w{i} the" for i in range(30))]
    rows = [(i + 1, t, "even" if i % 2 else "odd") for i, t in enumerate(terms)]
    pubs, listed = pubs_of(spark, texts), spark.createDataFrame(rows, "ord int, term string, category string")
    want = sorted(map(tuple, M.match(pubs, listed).collect()))
    got = sorted(map(tuple, P.term_matches(pubs, listed, small).collect()))
    assert got == want and len(want) > 200
    one = sorted((r.doc_id, tuple(map(tuple, r.hits))) for r in M.with_hits(pubs, listed).collect())
    assert sorted((r.doc_id, tuple(map(tuple, r.hits))) for r in M.with_hits(pubs, listed, 10**6).collect()) == one


def test_a_hundred_thousand_terms(spark):
    """Every second word pair of the texts and many that are nowhere: no nested loop, and the pairs that a plain scan finds."""
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(300).collect()]
    pubs = pubs_of(spark, texts)
    norms = {r.doc_id: r.norm.split(" ") for r in pubs.select("doc_id", "norm").collect()}
    pairs = sorted({f"{a} {b}" for ws in norms.values() for a, b in itertools.pairwise(ws)})[::2][:50_000]
    terms = [*pairs, *(f"nowhere{i} {p}" for i, p in enumerate(pairs))]
    listed = spark.createDataFrame([(i, t, "x") for i, t in enumerate(terms)], "ord int, term string, category string")
    found = P.term_matches(pubs, listed)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    wanted = set(pairs)
    want = {(d, p) for d, ws in norms.items() for p in (f"{a} {b}" for a, b in itertools.pairwise(ws)) if p in wanted}
    assert {(r.doc_id, r.term) for r in found.collect()} == want and len(want) > 10_000


def test_facet_bitmaps(spark):
    matches = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "b", "z"), (2, 1, "a", "y"), (3, 1, "q", "other")], "doc_id long, ord int, term string, category string")
    facets = ("x", "y", "z")
    bits = {r.doc_id: r.facets for r in P.facet_bitmaps(matches, facets).collect()}
    assert bits == {1: 5, 2: 2}
    rows = spark.createDataFrame([(5,), (2,), (None,)], "b long")
    got = [tuple(r) for r in rows.select(P.in_facets(F.col("b"), facets, ("x", "z")), P.in_facets(F.col("b"), facets, (), ("y",))).collect()]
    assert got == [(True, True), (False, False), (False, True)]
    with pytest.raises(ValueError):
        P.facet_bitmaps(matches, [str(i) for i in range(64)])


def test_near_pairs_equal_plain(spark):
    texts = some_texts(3)
    pubs = pubs_of(spark, texts)
    rows = [(1, ["the", "w1"]), (2, ["w2", "w3", "w4"]), (3, ["abc"]), (4, ["w5", "none"]), (5, ["w7", "w8", "w7"])]
    terms = spark.createDataFrame(rows, "ord int, tokens array<string>")
    want = set()
    for r in pubs.select("doc_id", "norm").collect():
        ts = r.norm.split(" ")
        for k, tokens in rows:
            need = set(tokens)
            if any(t in need and need <= set(ts[max(0, i - 3) : i + 4]) for i, t in enumerate(ts)):
                want.add((r.doc_id, k))
    assert set(map(tuple, P.near_matches(pubs, terms, 3).collect())) == want and len(want) > 20
    for k, tokens in rows:
        if len(set(tokens)) >= 2:
            one = pubs.where(M.all_near(F.split("norm", " "), F.lit(list(dict.fromkeys(tokens))), 3)).select("doc_id")
            assert {r.doc_id for r in one.collect()} == {d for d, j in want if j == k}
    pair = pubs.where(M.near(F.col("norm"), "the", "w1", 3)).select("doc_id")
    assert {r.doc_id for r in pair.collect()} == {d for d, j in want if j == 1}


def test_hybrid_terms_of_any_number_agree(spark):
    texts = [*some_texts(5), "brilliance x x flumioxazina", "Flumioxazina 500 WP Brilliance", "17 metomil", "metomil", "12 3 45"]
    pubs = pubs_of(spark, texts)
    rows = [(1, "flumioxazina 500 wp brilliance", "hybrid", "product"), (2, "17 metomil", "hybrid", "monograph"), (3, "12345", "number", ""), (4, "17", "number", None), (5, "bc w1", "hybrid", ""), (6, "w2 w3 w4", "hybrid", ""), (7, "no5 no", "hybrid", ""), (8, "a1 the", "hybrid", "monograph"), (9, "500", "hybrid", "monograph"), (10, "abcd xabcx", "hybrid", "product"), (11, "x", "number", ""), (12, "c", "hybrid", "")]
    terms = spark.createDataFrame(rows, "ord int, term string, kind string, origin string")
    one = sorted(map(tuple, M.match_hybrid(pubs, terms).collect()))
    assert sorted(map(tuple, M.match_hybrid(pubs, terms, 10**6).collect())) == one and {r[1] for r in one} >= {1, 2, 3, 4, 5, 6, 8, 9, 10, 12}


def test_five_thousand_hybrid_terms(spark):
    """No limit on the list; what it finds is what the text holds."""
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    pubs = pubs_of(spark, texts)
    norms = {r.doc_id: r.norm for r in pubs.select("doc_id", "norm").collect()}
    rng = random.Random(2)
    words = sorted({w for x in norms.values() for w in x.split(" ") if len(w) > 4})
    rows = [(i, f"{rng.choice(words)[:5]} {rng.choice(words)[1:6]}", "hybrid", "") for i in range(5000)]
    got = set(M.match_hybrid(pubs, spark.createDataFrame(rows, "ord int, term string, kind string, origin string")).select("doc_id", "ord", "how").rdd.map(tuple).collect())
    want = {(d, i, "hybrid") for i, t, _, _ in rows for d, x in norms.items() if all(p in x for p in t.split(" "))}
    assert got == want and len(want) > 3000


def test_ids_of_many_lengths(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("0123456789 -x") for _ in range(rng.choice([0, 3, 30, 400]))) for _ in range(80)] + ["0" * 3000, None]
    pubs = pubs_of(spark, texts)
    digits = {i: "".join(c for c in t or "" if c.isdigit()) for i, t in enumerate(texts)}
    ids = {"0" * 17, "00000", "123456"} | {x[a : a + n] for x in digits.values() if len(x) > 40 for n in (5, 6, 9, 11, 17) for a in (0, 7, len(x) - n)} | {str(rng.randrange(10**16)) for _ in range(200)}
    got = set(map(tuple, M.match_ids(pubs, spark.createDataFrame([(i,) for i in ids], "id string")).collect()))
    assert got == {(k, i) for k, x in digits.items() for i in ids if i in x}


def test_long_texts_cost_in_proportion(spark):
    """Functions written with lambdas on texts of tens of thousands of words."""
    import time

    from pubmill.operators import reports as R
    from pubmill.sources.archive import strip_html

    n = 60_000
    words = " ".join(f"the x{i % 7} w{i}" for i in range(n // 3))
    page = "".join(f"<p class=a>line {i}</p>\n" for i in range(n // 3)) + "<" * n
    df = spark.createDataFrame([(1, words, page, "1" * n)], "doc_id long, norm string, html string, d string")
    fns = {
        "near": M.near(F.col("norm"), "the", "nowhere") | M.near(F.col("norm"), "the", "w7", 1),
        "all_near": M.all_near(F.split("norm", " "), F.lit(["the", "w19999"]), 2),
        "ordered_distinct": F.size(T.ordered_distinct(F.split("norm", " "))),
        "strip_html": F.length(strip_html(F.col("html"))),
        "excerpts": F.size(R.excerpts(F.col("norm"), ["w19999", "x1"])),
    }
    df.select(*fns.values()).collect()
    for name, fn in fns.items():
        began = time.time()
        value = df.select(fn.alias("v")).first().v
        assert time.time() - began < 15, name
        assert value == {"near": True, "all_near": True, "ordered_distinct": n // 3 + 8, "excerpts": 2}.get(name, value), (name, value)
    parts = spark.createDataFrame([("k", i, str(i), "t", "r", f"text {i % 50} " * 20) for i in range(4000)], "key string, ord int, page string, title string, role string, text string")
    began = time.time()
    assert R.merge_parts(parts, "key").first().n_parts == 4000 and time.time() - began < 20


def test_normalisation_is_in_the_plan_once(spark):
    """Of ``match`` and of a filter on what it finds: the optimiser must not write it into each of their conditions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    alone = M.publications(docs).select("doc_id", "norm")
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\\W+")
    assert count(M.match(M.publications(docs), M.watchlist(spark))) <= count(alone)
    assert count(M.scored(docs).where("n_terms > 0 and rank > 3").select("doc_id", "level")) <= count(M.publications(docs))


def test_texts_without_tags_and_open_ones(spark):
    from pubmill.sources.archive import strip_html

    pages = ["a<b>c</b> d", "a < b", "a > b < c > d <e", "<p>x</p>\n\n <p> y </p>", "", None, "<", ">", "x<br/>y\t z\r\n", "<!-- a -->b<script>1<2</script>c", " \n a"]
    got = [r.t for r in spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, p string").orderBy("i").select(strip_html(F.col("p")).alias("t")).collect()]
    assert got == ["a c d", "a < b", "a > b d <e", "x\ny", "", None, "<", ">", "x\ny z", "b c", "a"]


def test_grams_and_ids_of_long_texts(spark):
    """Stretches of a long text cost in proportion to it."""
    import time

    text = "".join(str(i) for i in range(60_000))
    df = spark.createDataFrame([(1, text, text), (2, "12", "12"), (3, "", "")], "doc_id long, text string, norm string")
    began = time.time()
    assert [r.n for r in df.orderBy("doc_id").select(F.size(T.grams(F.col("text"), F.lit(3))).alias("n")).collect()] == [len(text) - 2, 0, 0]
    ids = spark.createDataFrame([("5999959998",), ("12345678910",), ("59998599",)], "id string")
    assert sorted(map(tuple, M.match_ids(df, ids).collect())) == [(1, "12345678910"), (1, "59998599")]
    assert time.time() - began < 30
    row = spark.range(1).select(T.grams(F.lit("abcde"), F.lit(3), F.lit(4)).alias("g"), T.grams(F.lit("ab"), F.lit(3)).alias("none")).first()
    assert (row.g, row.none) == (["abcd", "bcde", "cde"], [])


@pytest.mark.parametrize("small", [True, False])
def test_terms_of_many_lengths(spark, small):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab") for _ in range(60)) for _ in range(40)]
    cut = lambda n: (lambda w, i: " ".join(w[i : i + n]))(rng.choice(texts).split(" "), rng.randrange(60 - n))
    terms = sorted({cut(n) for n in (1, 2, 3, 7, 8, 9, 10, 14, 17, 18, 19, 40) for _ in range(4)} | {"a" + " b" * 30})
    listed = spark.createDataFrame([(i, t, "x") for i, t in enumerate(terms)], "ord int, term string, category string")
    got = {(r.doc_id, r.term) for r in P.term_matches(pubs_of(spark, texts), listed, small).collect()}
    assert got == {(d, t) for d, x in enumerate(texts) for t in terms if f" {t} " in f" {x} "}


def test_little_of_the_texts_meets_a_long_list(spark, monkeypatch):
    """What is kept for the join is what matches and few others, though each of the terms' words is in nearly every text."""
    kept, write = [], P.written
    monkeypatch.setattr(P, "written", lambda df, tag: kept.append((tag, write(df, tag))) or kept[-1][1])
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(300)) for _ in range(200)]
    pairs = [f"w{i} w{j}" for i in range(20) for j in range(10)]
    listed = spark.createDataFrame([(i, t, "x") for i, t in enumerate(pairs)], "ord int, term string, category string")
    found = P.term_matches(pubs_of(spark, texts), listed, False).count()
    assert found <= dict(kept)["places"].count() < found * 1.2


def test_bitmaps_of_a_long_list_agree_with_its_short_form(spark, monkeypatch):
    """The shuffled form, whose kept places are as many as matches of terms."""
    from pubmill.plans import registry

    want = sorted(map(tuple, registry.q_facet_bitmaps(spark, "/root/testdata/sf0.001").collect()))
    kept, write = {}, P.written
    monkeypatch.setattr(P, "written", lambda df, tag: kept.setdefault(tag, write(df, tag)))
    monkeypatch.setattr(P, "ROWS", 0)
    assert sorted(map(tuple, registry.q_facet_bitmaps(spark, "/root/testdata/sf0.001").collect())) == want
    assert kept["places"].count() < 1.2 * registry.q_match_long(spark, "/root/testdata/sf0.001").count()


def test_long_lists_neither_sort_nor_gather_what_they_meet(spark):
    """Where no two texts share an id, places are read against a hashed part of the list, and copies are not looked for."""
    texts = some_texts(3)
    listed = spark.createDataFrame([(i, t, "x") for i, t in enumerate(("the of", "the", "w1 w2", "no such"))], "ord int, term string, category string")
    plan = P.term_matches(pubs_of(spark, texts), listed, False)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "HashAggregate(keys=[doc_id" not in plan
    # with a shared id each term is given once all the same
    pubs = pubs_of(spark, texts)
    twice = P.term_matches(pubs.unionByName(pubs), listed, False)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, M.match(pubs, listed).collect()))


def test_loose_terms_of_a_short_list_shuffle_nothing(spark, monkeypatch):
    """And find what the shuffled form finds, with words remembered or not."""
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(rng.choice([0, 3, 30]))) for _ in range(150)] + [None, "x" * 5000 + "abcab"]
    terms = ["ab c", "abc abc", "cab bca a", "zz a", "", " ", "aabb", "abcab x"]
    pubs, listed = pubs_of(spark, texts), spark.createDataFrame(list(enumerate(terms)), "ord int, term string")
    found = P.loose_matches(pubs, listed, once=False)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().split("InArrow")[0]
    want = sorted((d, i) for d, x in enumerate(texts) for i, t in enumerate(terms) if t.strip() and all(p in (x or "") for p in t.split()))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, P.loose_matches(pubs, listed, False).collect())) == want
    monkeypatch.setattr(P, "WORDS", 2)
    assert sorted(map(tuple, P.loose_matches(pubs.unionByName(pubs), listed).collect())) == want
