"""Signatures by trees, candidates by keys, and sources by roots, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pubmill.operators import records as R
from pubmill.operators import reports
from pubmill.operators.signature import tree_signature
from pubmill.sources import collection as S

SF = "/root/testdata/sf0.01"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(items, levels):
    held = {}
    for i in items:
        held[sha(i)] = held.get(sha(i), 0) + 1
    nodes = {}
    for d, n in held.items():
        nodes.setdefault(d[:levels], []).append(f"{d}:{n}")
    nodes = {k: sha(",".join(sorted(v))) for k, v in nodes.items()}
    for k in reversed(range(levels)):
        up = {}
        for at, d in nodes.items():
            up.setdefault(at[:k], []).append(at + d)
        nodes = {at: sha("".join(sorted(v))) for at, v in up.items()}
    return nodes[""]


@pytest.mark.parametrize(("leaf", "levels"), [(4096, 1), (20, 2), (1, 3)])
def test_signature_follows_items_alone(spark, leaf, levels):
    items = [str(i % 900) for i in range(1000)]
    df = spark.createDataFrame([(i, "g") for i in items], "item string, g string")
    found = {tree_signature(df.repartition(n).orderBy(F.rand(n)), F.col("item"), "g", leaf=leaf).first().signature for n in (1, 7)}
    assert found == {plain(items, levels)}
    assert tree_signature(df.where("item <> '5'"), F.col("item"), leaf=leaf).first().signature != found.pop()
    assert tree_signature(df.limit(0), F.col("item")).count() == 0


def test_candidates_equal_all_pairs(spark):
    rng = random.Random(3)
    one = lambda: (rng.randrange(3), rng.choice(["a b", "a", "b c", "", None, "A  B", "zz"]), rng.choice(["o1", "o2", "", None]), rng.choice(["1", "2", None]), rng.choice(["f1", "f2", "f3", "", None]), rng.choice(["u1", "u2", None, ""]))
    occ, rec = [(i, *one()) for i in range(120)], [(i, *one()) for i in range(90)]
    columns = "k long, title string, organ string, page string, file string, url string"
    norm = lambda t: " ".join((t or "").lower().split())
    want = set()
    for i, k, *a in occ:
        scores = {}
        for j, m, *b in rec:
            if k == m:
                x, y = norm(a[0]), norm(b[0])
                s = 100 + (0 if not x or not y else 40 if x == y else 20 if x in y or y in x else 0)
                scores[j] = s + sum(p for u, v, p in zip(a[1:], b[1:], (20, 20, 60, 60), strict=True) if u and u == v)
        want |= {(i, j, s) for j, s in scores.items() if s >= max(scores.values()) - 20}
    got = reports.best_candidates(spark.createDataFrame(occ, "occ long, " + columns), spark.createDataFrame(rec, "rec long, " + columns), ["k"])
    assert set(map(tuple, got.collect())) == want


def test_sources_by_roots(spark):
    roots = spark.createDataFrame([(2, "http://a/x/", "folder"), (1, "http://a/x/y", "first"), (3, "http://a", "host"), (4, "http://b/d.pdf/view", "file"), (5, None, "none")], "ord int, root string, source string")
    urls = ["http://a/x", "http://a/x/", "http://a/x/y/z#t", "http://a/xy", "http://a#", "http://b/d.pdf", "http://b/d.pdf/view/", "http://b/D.PDF/view", "http://c", "", None, "http://a/x"]
    got = R.url_sources(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string"), roots).orderBy("i").collect()
    assert [r.source for r in got] == ["folder", "folder", "first", "host", "host", "file", "file", None, None, None, None, "folder"]


def test_catalog_items_that_hold_arrays(spark):
    item = '{"id": "u1", "type": "File", "mime_type": "application/pdf", "title": "a ] b", "review_state": "published", "tags": ["x", "y]"]}'
    html = f'<script>{{"items": [{item}, {item.replace("u1", "u2")}], "items_total": 2}}</script> ] <p>'
    got = S.catalog(spark.createDataFrame([(1, html), (2, '{"items": [{"id": "u1"', ), (3, html.replace("total\": 2", "total\": 3"))], "page long, html string")).collect()
    assert sorted((r.page, r.url or "", r.problem or "") for r in got) == [(1, "u1", ""), (1, "u2", ""), (3, "", "items missing")]
