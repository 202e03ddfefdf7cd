import itertools
import random

import pytest

from pubmill.llm.op5_prefix_tree_join import PrefixTree, ngram_components


def words(text):
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def brute(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def made(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, base = [], []
    for d in range(n):
        if base and rng.random() < 0.6:
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                at = rng.randrange(len(w) or 1)
                w = w or ["y"]
                w[at : at + 1] = [[], [rng.choice(vocab)], [rng.choice(vocab), w[at]]][rng.randrange(3)]
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 8, 20, 60, 150, 400]))]
            if rng.random() < 0.4:
                w += passage
        base.append(w or ["x"])
        rows.append((d, "  ".join(w)))
    return rows


@pytest.mark.parametrize(("k", "num", "block"), [(4, 85, 1024), (5, 80, 4), (3, 60, 8), (2, 40, 4096)])
def test_components_equal_brute_force(spark, monkeypatch, k, num, block):
    monkeypatch.setattr("pubmill.llm.op5_prefix_tree_join.BLOCK", block)
    rows = made(k, 260) + [(None, "a lone null id text of some words here"), (7000, None), (7001, ""), (7002, " \t\n"), (7003, "ONE"), (7004, "one"), (7005, "École é"), (7005, "École é"), (7006, "école é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("doc_id", "text", "1 as n_shingles", "2 as row", "3 as a", "4 as comp")
    got = ngram_components(docs, k=k, num=num).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k, num, 100)
    assert len({(r.component_id, r.doc_id) for r in got if r.keeper and r.n_shingles}) == len({r.component_id for r in got if r.n_shingles})


def test_linked_sets_share_a_prefix_shingle():
    import numpy as np

    from pubmill.llm.op5_prefix_tree_join import prefix

    rng = np.random.default_rng(2)
    rarity = rng.integers(0, 6, 3000)
    for num in (60, 80, 85, 100):
        for _ in range(300):
            base = np.unique(rng.integers(0, 3000, rng.integers(1, 60)).astype(np.uint64))
            other = np.unique(np.where(rng.random(len(base)) < 0.1, rng.integers(0, 3000, len(base)).astype(np.uint64), base))
            if 100 * len(np.intersect1d(base, other)) >= num * len(np.union1d(base, other)):
                a, b = (h[prefix(h, rarity[h.astype(int)], num, 100)] for h in (base, other))
                assert len(np.intersect1d(a, b))


def test_components_of_a_hub(spark):
    from pubmill.llm.links import connected

    rows = [(5_000_000, i) for i in range(3000)] + [(i, i + 1_000_000) for i in range(0, 3000, 3)] + [(7, 7), (9_000_001, 9_000_002), (9_000_002, 9_000_003)]
    got = {r.node: r.comp for r in connected(spark.createDataFrame(rows, "a long, b long").repartition(9)).collect()}
    assert {n for n, c in got.items() if c == 9_000_001} == {9_000_001, 9_000_002, 9_000_003}
    assert len(got) == 1 + 3000 + 1000 + 3 and set(got.values()) == {0, 9_000_001}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_equals_plain_comparison():
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 2000, 80).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(80) < rng.choice([0.02, 0.1, 0.3]), rng.integers(0, 2000, 80).astype(np.uint64), base)) for _ in range(300)] + [np.unique(base), np.unique(base[:70])]
    probe = np.unique(base)
    want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 85 * len(np.union1d(s, probe))]
    assert PrefixTree(sets).links(probe, 85, 100).tolist() == want and len(want) > 3


def test_bitmaps_keep_every_link():
    import numpy as np

    from pubmill.llm.op5_prefix_tree_join import bitmap, may_link

    rng, kept = np.random.default_rng(3), 0
    for num in (40, 80, 85):
        for size in (1, 5, 127, 129, 700):
            for share in (0, 0.05, 0.1, 0.3, 1):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
                b = np.unique(np.r_[np.where(rng.random(len(a)) < share, rng.integers(0, 2**63, len(a)).astype(np.uint64), a), rng.integers(0, 2**63, rng.integers(0, 1 + size // 6)).astype(np.uint64)])
                links = 100 * len(np.intersect1d(a, b)) >= num * len(np.union1d(a, b))
                found = may_link(len(a), bitmap(a), len(b), bitmap(b), num, 100)
                assert found or not links
                kept += found and share == 1 and size > 5
    assert kept == 0


def test_texts_that_share_a_passage_by_chance_form_no_cluster(spark, monkeypatch):
    import random

    import pubmill.llm.op5_prefix_tree_join as op5

    rng, dealt, whole = random.Random(5), [], op5._dealt
    monkeypatch.setattr(op5, "_dealt", lambda nodes, *a: dealt.append(nodes.count()) or whole(nodes, *a))
    pieces = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(61)]
    rows = [(i, f"{pieces[i]} {pieces[i + 1]}") for i in range(60)] + [(100, f"{pieces[7]} {pieces[8]} more")]
    got = {r.doc_id: r.component_id for r in ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got == {d: 7 if d == 100 else d for d, _ in rows}
    assert dealt == [2]


def test_keys_of_few_and_of_many():
    import numpy as np

    from pubmill.llm.op5_prefix_tree_join import _meet, _starred

    # key 1: ids 1 to 3; key 2: 20 ids in one batch; key 3: 5 ids in each of two batches, one of them in both
    key = lambda k: np.uint64(k << 40)
    batches = []
    for ids, held in (([3, 1, *range(100, 120), *range(200, 205)], [1, 1, *[2] * 20, *[3] * 5]), ([2, 204, 205, 206, 207, 208], [1, *[3] * 5])):
        batches += _starred([np.array([key(k), key(k)]) for k in held], ids, 1)
    pairs = {n: set() for n in (-1, -2)}
    for batch in _meet(iter(batches)):
        for n, a, b in zip(*(batch[c].to_pylist() for c in ("n", "a", "b")), strict=True):
            pairs[n].add((a, b))
    assert pairs[-1] == {(1, 2), (1, 3), (2, 3)}
    assert pairs[-2] == {(100, i) for i in range(101, 120)} | {(200, i) for i in range(201, 209)}


def test_no_shuffle_files_stay(spark):
    from pubmill.llm.common import CLEANUP, materialize

    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}

    before = held()
    materialize(spark.range(1000).repartition(5).groupBy("id").count(), "test")
    assert not held() - before and spark.conf.get(CLEANUP) == "false"
    spark.range(1000).repartition(5).groupBy("id").count().collect()
    assert held() - before


def test_a_table_of_bits_holds_its_keys(spark):
    from pyspark.sql import functions as F

    from pubmill.llm.sketch import may_hold

    rows = spark.range(20_000).select(F.xxhash64("id").alias("row"), "id")
    test = may_hold(rows.where("id % 20 = 0").select("row"))
    passed = {r.id for r in rows.where(test(F.col("row"))).collect()}
    assert set(range(0, 20_000, 20)) <= passed and len(passed) < 3000
    assert rows.where(may_hold(rows.limit(0).select("row"))(F.col("row"))).count() == 0
