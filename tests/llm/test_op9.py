import random
import re

from pubmill.llm.op9_hash_thresholds import mix, mix_plan


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_w = sum(weight[s] for s in names if s not in capped)
        share = {s: 3 * sizes[s] if s in capped else weight[s] * rest / open_w for s in names}
        over = {s for s in names if s not in capped and share[s] > 3 * sizes[s]}
        if not over:
            return share
        capped |= over


def made():
    rng = random.Random(5)
    rows = [(i, rng.choice(["src0"] * 6 + ["b", "a", "é", "Z", "tiny", None]), " ".join(["w"] * rng.choice([0, 1, 3, 30, 200]))) for i in range(600)]
    rows += [(700, "tiny", "a b\tc\n"), (701, "none", None), (702, "none", ""), rows[3], rows[3], (None, "a", "x y z")]
    return rows


def test_targets_and_taken(spark):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6).selectExpr("*", "1 as size", "2 as target", "3 as h")
    got = mix_plan(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    share = targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - share[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - share[s]) <= 3 for s in sizes)
    assert sorted(map(str, mix_plan(docs.repartition(3)).collect())) == sorted(map(str, got))


def test_mix_rows(spark):
    docs = spark.createDataFrame(made(), "doc_id long, source string, text string").selectExpr("*", "length(text) as n_chars")
    out = mix(docs)
    assert out.columns == docs.columns
    words = lambda df: sum(len((r.text or "").split()) for r in df.collect())
    assert abs(words(out) - words(docs)) <= 12
    assert mix_plan(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0
