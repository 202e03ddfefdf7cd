import numpy as np
import pyarrow.parquet as pq

from pubmill.llm.op1_multi_index_hashing import MultiIndex, nearest, op1_multi_index_hashing, usable

SF = "/root/testdata/sf0.1"


def test_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 256, (3000, 8), dtype=np.uint8)
    index = MultiIndex(codes)
    for r in (0, 7, 8, 20, 27, 40, 64):
        distance = np.unpackbits(codes ^ codes[5], axis=1).sum(1)
        assert index.within(codes[5], r).tolist() == np.flatnonzero(distance <= r).tolist()


def test_recall_against_brute_force(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids, x = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in op1_multi_index_hashing(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = unit @ unit[ids == q][0]
        s[ids == q] = -9
        best = set(ids[np.lexsort((ids, -s))[:5]])
        rows = sorted(got[q])
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5] and all(abs(s[ids == v][0] - c) < 1e-9 for _, v, c in rows)
        hits, total = hits + len(best & {v for _, v, _ in rows}), total + 5
    assert hits / total >= 0.95, hits / total


def test_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [-1.0, 0.0]), (10, [1.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as rank")
    vectors = usable(table)
    got = sorted((r["rank"], r.vec_id, round(r.score, 6)) for r in nearest(vectors, vectors.where("vec_id = 0")).collect())
    assert got == [(1, 1, 0.707107), (2, 2, 0.707107), (3, 9, -1.0)]
    none = usable(table.limit(0))
    assert nearest(none, none).count() == 0


def test_components_of_any_finite_size(spark):
    rows = [(0, [1e200, 1e200]), (50, [1e-200, 0.0]), (1, [1e200, 0.0]), (2, [3e-310, 3e-310]), (3, [-1.0, 1.0])]
    vectors = usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in nearest(vectors, vectors.where("vec_id % 50 = 0"), 2).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.707107), (50, 1, 1, 1.0), (50, 2, 0, 0.707107)]


def test_recall_of_close_and_far_neighbours():
    """One block: copies with little and with much noise among unrelated rows, against all cosines."""
    import pandas as pd

    from pubmill.llm.op1_multi_index_hashing import _block, learn

    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64))
    x[3000:4500] = x[:1500] + rng.normal(size=(1500, 64)) * np.linspace(0.01, 1, 1500)[:, None]
    rows = pd.DataFrame({"vec_id": np.arange(6000), "v": list(x)})
    got = _block(rows, rows.iloc[:1500:10], learn(x), 5, 0.25)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q, own in got.groupby("query_id"):
        s = unit @ unit[q]
        s[q] = -9
        hits += len(set(own["vec_id"]) & set(np.argsort(-s)[:5].tolist()))
        if q < 750:
            assert own["vec_id"].iloc[0] == 3000 + q
    assert hits / (5 * 150) >= 0.95


def test_one_vector_and_equal_vectors(spark):
    one = usable(spark.createDataFrame([(50, [1.0, 2.0, 3.0]), (7, None)], "vec_id long, embedding array<double>"))
    assert nearest(one, one.where("vec_id % 50 = 0")).count() == 0
    same = usable(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)] + [(100, [1.0])], "vec_id long, embedding array<double>"))
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest(same, same.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(50, k + 1, k, 1.0) for k in range(5)]


def test_blocks_and_recall_do_not_follow_the_cores(spark, monkeypatch):
    """Over several blocks: recall against all cosines, and the same rows for another number of cores."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(9000, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>").cache()
    queries = vectors.where("vec_id % 50 = 0")
    got = nearest(vectors, queries).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 9000, 50):
        s = unit @ unit[q]
        s[q] = -9
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-s)[:5].tolist()))
    assert hits / 900 >= 0.95
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 3))
    assert sorted(map(tuple, nearest(vectors, queries).collect())) == sorted(map(tuple, got))
    vectors.unpersist()
