import numpy as np
import pyarrow.parquet as pq

from pubmill.llm.op11_jacobi_whitening import jacobi_svd, op11_jacobi_whitening, whiten

SF = "/root/testdata/sf0.1"


def plain(vectors):
    """n, exact sums, deviations, and components, variances by LAPACK, of whole vectors."""
    fit = sorted(set(map(tuple, vectors)))
    n, x = len(fit), np.array(fit, object)
    s = x.sum(0)
    e, v = np.linalg.eigh(np.cov(x.astype(float).T, bias=True).reshape(x.shape[1], -1))
    return n, s, [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in vectors], v[:, ::-1], e[::-1]


def held(rows, vectors, ids, k=4, tolerance=1e-6):
    n, s, deviations, v, e = plain(vectors)
    k = min(k, len(s))
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(set(ids)) and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    signs = np.zeros(k)
    for i, x, d in zip(ids, vectors, deviations, strict=True):
        want = (np.array(x, float) - np.array(s, float) / n) @ v[:, :k] / np.sqrt(e[:k])
        mine = np.array([got[i][c].whitened for c in range(1, k + 1)])
        assert all(got[i][c].deviation == d and got[i][c].n == n for c in got[i])
        if not signs.all():
            signs = np.where(mine * want < 0, -1, 1)
        assert np.allclose(mine, signs * want, atol=tolerance), (i, mine, want)
    one = got[ids[0]]
    assert np.allclose([one[c].explained for c in sorted(one)], e[:k] / e.sum(), rtol=1e-4)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error <= 1e-4


def test_query_against_a_plain_version(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids = t["vec_id"].to_pylist()
    x = [[int(c) for c in np.floor(256 * np.array(v, float))] for v in t["embedding"].to_pylist()]
    rows = op11_jacobi_whitening(spark, SF).collect()
    held(rows, x, ids)
    assert rows[0].identity_error < 1e-9


def test_svd():
    rng = np.random.default_rng(3)
    for shape in ((64, 64), (7, 7), (5, 5), (3, 6), (1, 1), (40, 9)):
        a = rng.normal(size=shape) * np.logspace(0, -9, shape[1])
        v, values = jacobi_svd(a)
        assert np.allclose(v.T @ v, np.eye(shape[1]), atol=1e-12)
        want = np.linalg.svd(a, compute_uv=False)
        assert np.allclose(values[: len(want)], want, rtol=1e-6, atol=1e-15)
        # columns scaled down by nine digits keep their own digits
        assert np.allclose(np.abs((a @ v)).max(0)[values == 0], 0, atol=1e-14)


def test_small_deviations_keep_their_digits():
    """A graded matrix whose covariance would lose the small ones altogether."""
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(30, 6)))[0]
    scale = 10.0 ** -np.arange(0, 18, 3)
    v, values = jacobi_svd(q * scale)
    assert np.allclose(values, scale, rtol=1e-12)


def test_cases(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(0)
    good = [[float(c) for c in v] for v in rng.normal(size=(40, 3))] + [[1.0, -0.0, 0.25]] * 5
    rows = [(i, v, "a") for i, v in enumerate(good)]
    bad = [(90, None, "a"), (91, [], "a"), (92, [1.0, nan, 0.0], None), (93, [inf, 0.0, 0.0], "a"), (94, [None, 1.0, 1.0], "a"), (95, [1.0, 2.0], "a")]
    table = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, label string").selectExpr("*", "1 as x", "2 as n", "3 as w").repartition(7)
    got = whiten(table).collect()
    held(got, [[int(np.floor(256 * c)) for c in v] for v in good], list(range(45)))
    assert got[0].n == 41
    assert whiten(table.limit(0)).count() == 0
    # one row a task or none, and null ids, each kept
    nulls = whiten(table.withColumn("vec_id", table.vec_id * None).repartition(80))
    assert nulls.count() == 45 * 3 and nulls.where("vec_id is null").count() == 45 * 3


def test_without_variance(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = whiten(table).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whiten(line).collect()
    first = [r for r in got if r.component == 1]
    assert abs(sum(r.whitened for r in first)) < 1e-9 and abs(sum(r.whitened**2 for r in first) / 9 - 1) < 1e-9 and abs(first[0].explained - 1) < 1e-12
    assert all(r.whitened is None and r.explained == 0 for r in got if r.component > 1)


def test_entries_of_any_finite_size(spark):
    vectors = [[1e300, 0.0], [-1e300, 1.0], [5e15, 2.0], [0.0, 3.0]]
    got = whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    most = 2**63 - 1
    x = [[most, 0], [-most - 1, 256], [int(5e15) * 256, 512], [0, 768]]
    s = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((4 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(x)}
    for r in got:
        assert r.deviation == (want[r.vec_id] if want[r.vec_id] < 2**63 else None)
        assert r.deviation_wide == (want[r.vec_id] if want[r.vec_id] < 10**38 else None)
