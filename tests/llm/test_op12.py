import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from pubmill.llm.op12_heap_lloyd import assign, compress, keys_of, op12_heap_lloyd, scan, violated

SF = "/root/testdata/sf0.1"


def plain(x, entries=256, parts=4, rounds=4):
    """Codes, errors and codebooks of whole vectors in the order of their ids, with Python's integers."""
    width = len(x[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for v in x] for p in range(parts)]
    books = [c[:entries] for c in cut]
    far = lambda v, e: sum((a - b) ** 2 for a, b in zip(v, e, strict=True))
    nearest = lambda v, book: min(range(len(book)), key=lambda k: (far(v, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(v, books[p]) for v in cut[p]]
            held = {}
            for v, k in zip(cut[p], own, strict=True):
                held.setdefault(k, []).append(v)
            books[p] = [tuple(sum(c) // len(held[k]) for c in zip(*held[k], strict=True)) if k in held else e for k, e in enumerate(books[p])]
    codes = [[nearest(v, books[p]) for v in cut[p]] for p in range(parts)]
    errors = [sum(far(cut[p][i], books[p][codes[p][i]]) for p in range(parts)) for i in range(len(x))]
    return list(zip(*codes, strict=True)), errors, books


def plain_numpy(x, entries=256, parts=4, rounds=4):
    """The same for small numbers, all distances at once."""
    cut = np.split(x, parts, axis=1)
    books = [c[:entries].copy() for c in cut]
    near = lambda c, b: ((c[:, None] - b[None]) ** 2).sum(2).argmin(1)
    for _ in range(rounds):
        for c, b in zip(cut, books, strict=True):
            own = near(c, b)
            for k in np.unique(own):
                b[k] = c[own == k].sum(0) // (own == k).sum()
    codes = [near(c, b) for c, b in zip(cut, books, strict=True)]
    errors = sum(((c - b[k]) ** 2).sum(1) for c, b, k in zip(cut, books, codes, strict=True))
    return codes, errors, books


def digest(books):
    return hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()


def test_query_against_a_plain_version(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").sort_by("vec_id")
    x = np.floor(1024 * np.array(t["embedding"].to_pylist(), float)).astype(np.int64)
    codes, errors, books = plain_numpy(x)
    labels, sums = t["label"].to_pylist(), {}
    for k, e in zip(labels, errors, strict=True):
        sums[k] = sums.get(k, 0) + int(e)
    want = sorted((i, "".join(f"{c[j]:02x}" for c in codes), int(errors[j]), sums[labels[j]], digest(books)) for j, i in enumerate(t["vec_id"].to_pylist()))
    assert sorted(map(tuple, op12_heap_lloyd(spark, SF).collect())) == want


def numbers(rows):
    return [[int(np.floor(1024 * c)) for c in v] for v in rows]


@pytest.mark.parametrize("dims,parts,entries", [(8, 4, 256), (6, 4, 5), (4, 2, 3), (3, 4, 7)])
def test_ties_repeats_and_lengths(spark, dims, parts, entries):
    rng = np.random.default_rng(dims)
    rows = rng.integers(-2, 3, (60, dims)) / 1024  # few values: many ties and repeats
    table = spark.createDataFrame([(i, [float(c) for c in v], str(i % 3)) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label string").repartition(9)
    got, books = compress(table, entries, parts)
    x = [v + [0] * (-dims % parts) for v in numbers(rows)]
    codes, errors, want = plain(x, entries, parts)
    assert digest(books) == digest(want)
    assert sorted((r.vec_id, tuple(r.entry), int(r.error)) for r in got.collect()) == [(i, codes[i], errors[i]) for i in range(60)]


def test_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(5, [0.5, -0.5, 1.0, 0.0], "a"), (5, [0.5, -0.5, 1.0, 0.0], "a"), (2, [0.25, 0.0, 0.0, -0.0], None), (None, [1.0, 1.0, 1.0, 1.0], None), (1, None, "a"), (3, [], "a"), (4, [nan, 0.0, 0.0, 0.0], "a"), (6, [inf, 0.0, 0.0, 0.0], "a"), (7, [None, 0.0, 0.0, 0.0], "a"), (8, [1.0], "b")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").selectExpr("*", "1 as x", "2 as entry", "3 as error", "4 as part")
    got, books = compress(table)
    assert sorted((r.vec_id if r.vec_id is not None else 99, tuple(r.entry), int(r.error)) for r in got.collect()) == [(2, (0, 0, 0, 0), 0), (5, (1, 1, 1, 0), 0), (5, (1, 1, 1, 0), 0), (99, (3, 3, 1, 3), 0)]
    assert [len(b) for b in books] == [4] * 4
    got, books = compress(table.drop("label"))
    assert {r.label for r in got.collect()} == {None}
    none, books = compress(table.limit(0))
    assert none.count() == 0 and books == []


def test_query_cases(spark, tmp_path):
    rows = [(i, [float(i % 7), 1.0, 2.0, 3.0 * i], None if i % 2 else 4) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    codes, errors, books = plain(numbers([v for _, v, _ in rows]))
    sums = [sum(errors[0::2]), sum(errors[1::2])]
    got = sorted(map(tuple, op12_heap_lloyd(spark, str(tmp_path)).collect()))
    assert got == [(i, "".join(f"{c:02x}" for c in codes[i]), errors[i], sums[i % 2], digest(books)) for i in range(300)]


def test_components_of_any_finite_size(spark):
    rows = [[1e300, 0.0], [-1e300, 1.0], [5e12, 2.0], [5e12 + 1, 3.0], [4.0, 3.0], [-1e18, 0.0], [2e12, 0.0]]
    most = 2**63 - 1
    x = [[max(-most - 1, min(most, int(np.floor(1024 * c)) if abs(c) < 1e200 else int(np.sign(c)) * 2**70)) for c in v] for v in rows]
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got, books = compress(table, 3, 2)
    codes, errors, want = plain(x, 3, 2)
    assert digest(books) == digest(want)
    assert sorted((r.vec_id, tuple(r.entry), None if r.error is None else int(r.error)) for r in got.collect()) == [(i, codes[i], errors[i] if errors[i] < 10**38 else None) for i in range(len(x))]


def test_heaps_leave_what_cannot_have_changed():
    """Few parts are scanned again when entries hardly move, all when they move far, and the result is that of a full scan."""
    rng = np.random.default_rng(2)
    x, book = rng.integers(-500, 500, (5000, 6)), rng.integers(-500, 500, (40, 6))
    entry, key, scanned = assign(x, book, np.zeros(40), None, None)
    assert len(scanned) == 5000
    for size, most in ((1, 1500), (400, 5001)):
        new = book + rng.integers(-size, size + 1, book.shape)
        far = np.sqrt(((new - book) ** 2).sum(1))
        drift = far + far.max()
        own, keys, scanned = assign(x, new, drift, entry, key)
        assert 0 < len(scanned) < most and (own == scan(x, new)[0]).all()
        left = np.setdiff1d(np.arange(5000), scanned)
        assert (keys[left] == key[left]).all() and (keys > drift[own]).mean() > 0.99
    assert len(violated(entry, key, np.zeros(40))) <= 5
    assert np.isinf(keys_of(*scan(x, book[:1])[1:], np.zeros(5000))).all()
