import random
import re
from collections import Counter

import pytest

from pubmill.llm.op10_count_min_windows import remove_repeated


def brute(rows, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("width_bits", "held", "size"), [(4, 20_000, 4 << 20), (16, 20_000, 4 << 20), (None, 3, 2000)])
def test_equals_brute_force(spark, monkeypatch, width_bits, held, size):
    monkeypatch.setattr("pubmill.llm.op10_count_min_windows.HELD", held)
    monkeypatch.setattr("pubmill.llm.common.BYTES", size)
    rng = random.Random(3)
    vocab = ["w%d" % i for i in range(300)] + ["é", "日本", "A", "a"]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([34, 35, 36, 60]))] for _ in range(8)]
    rows = []
    for d in range(300):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 40, 200]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        rows.append((d, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [rows[5], rows[7], (901, None), (902, ""), (903, "x " * 36), (904, "y " * 35), (905, "z " * 500), (None, rows[9][1]), (906, " \r\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).selectExpr("*", "1 as row", "2 as spans", "3 as key")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeated(docs, width_bits=width_bits).collect()), key=str)
    assert got == brute(rows, 35)


def test_hot_anchor_keeps_its_distinct_windows(monkeypatch):
    """One anchor over many batches: rows of two hashes each, some repeated far apart."""
    import pyarrow as pa

    from pubmill.llm import op10_count_min_windows as op10

    rng = random.Random(1)
    lists = [[rng.randrange(60), 1000 + rng.randrange(4000)] for _ in range(900)]
    starts = [-1 if rng.random() < 0.02 else 10 * i for i in range(900)]
    batches = []
    for at in range(0, 900, 50):
        hashes = pa.array(lists[at : at + 50], pa.list_(pa.int64()))
        own = [None if s < 0 else s for s in starts[at : at + 50]]
        batches.append(pa.RecordBatch.from_arrays([pa.array([7] * 50, pa.int64()), pa.array(range(at, at + 50), pa.int64()), pa.array(own, pa.int32()), pa.array(own, pa.int32()), hashes], schema=op10._ROWS))
    seen = Counter(h for x in lists for h in x)
    want = {(i, s + k) for i, (x, s) in enumerate(zip(lists, starts, strict=True)) if s >= 0 for k, h in enumerate(x) if seen[h] > 1}
    for held in (20_000, 100, 10):
        monkeypatch.setattr(op10, "HELD", held)
        got = Counter((r["row"], p) for b in op10._meet(iter(batches)) for r in b.to_pylist() for p in range(r["start"], r["end"]))
        assert set(got) == want and max(got.values()) == 1, held


def test_long_text(spark):
    words = [str(i) for i in range(400_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[1000:1040]) + " end")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeated(docs).collect()}
    assert got == {1: (400_000, 40), 2: (41, 40)}


def test_empty_table(spark):
    assert remove_repeated(spark.createDataFrame([], "doc_id long, text string"), width_bits=8).count() == 0


def _hot(op10, n, windows, seed, per_batch=10_000):
    """Batches of one anchor's rows, each with windows of its own, and how often each window is held."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    h = rng.integers(0, 2**62, (n, windows))
    h[rng.integers(0, n, n // 100), 0] = h[rng.integers(0, n, n // 100), 1]  # a few are repeated, mostly far apart
    for at in range(0, n, per_batch):
        part = h[at : at + per_batch]
        m = len(part)
        ids = pa.array(np.arange(at, at + m))
        lists = pa.ListArray.from_arrays(np.arange(0, part.size + 1, windows, dtype=np.int32), part.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, 7)), ids, pa.array(np.zeros(m, np.int32)), pa.array(np.full(m, windows, np.int32)), lists], schema=op10._ROWS), part


def test_common_anchor_in_parts(monkeypatch):
    """Both steps over one anchor's rows and over many keys, against counting."""
    import pyarrow as pa

    from pubmill.llm import op10_count_min_windows as op10

    for held, n in ((50, 3000), (7, 500), (20_000, 3000)):
        monkeypatch.setattr(op10, "HELD", held)
        batches, parts = zip(*_hot(op10, n, 3, held, 64), strict=True)
        seen = Counter(int(x) for p in parts for x in p.ravel())
        lists = [r for p in parts for r in p.tolist()]
        want = {(i, k) for i, r in enumerate(lists) for k, x in enumerate(r) if seen[x] > 1}
        other = pa.RecordBatch.from_arrays([pa.array([9, 9, 10]), pa.array([n, n + 1, n + 2]), pa.array([4, 5, 6], pa.int32()), pa.array([5, 6, 7], pa.int32()), pa.array([[1], [1], [2]], pa.list_(pa.int64()))], schema=op10._ROWS)
        first = pa.Table.from_batches(op10._parts(iter([*batches, other])))
        assert (first.num_rows > len(seen) // 2) == (held < n)
        table = first.sort_by("key")
        got = Counter((r["row"], p) for b in op10._meet(iter(table.to_batches(100))) for r in b.to_pylist() for p in range(r["start"], r["end"]))
        assert set(got) == want | {(n, 4), (n + 1, 5)} and max(got.values()) == 1


def test_common_anchor_is_linear():
    """A window of an anchor costs the same however many it has, and parts, not all, are held."""
    import time

    from pubmill.llm import op10_count_min_windows as op10

    def seconds(n):
        began = time.process_time()
        assert sum(len(b) for b in op10._parts(b for b, _ in _hot(op10, n, 16, 1))) >= n
        return time.process_time() - began

    seconds(30_000)
    small, large = seconds(60_000), seconds(240_000)
    assert large < 8 * small
