import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pubmill.llm.op13_bin_completion import VOCABULARY, Search, Texts, best_fit, least_sequences, op13_bin_completion, pack

SF = "/root/testdata/sf0.01"
PATH = str(public_tokenizers.path(VOCABULARY))


def fewest(sizes, capacity):
    """The least number of sequences, by trying every place for every piece."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for r in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            go(i + 1, [*rooms[:r], rooms[r] - sizes[i], *rooms[r + 1 :]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


def whole(packing, sizes, capacity):
    assert all(sum(s * n for s, n in p) <= capacity and t > 0 for p, t in packing)
    held = Counter()
    for p, t in packing:
        for s, n in p:
            held[s] += n * t
    assert held == Counter(sizes)
    return sum(t for _, t in packing)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_fewest_of_small_lists(sizes):
    search = Search(Counter(sizes), 20)
    found = whole(search.run(), sizes, 20)
    want = fewest(sizes, 20)
    assert found == want and search.least <= want <= whole(best_fit(Counter(sizes), 20), sizes, 20)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(15, 50), min_size=6, max_size=11))
def test_fewest_where_best_fit_fails(sizes):
    assert whole(Search(Counter(sizes), 100).run(), sizes, 100) == fewest(sizes, 100)


def test_better_than_best_fit():
    """Triplets that fill sequences exactly, where best fit needs more."""
    better = 0
    for seed in range(12):
        rng = np.random.default_rng(seed)
        sizes = [int(x) for _ in range(8) for a in [rng.integers(38, 50)] for b in [rng.integers(24, (100 - a) // 2 + 1)] for x in (a, b, 100 - a - b)]
        search = Search(Counter(sizes), 100)
        n = whole(search.run(), sizes, 100)
        assert n <= whole(best_fit(Counter(sizes), 100), sizes, 100) and n >= search.least == 8
        better += n < len(best_fit(Counter(sizes), 100)) or n == 8
    assert better >= 10


def test_many_equal_pieces():
    """The search follows the lengths, not the pieces; bounds hold."""
    rng = np.random.default_rng(1)
    counts = {int(s): int(n) for s, n in zip(rng.permutation(np.arange(1, 2049))[:1500], rng.integers(1, 10**9, 1500), strict=True)}
    search = Search(counts, 2048)
    packing = search.run()
    held = Counter()
    for p, t in packing:
        assert sum(s * n for s, n in p) <= 2048
        for s, n in p:
            held[s] += n * t
    assert held == counts and sum(t for _, t in packing) == search.fewest and search.fewest <= search.least * 1.005
    assert len(packing) < 20_000


def test_bound_against_plain():
    for sizes in itertools.combinations_with_replacement([3, 5, 8, 11, 16], 5):
        counts = np.bincount(sizes, minlength=17)
        assert least_sequences(counts, 16) <= fewest(sizes, 16)


WORDS = st.sampled_from(["the", "Straße,", "naïve.", "don't", "X.", "a.b", "…", "<|endoftext|>", "12,5", "ΣΑΣ.", "é", "é.", "́a", "İ", " ", "\n", "\x1c", "\x85", "　", "word.", "word,", "?!", "ß;", "ab­.", "ª.", "x²."])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(WORDS, st.text(max_size=6)), max_size=14), st.booleans())
def test_ids_are_the_librarys(parts, spaced):
    text = (" " if spaced else "").join(parts).encode("utf-8", "ignore").decode()
    want = np.array(_LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert _TEXTS.ids(text) == want and _TEXTS.ids(text) == want


_LIBRARY, _TEXTS = Tokenizer.from_file(PATH), Texts(PATH)


def held(rows, docs, capacity):
    """Pieces of (doc_id, text) rows in order of their ids, against the library; places without gaps."""
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    for i, text in docs:
        ids = _LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(got.pop(i), key=lambda r: r.piece)
        want = [(k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == want
    assert not got
    gapless(rows, capacity)


def gapless(rows, capacity):
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert all(v <= capacity for v in filled.values())
    assert {(r.sequences) for r in rows} == ({len(filled)} if rows else set())


def test_query_against_the_library(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op13_bin_completion(spark, SF).collect()
    held(rows, docs, 2048)
    assert rows[0].sequences <= rows[0].least + 1


@pytest.mark.parametrize("parts", [1, 7, 90])
def test_cases(spark, parts):
    long = "word, " * 5000
    docs = [(1, None), (2, ""), (3, long), (4, "a b c"), (5, long + "."), (6, " \n"), (7, "x" * 30_000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as length", "2 as run", "3 as nth", "'x' as ids").repartition(parts)
    held(pack(table, 64).collect(), docs, 64)
    assert pack(table.limit(0)).count() == 0
    # rows repeated in full, and null ids: packed each
    many = spark.createDataFrame([(None, "a b c")] * 300 + [(8, None)] * 5, "doc_id long, text string").repartition(parts)
    rows = pack(many, 9).collect()
    gapless(rows, 9)
    assert len(rows) == 305 and rows[0].sequences == rows[0].least == 150


def test_stretches_of_a_task(spark):
    docs = [(i, "a " * (i % 13)) for i in range(200)]
    held(pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 16, stretch=7).collect(), docs, 16)
