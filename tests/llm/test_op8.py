import hashlib

import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pubmill.llm.op8_forced_boundaries import TOKENIZERS, VOCABULARY, bpe_encode, load, op8_forced_boundaries

PATH = f"{TOKENIZERS}/{VOCABULARY}"
SF = "/root/testdata/sf0.001"
ours, theirs = load(PATH), Tokenizer.from_file(PATH)


def same(text):
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.encode_decode(text)[1] == theirs.decode(ids, skip_special_tokens=False)


@settings(max_examples=800, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=60))
def test_any_text(text):
    same(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["the", "The", " ", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "é", "é", "Σ", "ΑΣ", "İ", "ß", "\x1c", "\x85", " ", "​", "12", "½", "日本", "!!!", "...", "aaaaaaaa", "\n", "ﬁ"]), max_size=14))
def test_odd_pieces(pieces):
    same("".join(pieces))


def test_characters_assigned_later():
    import unicodedata

    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and (c < 0x2FA20 or c % 997 == 0)]
    texts = [f"a{chr(c)}b 1{chr(c)}! !{chr(c)}1" for c in points]
    for at in range(0, len(texts), 5000):
        part = texts[at : at + 5000]
        assert [ours.encode(t) for t in part] == [e.ids for e in theirs.encode_batch(part, add_special_tokens=False)]


def test_long_word():
    same("ab" * 3000 + "z" * 3000)


def test_documents(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d in docs:
        ids = theirs.encode(d["text"] or "", add_special_tokens=False).ids
        want[d["doc_id"]] = (len(ids), digest(" ".join(map(str, ids))), digest(theirs.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op8_forced_boundaries(spark, SF).collect()} == want


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a b"), (4, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    assert sorted(r.n_tokens for r in bpe_encode(docs).collect()) == [0, 0, 0, 2, 2, 2]
    assert bpe_encode(docs.limit(0)).count() == 0
