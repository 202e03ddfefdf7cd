"""The pipeline's stages on a small table, each against a plain version on its own input."""

import random
import re

import pytest
from test_op2 import plain_fuse
from test_op5 import brute as components
from test_op7 import brute as spans
from test_op9 import targets
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from pubmill.llm.op2_language_evidence import fit, of_documents, text_evidence
from pubmill.llm.op7_personal_data import BASE, find
from pubmill.llm.op8_forced_boundaries import TOKENIZERS, VOCABULARY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = {"en": "the and of with this that from have which would there their about other".split(), "de": "der und die nicht mit einer schon auch werden wurde zwischen gegen".split()}


def made():
    rng = random.Random(11)
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "en", "de"])
        words = [rng.choice(VOCAB[lang]) for _ in range(rng.choice([8, 30, 120]))]
        if i % 9 == 0:
            words[3:3] = ["mail", f"a{i}@b.co", "or", "10.0.0.7"]
        rows.append((i, " ".join(words), lang, rng.choice(["hot"] * 5 + ["b", "c", None])))
    near = rows[4][1].split()
    rows += [(200, rows[3][1], "en", "b"), (201, " ".join([*near, "more"]), rows[4][2], "c"), rows[7], rows[7], (None, rows[8][1] + " end of it", rows[8][2], "b")]
    rows += [(300, None, "en", "hot"), (301, "", "en", "hot"), (302, " 12 !!", "de", "b"), (303, "the of", None, None)]
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before and after each stage."""
    docs = spark.createDataFrame(made(), "doc_id long, text string, lang string, source string").repartition(5)
    docs = docs.selectExpr("*", "length(text) as n_chars", "1 as row", "'x' as taken", "2 as p", "3 as __n0")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp(name)}/t"
        stage(spark, docs, "").write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


KEY = ("doc_id", "text", "source")


def test_all_but_the_last_keep_the_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["language", "deduplicate", "personal", "mixed", "encoded"]
    assert all(stages[n].columns == stages["documents"].columns for n in ("language", "deduplicate", "personal", "mixed"))


def test_language(spark, stages):
    docs = stages["documents"]
    languages = fit(docs.selectExpr("doc_id as id", "text", "lang as label"))
    rows = of_documents(docs).selectExpr("named_struct('a', doc_id, 'b', text) as key", "text", "markup", "coalesce(declared, '') as declared", "coalesce(host, '') as host", "suffix")
    evidence = [(tuple(r.key), r.declared, r.host, r.suffix, r.lettered, list(r.ll)) for r in text_evidence(rows, languages).collect()]
    kept = plain_fuse(evidence, languages[0])
    want = sorted(((r.doc_id, r.text, r.source) for r in docs.collect() if kept[r.doc_id, r.text][2]), key=str)
    assert rows_of(stages["language"], *KEY) == want
    gone = {r.doc_id for r in docs.collect()} - {r[0] for r in want}
    assert {300, 301, 302} <= gone and len(want) > 85


def test_deduplicate(stages):
    rows = [(r.doc_id, r.text) for r in stages["language"].collect()]
    groups = components(rows, 5, 80, 100)
    least = {c for _, n, c in groups if n}
    got = rows_of(stages["deduplicate"], "doc_id", "text")
    assert sorted(d for d, _ in got if d is not None) == sorted(least - {None}) and len(got) < len(rows) - 3
    assert set(got) <= set(rows) and 200 not in {d for d, _ in got}


def test_personal(stages):
    def plain(text):
        if text is None:
            return None
        every = sorted({(a, k, b) for a, k, b in spans(text)} | {s[:3] for s in find(text) if s[1] not in BASE}, key=lambda s: (s[0], [*BASE, "iban", "card13"].index(s[1])))
        out, at = "", 0
        for a, kind, b in every:
            out, at = (out + text[at:a] + f"[{kind.upper()}]" if a >= at else out), max(at, b)
        return out + text[at:]

    want = sorted(((r.doc_id, plain(r.text), len(plain(r.text))) for r in stages["deduplicate"].collect()), key=str)
    assert rows_of(stages["personal"], "doc_id", "text", "n_chars") == want
    assert any("[EMAIL]" in t and "[IP]" in t for _, t, _ in want)


def test_mixed(stages):
    before, after = stages["personal"].collect(), stages["mixed"].collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes, mixed = {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    for r in after:
        mixed[r.source] = mixed.get(r.source, 0) + size(r.text)
    assert all(abs(mixed.get(s, 0) - t) <= 1 for s, t in targets(sizes).items())
    texts, cut = {r.doc_id: r.text for r in before}, []
    for r in after:
        if r.text != texts[r.doc_id]:
            words = WORD.findall(r.text)
            assert words == WORD.findall(texts[r.doc_id])[: len(words)]
            cut.append(r.source)
    assert len(cut) == len(set(cut))


def test_encoded(stages):
    theirs = Tokenizer.from_file(f"{TOKENIZERS}/{VOCABULARY}")
    want = sorted(((r.doc_id, tuple(theirs.encode(r.text or "", add_special_tokens=False).ids)) for r in stages["mixed"].collect()), key=str)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in stages["encoded"].collect()), key=str) == want
    assert all(r.n_tokens == len(r.ids) for r in stages["encoded"].collect())


def test_run_equals_the_stages(spark, stages, tmp_path):
    stages["documents"].write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, tuple(r.ids)) for r in pipeline.run(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((r.doc_id, tuple(r.ids)) for r in stages["encoded"].collect()), key=str)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
