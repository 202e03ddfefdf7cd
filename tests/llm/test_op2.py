import html
import math
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pubmill.llm.op2_language_evidence import fuse, identify, keep_identified, of_documents, op2_language_evidence, plain_text

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train, held = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0")
    rows = of_documents(held).withColumn("declared", F.lit(None).cast("string")).withColumn("host", F.lit("h"))
    got = {r.doc_id: (r.language, r.kept) for r in identify(rows, train.selectExpr("doc_id as id", "text", "lang as label")).collect()}
    want = {r.doc_id: r.lang for r in held.collect()}
    assert sum(got[d][0] == w for d, w in want.items()) / len(want) > 0.95
    assert sum(k for _, k in got.values()) / len(got) > 0.95


def test_pages_and_documents(spark):
    rows = op2_language_evidence(spark, SF).collect()
    n = sum(pq.read_metadata(f"{SF}/{t}.parquet").num_rows for t in ("documents", "pages"))
    assert len(rows) == n
    known = [r for r in rows if r.declared]
    assert sum(r.declared == r.language for r in known) / len(known) > 0.9
    assert plain_text("<p>a&amp;b<script>x</script><!-- c --></p>").split() == ["a&b"]


def test_prior_and_declaration_decide_short_texts(spark):
    text = {"en": "the and of with this that from have", "de": "der und die nicht mit einer schon auch"}
    rows = [(i, text[lang] + f" w{i}", lang, f"host-{lang}") for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(900, "xq", "de", "host-de"), (901, "xq", "en", "host-en"), (902, None, "en", "host-en"), (903, "", None, None), (904, "!! 12", "de", "host-de"), (None, text["en"], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.language, r.kept) for r in identify(of_documents(docs), docs.selectExpr("doc_id as id", "text", "lang as label")).collect()}
    assert got[900] == ("de", True) and got[901] == ("en", True) and got[None][0] == "en"
    assert not any(got[i][1] for i in (902, 903, 904))
    kept = keep_identified(docs.selectExpr("*", "1 as host", "2 as p"))
    assert kept.count() == len(rows) - 3 and kept.columns == [*docs.columns, "host", "p"]
    assert keep_identified(docs.limit(0)).count() == 0


def test_plain_text_equals_the_pattern_and_is_linear():
    tags = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.DOTALL | re.IGNORECASE)
    odd = ["a<b", "a < b > c", "<script>x", "<style>a</style >b", "<!-- x > y", "<!-- a --> b <!--", "<SCRIPT a>1</Script>2<script>3", "<scripted>x</scripted>", "&lt;p&gt; &amp;", "<<a>>", ""]
    pages = [p["html"] for p in pq.read_table(f"{SF}/pages.parquet", columns=["html"]).to_pylist()]
    for text in [*odd, *pages]:
        assert plain_text(text) == html.unescape(tags.sub(" ", text))
    for text in ("<" * 1_000_000, "<script " * 300_000, "<!--" * 300_000, "<style>" * 200_000 + ">"):
        t = time.time()
        plain_text(text)
        assert time.time() - t < 5


def plain_fuse(rows, languages):
    """rows of (key, declared, host, suffix, lettered, ll), by the definitions, one at a time."""
    n = len(languages)
    soft = lambda ll: [math.exp(x) / sum(map(math.exp, ll)) for x in ll]
    total = lambda chosen: [sum(soft(r[5])[i] for r in chosen if r[4]) for i in range(n)]
    everywhere = total(rows)
    base = [(x + 1) / (sum(everywhere) + n) for x in everywhere]
    smooth = lambda own, parent: [(x + 10 * y) / (sum(own) + 10) for x, y in zip(own, parent, strict=True)]
    kinds = max(1, len({r[1] for r in rows if r[4]}))
    out = {}
    for key, declared, host, suffix, lettered, ll in rows:
        over = smooth(total([r for r in rows if r[3] == suffix]), base)
        prior = smooth(total([r for r in rows if (r[2], r[3]) == (host, suffix)]), over)
        said = total([r for r in rows if r[1] == declared])
        lp = [a + math.log(b) + math.log((c + 1) / (t + kinds)) for a, b, c, t in zip(ll, prior, said, everywhere, strict=True)]
        best = max(lp)
        posterior = 1 / sum(math.exp(x - best) for x in lp)
        out[key] = (languages[lp.index(best)], round(posterior, 9), lettered and posterior >= 0.5)
    return out


def test_fusion_equals_plain_version(spark):
    rows = []
    for i in range(120):
        host = "hot" if i % 3 else f"h{i % 7}"
        ll = [-((i * 7 + k * 5) % 11) / 2.0 for k in range(3)]
        rows.append((i, ["en", "de", "", "fr"][i % 4], host, ["com", "de"][i % 2], i % 10 != 9, [x - max(ll) for x in ll]))
    rows.append((500, "only", "lone", "org", False, [0.0, 0.0, 0.0]))
    scored = spark.createDataFrame(rows, "key long, declared string, host string, suffix string, lettered boolean, ll array<double>")
    got = {r.key: (r.language, round(r.posterior, 9), r.kept) for r in fuse(scored, ["de", "en", "fr"]).collect()}
    assert got == plain_fuse(rows, ["de", "en", "fr"])
