"""Language identification by Bayesian evidence fusion.

Three kinds of evidence meet as log probabilities:

* text: a naive Bayes model over hashed byte trigrams, fitted to labelled rows; a
  text counts for at most ``TRIGRAMS`` of its trigrams, since they are not
  independent;
* declaration (markup ``lang`` or a column): its likelihood in each language
  comes from a grouped count of declarations against text evidence;
* host: a prior for each host, smoothed towards its address suffix, and that
  towards the whole corpus; all three are grouped sums of text evidence.

A text is rejected when it has no letters or no language reaches ``KEEP``.

The model is fitted to about ``SAMPLE`` labelled rows, those of least id hash;
priors and likelihoods are sums over all rows. Cases: null and empty texts have
even text evidence and are rejected; a missing declaration or host is a value of
its own that says nothing by itself; repeated rows count each; an empty table
gives no rows; without any labelled row every text is rejected.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, heavy_join, materialize

#: Labelled rows fitted to, trigram cells, trigrams a text counts for, least posterior of a kept text.
SAMPLE, CELLS, TRIGRAMS, KEEP = 4000, 1 << 14, 200, 0.5
#: Rows of its parent that a host or suffix counts as having seen, and a declaration's added count.
PARENT, ADDED = 10.0, 1.0
#: Starts of what is no text, and where each ends; a tag ends at the next ">".
_OPENS = re.compile(r"<(?:(!--)|(script)\b|(style)\b)?", re.IGNORECASE)
_CLOSES = (re.compile("-->"), re.compile(r"</script\s*>", re.IGNORECASE), re.compile(r"</style\s*>", re.IGNORECASE), re.compile(">"))
_LETTER = re.compile(r"[^\W\d_]")


def trigrams(text: str) -> np.ndarray:
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return (((b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def plain_text(markup: str) -> str:
    """The text outside tags, comments, scripts and styles, entities resolved; what is opened and never closed is text.

    Linear: an end that was once not found is not looked for again.
    """
    out, at, missing = [], 0, set()
    while m := _OPENS.search(markup, at):
        for kind in (m.lastindex - 1, 3) if m.lastindex else (3,):
            end = None if kind in missing else _CLOSES[kind].search(markup, m.end())
            if end:
                out += [markup[at : m.start()], " "]
                at = end.end()
                break
            missing.add(kind)
        else:
            break  # no ">" after this one, so none after a later one
    return html.unescape("".join([*out, markup[at:]]))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each trigram cell, from about ``sample`` rows of (id, text, label)."""
    labelled = labelled.where("label is not null and text is not null")
    share = min(1.0, sample / max(1, labelled.count()))
    chosen = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batch: pa.RecordBatch):
        sums: dict[str, np.ndarray] = {}
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            held = sums.setdefault(label, np.zeros(CELLS, np.int64))
            held += np.bincount(trigrams(text), minlength=CELLS)
        return list(sums), [x.tobytes() for x in sums.values()]

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
        return pa.table({"label": table["label"][:1], "counts": pa.array([total.tobytes()])})

    schema = "label string, counts binary"
    rows = sorted(arrow_map(chosen.select("text", "label"), count, schema).groupBy("label").applyInArrow(add, schema).collect())
    counts = np.array([np.frombuffer(bytes(r["counts"]), np.int64) for r in rows], float).reshape(len(rows), CELLS) + 0.5
    return [r["label"] for r in rows], np.log(counts / counts.sum(1, keepdims=True))


def text_evidence(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``rows`` (key, text, markup, declared, host, suffix) without texts, with lettered and the log likelihoods ll."""
    shared = rows.sparkSession.sparkContext.broadcast((len(model[0]), np.ascontiguousarray(model[1].T)))
    kept = [c for c in rows.columns if c not in ("text", "markup")]

    def per_batch(batch: pa.RecordBatch):
        n, table = shared.value
        lettered, ll = [], []
        for text, markup in zip(batch["text"], batch["markup"], strict=True):
            text = text.as_py() or ""
            text = plain_text(text) if markup.as_py() else text
            lettered.append(_LETTER.search(text) is not None)
            at = trigrams(text)
            own = (table[at].sum(0) if len(at) < CELLS else np.bincount(at, minlength=CELLS) @ table) * min(1.0, TRIGRAMS / max(1, len(at)))
            ll.append((own - own.max(initial=0) if not len(at) else own - own.max()).tolist())
        return *(batch[c] for c in kept), lettered, ll

    kinds = dict(rows.dtypes)
    return arrow_map(rows, per_batch, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", lettered boolean, ll array<double>")


def fuse(scored: DataFrame, languages: list[str]) -> DataFrame:
    """``scored`` with language, posterior and kept."""
    n = len(languages)
    if not n:
        return scored.drop("ll", "lettered").select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    total = F.aggregate("ll", F.lit(0.0), lambda s, x: s + F.exp(x))
    soft = scored.withColumn("p", F.transform("ll", lambda x: F.exp(x) / total))
    pack = lambda: F.array(*(F.col(f"s{i}") for i in range(n)))
    # every row counts for how many rows its key has, lettered ones as evidence
    tally = soft.groupBy("host", "suffix").agg(*[F.sum(F.when(F.col("lettered"), F.col("p")[i]).otherwise(0.0)).alias(f"s{i}") for i in range(n)], F.count("*").alias("rows"))
    hosts = tally.select("host", "suffix", pack().alias("own"), "rows")
    sums = [F.sum(F.col("own")[i]).alias(f"s{i}") for i in range(n)]
    suffixes = hosts.groupBy("suffix").agg(*sums).select("suffix", pack().alias("over"))
    whole = hosts.agg(*(F.coalesce(F.sum(F.col("own")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(n))).first()  # one row
    everywhere = (np.array(whole, float) + 1) / (sum(whole) + n)
    base = F.array(*(F.lit(float(x)) for x in everywhere))
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    smooth = lambda c, parent: F.zip_with(c, parent, lambda x, y: (x + F.lit(PARENT) * y) / (size(c) + F.lit(PARENT)))
    suffixes = suffixes.withColumn("over", smooth("over", base))
    priors = hosts.join(suffixes, "suffix", "left")
    priors = priors.select("host", "suffix", smooth("own", F.col("over")).alias("prior"), "rows")
    sums = [F.sum(F.when(F.col("lettered"), F.col("p")[i]).otherwise(0.0)).alias(f"s{i}") for i in range(n)]
    said = soft.groupBy("declared").agg(*sums, F.count("*").alias("rows"), F.count_if("lettered").alias("voiced"))
    kinds = said.where("voiced > 0").count()
    said = said.select("declared", pack().alias("said"), "rows")
    spoken = [float(x) for x in np.array(whole, float)]
    likely = F.zip_with("said", F.array(*(F.lit(x) for x in spoken)), lambda c, t: F.log((c + F.lit(ADDED)) / (t + F.lit(ADDED * max(1, kinds)))))
    said = said.select("declared", likely.alias("declares"), "rows")
    joined = heavy_join(heavy_join(scored, priors, ["host", "suffix"], "rows"), said, ["declared"], "rows")
    zero = F.array_repeat(F.lit(0.0), n)
    log_post = F.zip_with(F.zip_with("ll", F.transform(F.coalesce("prior", base), lambda x: F.log(x)), lambda a, b: a + b), F.coalesce("declares", zero), lambda a, b: a + b)
    joined = joined.withColumn("lp", log_post).withColumn("best", F.array_max("lp"))
    share = 1 / F.aggregate("lp", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("best")))
    name = F.element_at(F.array(*map(F.lit, languages)), F.array_position("lp", F.col("best")).cast("int"))
    joined = joined.withColumn("language", name).withColumn("posterior", share)
    return joined.withColumn("kept", F.col("lettered") & (F.col("posterior") >= KEEP)).drop("ll", "lp", "best", "prior", "declares", "lettered")


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rows`` (key columns, text, markup, declared, host, suffix) with language, posterior and kept for the texts."""
    model = fit(labelled)
    blank = [F.coalesce(F.lower(F.col(c).cast("string")), F.lit("")).alias(c) for c in ("declared", "host", "suffix")]
    keys = [c for c in rows.columns if c not in ("text", "markup", "declared", "host", "suffix")]
    return fuse(materialize(text_evidence(rows.select(*keys, "text", "markup", *blank), model), "evidence"), model[0])


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as evidence: the column lang declares, and the source is the host."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(False).alias("markup"), F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit("").alias("suffix"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as evidence: the html element declares; host and suffix come from the address."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    declared = F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return pages.select("page_id", F.col("html").cast("string").alias("text"), F.lit(True).alias("markup"), declared.alias("declared"), host.alias("host"), F.element_at(F.split(host, r"\."), -1).alias("suffix"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is rejected; columns as they were."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    rows = keyed.select("__row", F.col("text").cast("string").alias("text"), F.lit(False).alias("markup"), F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit("").alias("suffix"))
    labelled = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    kept = identify(rows, labelled).where("kept").select("__row").distinct()
    return keyed.join(kept, "__row", "left_semi").select(*docs.columns)


def op2_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document and every page."""
    docs, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages"))
    labelled = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    rows = of_documents(docs).unionByName(of_pages(pages), allowMissingColumns=True)
    return identify(rows, labelled).select("doc_id", "page_id", "declared", "host", "language", "posterior", "kept")
