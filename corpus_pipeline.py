"""A corpus pipeline of five stages; each works on all that its predecessor kept.

Every stage keeps the columns of documents, of any further name too, but for the
last, which gives doc_id, n_tokens and ids. Null ids are kept as they are; an empty
table gives an empty table; rows repeated in full count as copies of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubmill.llm.common import mark, materialize, release
from pubmill.llm.op2_language_evidence import keep_identified
from pubmill.llm.op5_prefix_tree_join import ngram_components
from pubmill.llm.op7_personal_data import redact
from pubmill.llm.op8_forced_boundaries import bpe_encode
from pubmill.llm.op9_hash_thresholds import mix
from pubmill.llm.sketch import may_hold


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language; null texts and texts without letters are in none and go."""
    return keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that of least id.

    Documents without words are no copies of each other and stay. Only documents that go, or whose key repeats, are
    joined, with the few that a table of bits takes for them; the others pass as they are read.
    """
    since = mark()
    rows = ngram_components(docs, k=5, num=80).groupBy("row").agg(F.bool_or("keeper").alias("stays"), F.count("*").alias("rows"))
    some = materialize(rows.where("not stays or rows > 1").select(F.col("row").alias("__row"), "stays"), "some")
    release(spark, since, some)
    keyed = docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    held = may_hold(some.select("__row"))(F.col("__row"))
    rest = keyed.where(held).join(some.where("not stays"), "__row", "left_anti")
    # rows repeated in full share a key; one of them stays
    return keyed.where(~held).unionByName(rest.dropDuplicates(["__row", "doc_id"])).select(*docs.columns)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked, and n_chars, where there is such a column, their length; null texts stay null."""
    out = redact(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights, documents repeated, left out or (one a source) cut; those without words stay once."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids; null and empty texts have none."""
    ids = F.when(F.col("ids") == "", F.array().cast("array<int>")).otherwise(F.split("ids", " ").cast("array<int>"))
    return bpe_encode(docs).select("doc_id", "n_tokens", ids.alias("ids"))


STAGES = [("language", language), ("deduplicate", deduplicate), ("personal", personal), ("mixed", mixed), ("encoded", encoded)]
#: The stages' methods have no SQL form; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents; each one's table is deleted, with what it worked on, once the next is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = mark()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        release(spark, since, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
