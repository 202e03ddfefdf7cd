"""Queries without a cut, against plain counts."""

import datetime

import pyarrow.parquet as pq

import __spark_entry__ as entry
from pubmill.operators import matching as M

SF = "/root/testdata/sf0.01"


def rows(table, *columns):
    return pq.read_table(f"{SF}/{table}.parquet", columns=list(columns)).to_pylist()


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_grid_holds_every_user(spark):
    events = rows("events", "user_id", "event_type")
    want = {(u, k) for u in {e["user_id"] for e in events} for k in {e["event_type"] for e in events}}
    got = run(spark, "q_grid_status")
    assert len(got) == len(want) and {(r.user_id, r.event_type) for r in got} == want
    assert sum(r.found for r in got) == len(events)


def test_gaps_of_every_user(spark):
    days = {}
    for e in rows("events", "user_id", "ts"):
        days.setdefault(e["user_id"], set()).add(e["ts"].date())
    want = set()
    for u, seen in days.items():
        for i in range((max(seen) - min(seen)).days + 1):
            day = min(seen) + datetime.timedelta(i)
            if day.weekday() < 5 and day not in seen:
                want.add((u, day))
    got = run(spark, "q_coverage_gap")
    assert len(got) == len(want) and {(r.user_id, r.day) for r in got} == want
    assert max(u for u, _ in want) >= 40


def test_exclusion_reads_the_whole_first_line(spark):
    docs = [(1, "a " * 200 + "nicht\nbody"), (2, "a\nnicht"), (3, "a " * 200 + "para mit license")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as lang", "'y' as source")
    assert {r.doc_id: r.status for r in M.scored(df, None).collect()} == {1: "EXCLUDED", 2: "OPEN", 3: "RESCUED"}
    # the operator can still judge a title's first characters; the query does not
    cut = {r.doc_id: r.status for r in M.scored(spark.read.parquet(f"{SF}/documents.parquet"), 80).collect()}
    full = {r.doc_id: r.status for r in run(spark, "q_context_score")}
    assert cut.keys() == full.keys() and any(cut[k] == "OPEN" != full[k] for k in cut)
    assert all(full[k] == cut[k] for k in cut if cut[k] != "OPEN")


def test_relevance_orders_every_publication(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = M.scored(docs, None).select("rank", "organ", "title", "doc_id").collect()
    want = [r.doc_id for r in sorted(plain, key=lambda r: (-r["rank"], r.organ or "", r.title, r.doc_id))]
    assert [r.doc_id for r in run(spark, "q_relevance_order")] == want and len(want) == docs.count() > 50


def test_top_terms_beyond_ten(spark):
    terms = [r.term for r in run(spark, "q_norm_terms")]
    assert {r.term for r in run(spark, "q_top_terms")} == set(terms) and len(terms) > 10


def test_keyword_rank_counts_terms_inside_words(spark):
    norm = {r.doc_id: r.norm for r in M.publications(spark.read.parquet(f"{SF}/documents.parquet")).select("doc_id", "norm").collect()}
    score = {k: sum(len(t) for t, _ in M.WATCHLIST if t in x) for k, x in norm.items()}
    want = sorted(((-v, k) for k, v in score.items() if v))[:20]
    assert [(-r.score, r.doc_id) for r in run(spark, "q_keyword_rank")] == want
