"""Operators without SQL, and cases that the tables do not hold."""

import difflib
import itertools
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from pubmill import sinks
from pubmill.functions import text as T
from pubmill.operators import context as C
from pubmill.operators import matching as M
from pubmill.operators import records as R
from pubmill.operators import state as S
from pubmill.plans.state_queries import attempts
from pubmill.sources import collection
from pubmill.sources.archive import read_zips, strip_html
from pubmill.sources.pages import parse_pages
from pubmill.streaming.outbox import daily_counts

SF = "/root/testdata/sf0.001"


def test_archives_in_natural_order_with_error_rows(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name in ("g-10.xml", "g-2.xml", "g-1.xml"):
            z.writestr(name, f"<a><Titulo>{name}</Titulo></a>")
        z.writestr("bad.xml", "<a><b>")
    rows = read_zips(spark, f"file://{tmp_path}").orderBy("place").collect()
    assert [r.xml_name for r in rows] == ["bad.xml", "g-1.xml", "g-2.xml", "g-10.xml"]
    assert [r.error is None for r in rows] == [False, True, True, True] and rows[1].titulo == "g-1.xml"
    (tmp_path / "b.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="broken archive"):
        read_zips(spark, f"file://{tmp_path}", strict=True).count()


def test_unclosed_tags(spark):
    cases = ["a < b", "<p>x<q", "a > b <i>c</i> d > e", "<<a>b", "", "<" * 300_000]
    got = [r.t for r in spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").orderBy("i").select(strip_html(F.col("c")).alias("t")).collect()]
    assert got == ["a < b", "x<q", "a > b c d > e", "b", "", "<" * 300_000]


def test_every_context_leaf_and_each_neighbour(spark):
    """Facets set by hand: each rule wins where it and every later one hold."""
    names = [*C.VOCABULARY, "product"]
    kind = "struct<" + ",".join(f"{f}:array<string>" for f in names) + ">"
    hits = "array<struct<ord:int,term:string,category:string>>"

    def row(i, held, matched=True):
        facets = tuple([{"regulator": "auf", "event": "than", "activity": "heon"}.get(f, "t")] if f in held else [] for f in names)
        return (i, "x", [(1, "t", "product")] if matched else [], facets)

    wants = [("administrative", {"admin", "event"}), ("company and event", {"company", "event", "regulator", "admin"}), ("company and regulator", {"company", "regulator", "act"}), ("company and act", {"company", "act", "product"}), ("company and product", {"company", "product", "activity"}), ("company and activity", {"company", "activity", "process"}), ("company and process", {"company", "process"}), ("company", {"company"}), ("product, event and regulator", {"product", "event", "regulator", "activity"}), ("product, regulator and activity", {"product", "regulator", "activity", "act"}), ("product, regulator and act", {"product", "regulator", "act"}), ("sector", {"regulator", "event", "activity", "sector"}), ("product and event", {"product", "event", "technical"}), ("product and strong regulation", {"product", "technical"}), ("any match", {"weak"})]
    rows = [row(i, held) for i, (_, held) in enumerate(wants)] + [row(99, set(), False)]
    got = {r.i: r.rule for r in spark.createDataFrame(rows, f"i int, norm string, hits {hits}, facets {kind}").select("i", C.decide(C.CONTEXT_RULES)["rule"].alias("rule")).collect()}
    assert got == {i: w for i, (w, _) in enumerate(wants)} | {99: "no match"}


def test_hybrid_terms(spark):
    text = lambda gap: "brilliance " + "x " * (gap - 1) + "flumioxazina"
    pubs = M.publications(spark.createDataFrame([(1, "Flumioxazina 500 WP Brilliance", "", ""), (2, text(12), "", ""), (3, text(13), "", ""), (4, "500 WP", "", ""), (5, "metomil", "", ""), (6, "17", "", ""), (7, None, None, None)], "doc_id long, text string, lang string, source string"))
    terms = spark.createDataFrame([(1, "flumioxazina 500 wp brilliance", "hybrid", "product"), (2, "17 metomil", "hybrid", "monograph")], "ord int, term string, kind string, origin string")
    assert sorted(map(tuple, M.match_hybrid(pubs, terms).select("doc_id", "ord").collect())) == [(1, 1), (2, 1), (5, 2)]


def test_fuzzy_titles_equal_brute_force(spark):
    docs = [(r.doc_id, (r.text or "").split("\n")[0][:60]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    asked = [(0, "Eauouon eau"), (1, docs[3][1][:40] + " x"), (2, ""), (3, docs[7][1])]
    norm = dict(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)] + [(1000 + k, t) for k, t in asked], "i int, t string").select("i", T.normalise(F.col("t"))).rdd.map(tuple).collect())
    want = {}
    for k, _ in asked:
        best = None
        for i, (doc_id, _) in enumerate(docs):
            a, b = norm[i], norm[1000 + k]
            if not a or not b:
                continue
            s = max(difflib.SequenceMatcher(None, a, b).ratio(), 0.99 if b in a else 0.95 if a in b else 0)
            if s >= 0.5 and (best is None or (-s, doc_id) < best):
                best = (-s, doc_id)
        if best:
            want[k] = (best[1], round(-best[0], 9))
    records = spark.createDataFrame(docs, "id long, title string").repartition(5)
    got = {r.key: (r.id, round(r.score, 9)) for r in R.fuzzy_titles(records, spark.createDataFrame(asked, "key long, title string"), 0.5).collect()}
    assert got == want and len(want) >= 2


def test_upsert_cases(spark):
    ok = ("SEARCHED_WITH", 2, "SITE", "r", None, 3)
    events = [(1, 1, *ok), (1, 2, *ok), (1, 3, *ok[:5], 3), (1, 4, *ok[:5], 4), (2, 1, "SEARCHED_WITH", 0, "SITE", "r", None, 1), (2, 2, "FAILED", None, None, None, None, None), (2, 3, "FAILED", None, None, None, "why", None), (3, 1, *ok), (3, 2, "SEARCHED_WITHOUT", 0, "SITE", "r", None, 3), (4, 1, None, None, None, None, None, None)]
    df = spark.createDataFrame(events, "key long, ord long, status string, found long, origin string, reference string, error string, expected long")
    got = {r.key: (r.status, r.expected, r.attempts, r.rejected) for r in S.upsert(df).collect()}
    assert got == {1: ("SEARCHED_WITH", 4, 2, 0), 2: ("FAILED", None, 1, 2), 3: ("SEARCHED_WITH", 3, 1, 1), 4: (None, None, 0, 1)}


def test_upsert_stream_equals_batch(spark, tmp_path):
    rows = attempts(spark, SF)
    order = [f.name for f in rows.schema]
    for k in range(3):  # three batches, by order
        rows.where(f"ord % 6000 >= {2000 * k} and ord % 6000 < {2000 * k + 2000}").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    want = {r.key: tuple(r) for r in S.upsert(rows).collect()}
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in").select(*order)
    q = S.upsert_stream(stream).writeStream.format("memory").queryName("upserts").outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(240)
    last = {r.key: tuple(r) for r in spark.table("upserts").collect()}
    assert last == want


def test_daily_counts_stream(spark, tmp_path):
    rows = [("2026-01-01 01:00:00", "a"), ("2026-01-01 02:00:00", "a"), ("2026-01-02 01:00:00", "b"), ("2026-01-09 00:00:00", "z")]
    spark.createDataFrame(rows, "ts string, kind string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts string, kind string").parquet(f"{tmp_path}/in").withColumn("ts", F.to_timestamp("ts"))
    q = daily_counts(stream, "ts", "kind").writeStream.format("memory").queryName("days").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.kind, r.n) for r in spark.table("days").collect()) == [("a", 2), ("b", 1)]


def test_refusals(spark):
    found = spark.createDataFrame([("a", 1, "x")], "key string, ord int, payload string")
    with pytest.raises(ValueError):
        S.baseline(found, found)
    assert S.baseline(found, found, force=True).count() == 1
    with pytest.raises(ValueError):
        S.discover(spark.createDataFrame([], "key string, status string"), spark.createDataFrame([], "url string"))


def test_pages(spark):
    html = "<html><head><title>T &amp; t</title><meta name='author' content='x'><style>p{}</style></head><body><h1>Head</h1><p>one<p>two <b>2</b></p><table><tr><td>a<td>b</tr><tr><td>c</td></tr></table><p class='signature'>A. B.</p><script>var p='</p>'</script></body></html>"
    rows = spark.createDataFrame([(1, html), (2, "plain"), (3, None), (4, "")], "key int, html string")
    got = {r.key: r for r in parse_pages(rows).collect()}
    assert (got["1"].title, got["1"].status, got["1"].signatures, got["1"].tables) == ("Head", "OK", ["A. B."], [[["a", "b"], ["c"]]])
    assert [(b.kind, b.text) for b in got["1"].blocks] == [("h1", "Head"), ("p", "one"), ("p", "two 2")] and got["1"].meta == {"author": "x"}
    assert {got[k].status for k in "234"} == {"NO_ARTICLE"}


def test_payloads(spark):
    deep = "[" * 200 + "]" * 200
    rows = [(1, '{"a": {"title": "t", "link": "u", "sub": [{"name": "n", "text": "x"}]}}'), (2, None), (3, ""), (4, deep), (5, '{"title": "alone"}'), (None, "[]")]
    got = collection.payload_scan(spark.createDataFrame(rows, "key long, json string")).collect()
    assert sorted((r.key, r.place) for r in got if r.publication) == [(1, 0), (1, 1)] and {(r.key, r.error) for r in got if r.error} == {(3, "JSONDecodeError"), (4, "ValueError")}


def test_inventory(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"publications": [1, 2]}')
    (tmp_path / "b.json").write_text("{oops")
    (tmp_path / "c.txt").write_text("x")
    (tmp_path / "d.json").write_text("[1]")
    got = {r.name: (r.kind, r.records) for r in collection.inventory(spark, f"file://{tmp_path}").collect()}
    assert got == {"a.json": ("JSON", 2), "b.json": ("INVALID", None), "c.txt": ("OTHER", None), "d.json": ("JSON", 1)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "2026-01-01", "x"), (2, [], "2026-01-02", 'say "y"; z')], "k int, tags array<string>, day string, t string")
    totals = {r.day: r.records for r in sinks.snapshot(df, f"{tmp_path}/json", "day").collect()}
    assert totals == {"2026-01-01": 1, "2026-01-02": 1}
    sinks.snapshot(df.where("k = 1").withColumn("t", F.lit("new")), f"{tmp_path}/json", "day").collect()
    assert sorted(r.t for r in spark.read.json(f"{tmp_path}/json").collect()) == ["new", 'say "y"; z']
    root = f"file://{tmp_path}/table"
    sinks.replace_table(df, root)
    sinks.replace_table(df.where("k = 2"), root)
    assert [r.k for r in sinks.current_table(spark, root).collect()] == [2]
    sinks.delimited(df, ["k", "tags", "none", "t"], f"{tmp_path}/csv")
    back = spark.read.option("sep", ";").option("header", "true").option("escape", '"').csv(f"{tmp_path}/csv").orderBy("k").collect()
    assert [(r.k, r.tags, r.none, r.t) for r in back] == [("1", "a | b", None, "x"), ("2", None, None, 'say "y"; z')]
    lines = [r.line for r in sinks.report_lines(df, "HEAD", "t", "k").collect()]
    assert lines[0] == "HEAD" and len(lines) == 3 and lines[2].endswith(" 1")
    events = spark.createDataFrame([("r", "1", "s", "DONE", "{}")], "run string, at string, stage string, status string, details string")
    sinks.append_events(events, f"{tmp_path}/log")
    sinks.append_events(events, f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 2
    with pytest.raises(Exception, match="unknown status"):
        sinks.append_events(events.withColumn("status", F.lit("ODD")), f"{tmp_path}/log")


def test_text_helpers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(T.number_digits(F.lit(x))) for x in ("123.0", "1e5", "12.5", "n 1-2", "", "1d")] == ["123", "100000", "125", "12", "", "1"]
    assert one(T.number_digits(F.lit(None).cast("string"))) == ""
    assert one(T.title_norm(F.lit("Aviso nº 5-A, de 1º/2 (x)"))) == "aviso n 5-a de 1/2 x"
    assert one(T.ordered_distinct(F.lit(["Éa", "ea", " ", "b", "B!"]))) == ["Éa", "b"]
    assert one(C.traced_terms(F.lit(["kind: Éa", "other: ea", "x", "k: " + "y" * 81]))) == ["Éa"]
    assert not one(T.flexible_term(T.accent_norm(F.lit("aeroporto")), "porta")) and one(T.flexible_term(T.accent_norm(F.lit("a  Porta\n de")), "porta de"))


def test_long_and_short_watchlists_agree_on_empty_input(spark):
    docs = spark.createDataFrame([(None, None, None, None), (1, "", "x", "y")], "doc_id long, text string, lang string, source string")
    for size in (None, 10**6):
        assert M.match(M.publications(docs), M.watchlist(spark), size).count() == 0
        assert M.match(M.publications(docs.limit(0)), M.watchlist(spark), size).count() == 0
        assert M.match(M.publications(docs), M.watchlist(spark, ()), size).count() == 0


def test_ids_span_numbers(spark):
    pubs = spark.createDataFrame([(1, "12 345 x 678"), (2, "999"), (3, None)], "doc_id long, text string")
    ids = spark.createDataFrame([("12345678",), ("45678",), ("999",), ("123456789",)], "id string")
    assert sorted(map(tuple, M.match_ids(pubs, ids).collect())) == [(1, "12345678"), (1, "45678")]


def test_json_sorting_is_stable():
    objects = list(collection.publications_within(json.loads('[{"title": 1, "url": 2}, {"x": {"name": 1, "source": 2}}]')))
    assert [sorted(o) for o in objects] == [["title", "url"], ["name", "source"]] and list(itertools.islice(objects, 1))


def test_flexible_spans_point_into_the_original_text(spark):
    from pubmill.operators.reports import flexible_spans, folded

    rows = [(1, "Um PÚBLICO - direito; publico  direito"), (2, "aeroporto"), (3, "ﬁm da porta"), (4, None), (5, ""), (6, "porta portão porta de aço"), (7, "é" * 5000 + " porta")]
    got = {r.doc_id: [(s.start, s.end, s.term) for s in r.spans] for r in flexible_spans(spark.createDataFrame(rows, "doc_id long, text string"), ["público direito", "porta", "porta de aço", "fim", "--"]).collect()}
    text = dict(rows)
    assert [text[1][a:b] for a, b, _ in got[1]] == ["PÚBLICO - direito", "publico  direito"]
    assert got[2] == got[4] == got[5] == [] and [text[3][a:b] for a, b, _ in got[3]] == ["ﬁm", "porta"]
    assert got[6] == [(0, 5, "porta"), (13, 25, "porta de aço")] and got[7] == [(5001, 5006, "porta")]
    assert folded("Éﬁ")[0] == "efi" and folded("Éﬁ")[1] == [0, 1, 1]


def test_confidence_of_matches(spark):
    from pubmill.operators.reports import match_confidence, publication_confidence

    rows = [(1, "number", "123456"), (1, "direct", "x"), (2, "number", "12"), (2, "direct", "x"), (3, "hybrid", "ab 500 wp"), (3, "direct", "x"), (4, "hybrid", "wp 500"), (5, "text", "alpha 500"), (6, "process", "1"), (7, None, None)]
    df = spark.createDataFrame(rows, "k int, kind string, term string")
    assert [r.c for r in df.select("k", match_confidence(F.col("kind"), F.col("term")).alias("c")).collect()] == ["MEDIUM", "HIGH", "LOW", "HIGH", "CRITICAL", "HIGH", "LOW", "MEDIUM", "HIGH", "MEDIUM"]
    got = {r.k: (r.confidence, r.n_suspect, r.verdict) for r in publication_confidence(df, "k").collect()}
    assert got == {1: ("MEDIUM", 0, "CONFIRMED"), 2: ("MEDIUM", 1, "SUSPECT"), 3: ("CRITICAL", 1, "SUSPECT"), 4: ("LOW", 1, "SUSPECT"), 5: ("MEDIUM", 0, "CONFIRMED"), 6: ("HIGH", 0, "CONFIRMED"), 7: ("MEDIUM", 0, "CONFIRMED")}


def test_queries_without_sql(spark):
    import __spark_entry__ as entry

    for name in ("fuzzy_title", "flexible_spans"):
        assert entry.queries()[name](spark, SF).count() > 0


def test_numbering_in_stretches(spark):
    rows = [("hot", i * 3) for i in range(400)] + [("b", 5), ("b", -7), (None, 1), (None, 9), ("n", None)]
    for width in (7, 1 << 20):
        got = sorted(((r.k, r.o, r.place) for r in R.numbered(spark.createDataFrame(rows, "k string, o long").repartition(5), "k", "o", "place", width).collect()), key=str)
        want = [(k, o, 1 + sum(a == k and (b if b is not None else -99) < (o if o is not None else -99) for a, b in rows)) for k, o in rows]
        assert got == sorted(want, key=str)


def test_payloads_equal_a_plain_walk(spark):
    """What VARIANT levels find is what a walk through the parsed JSON finds; strings with brackets and quotes do not count as nesting."""
    rng = random.Random(9)

    def made(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind == 0:
            return rng.choice([1, None, True, 'a "quoted" [ { \\ text', "é", 2.5])
        if kind < 3 and depth == 0:
            return "x"
        if kind < 4:
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return {k: made(depth - 1) for k in rng.sample(["title", "name", "text", "url", "records", "a b", "organ", "z"], rng.randrange(1, 6))}

    values = [made(rng.randrange(1, 7)) for _ in range(150)] + [json.loads("[" * 12 + '{"title": null, "url": 1}' + "]" * 12)]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(1000, '{"a": 1, "a": 2}'), (1001, "x"), (1002, None), (1003, '["\\\\", "[[[[", "\\""]')]
    got = collection.payload_scan(spark.createDataFrame(rows, "key long, json string").repartition(3))
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    found = {}
    for r in got.collect():
        found.setdefault(r.key, []).append((r.place, r.publication, r.error))
    assert {k: [e for _, _, e in v] for k, v in found.items() if v[0][2]} == {1000: ["JSONDecodeError"], 1001: ["JSONDecodeError"]}
    for i, v in enumerate(values):
        want = sorted(json.dumps(p, sort_keys=True) for p in collection.publications_within(v))
        mine = found.get(i, [])
        assert sorted(json.dumps(json.loads(p), sort_keys=True) for _, p, _ in mine) == want
        assert sorted(k for k, _, _ in mine) == list(range(len(want)))
    assert sum(map(len, found.values())) > 60


def test_rows_without_a_key_do_not_meet_in_one_task(spark):
    """Half of the rows have no key: they are dealt over the tasks of the join."""
    from pubmill.operators import records as R

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("key"))
        right = spark.range(0, 3000, 2).select(F.col("id").alias("key"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("page"))
        out = R.guarded(left, right, [["key"]], "page")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) > 4 and max(sizes) < 4000 / 4
        assert {(r.id, r.page) for r in out.collect()} == {(i, f"p{i}" if i % 2 == 0 and i < 3000 else None) for i in range(4000)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_associations_sort_neither_side(spark):
    left = spark.range(40).select("id", F.col("id").alias("key"))
    right = spark.range(30).select(F.col("id").alias("key"), F.col("id").cast("string").alias("page"))
    plan = R.guarded(left, right, [["key"]], "page")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortAggregate", "")
