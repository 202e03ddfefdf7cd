import zipfile

from pyspark.sql import functions as F

from pubmill.functions import text as T
from pubmill.operators import matching as M
from pubmill.operators import monitoring as O
from pubmill.sources.archive import parse_publications, read_zips, strip_html
from pubmill.streaming.outbox import new_items


def test_zip_of_xml(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x-2.xml", "<a xmlns='u'><B><IDENTIFICA> Act 7 </IDENTIFICA><Texto>body</Texto></B></a>")
        z.writestr("y.xml", "<a><Texto>only text</Texto></a>")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    rows = read_zips(spark, f"file://{tmp_path}")
    assert rows.where("error is not null").count() == 1
    got = {r.xml_name: (r.title, r.xml_group, r.xml_index) for r in parse_publications(rows).collect()}
    assert got == {"x-2.xml": ("Act 7", "x", 2), "y.xml": ("only text", "y", 1)}


def test_text_rules(spark):
    row = spark.range(1).select(
        T.normalise(F.lit("Amapá, nº 5  (ß) a_b")).alias("a"), T.has_term(F.lit("amapa"), F.lit("mapa")).alias("b"), T.slug(F.lit("Olá, Mundo!")).alias("c"),
        T.process_number(F.lit("12345678901234567")).alias("d"), strip_html(F.lit("<p>a  b</p><script>x</script>c<br>d")).alias("e"), T.normalise(F.lit(None).cast("string")).alias("f"),
    ).first()
    assert tuple(row) == ("amapa no 5 a_b", False, "ola-mundo", "12345.678901/2345-67", "a b\nc\nd", "")


def test_both_matching_strategies_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pubs, terms = M.publications(docs), M.watchlist(spark)
    key = lambda df: sorted(map(tuple, df.select("doc_id", "ord").collect()))
    assert key(M.match(pubs, terms)) == key(M.match(pubs, terms, size=M.BROADCAST_TERMS + 1))


def test_proximity_limits(spark):
    text = lambda gap: "aaaa " + "x " * (gap - 1) + "bbbb"
    df = spark.createDataFrame([(12, text(12)), (13, text(13))], "gap int, norm string")
    assert [r.gap for r in df.where(M.near(F.col("norm"), "aaaa", "bbbb")).collect()] == [12]


def test_gap_blocks_every_key(spark):
    state = spark.createDataFrame([("a", "2026-09-09"), ("b", "2026-09-08")], "key string, last string").select("key", F.col("last").cast("date").alias("last"))
    day = F.lit("2026-09-10").cast("date")
    none = state.limit(0).select("key")
    blocked = {r.key: (str(r.next), r.verdict) for r in O.advance(state, day, none).collect()}
    assert blocked == {"a": ("2026-09-09", "ADVANCED"), "b": ("2026-09-08", "BLOCKED")}
    assert {str(r.next) for r in O.advance(state, day, state.where("key = 'b'").select("key")).collect()} == {"2026-09-10"}


def test_process_numbers(spark):
    number = "12345678901234567"
    rows = [(1, f"x 12345.678901/2345-67 y {number}"), (2, number + "8"), (3, "9" + number), (4, "12345 678901 2345 67")]
    pubs = spark.createDataFrame(rows, "pub_id int, text string")
    hits = O.process_hits(pubs, spark.createDataFrame([(number,)], "process string")).collect()
    assert sorted((h.pub_id, h.n_hits) for h in hits) == [(1, 2), (4, 1)]


def test_streaming_outbox(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 01:00:00"), ("b", "2026-01-01 02:00:00")], "key string, ts string").write.parquet(src)
    stream = spark.readStream.schema("key string, ts string").parquet(src).withColumn("ts", F.to_timestamp("ts"))
    q = new_items(stream).writeStream.format("memory").queryName("outbox_new").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.key for r in spark.table("outbox_new").collect()) == ["a", "b"]


def test_archives_are_read_in_parts(spark, tmp_path):
    """Every entry once, in whatever number of tasks; blanks in the path; broken archives and entries as rows."""
    import pytest

    folder = tmp_path / "a b" / "in"
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(57):
            z.writestr(f"p-{i}.xml", f"<a><Titulo>t{i}</Titulo></a>" if i % 10 else "<a>")
    with zipfile.ZipFile(folder / "two.ZIP", "w") as z:
        z.writestr("x.xml", "<a><Texto>" + "stored body " * 20 + "</Texto></a>")
        z.writestr("y.txt", "none")
    whole = (folder / "two.ZIP").read_bytes()
    (folder / "spoilt.zip").write_bytes(whole.replace(b"stored body stored", b"stored BODY stored"))
    (folder / "cut.zip").write_bytes(whole[:-30])
    want = None
    for split in (100, 1 << 26):
        rows = read_zips(spark, str(folder), split=split)
        parts = rows.rdd.getNumPartitions()
        assert parts > 10 if split == 100 else parts == 4
        got = sorted((r.zip.rsplit("/", 1)[1], r.xml_name or "", r.place or 0, r.titulo or "", (r.error or "")[:12]) for r in rows.collect())
        want = want or got
        assert got == want
    assert [g[2] for g in want if g[0] == "one.zip" and g[1] in ("p-2.xml", "p-10.xml")] == [11, 3]
    assert sum(g[4] == "malformed XM" for g in want) == 6 and [g[4] for g in want if g[0] in ("cut.zip", "spoilt.zip")] == ["broken archi", "broken entry"] and len(want) == 60
    with pytest.raises(Exception, match="broken"):
        read_zips(spark, str(folder), strict=True).count()
    (tmp_path / "none").mkdir()
    assert read_zips(spark, str(tmp_path / "none")).count() == 0


def test_archive_over_two_gigabytes(spark, tmp_path):
    """Only what belongs to entries is read: what stands before them is a hole of 2.2 GB."""
    with open(tmp_path / "big.zip", "wb") as f:
        f.truncate(2_200_000_000)
        f.seek(0, 2)
        with zipfile.ZipFile(f, "w") as z:
            for i in range(200):
                z.writestr(f"p-{i}.xml", f"<a><Titulo>t{i}</Titulo></a>")
    rows = read_zips(spark, f"file://{tmp_path}")
    assert rows.rdd.getNumPartitions() == 33
    assert {(r.place, r.titulo) for r in rows.where("error is null").collect()} == {(i + 1, f"t{i}") for i in range(200)}


def test_strip_html_equals_plain_rules(spark):
    import re

    def plain(t):
        for pattern, by in ((r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), (r"(?is)<!--.*?-->", " "), (r"(?i)</p>|<br ?/?>", "\n"), ("<[^>]*>", " "), (r"[ \t\r]+", " "), (r" ?\n[ \n]*", "\n")):
            t = re.sub(pattern, by, t)
        return t.strip(" \n")

    given = ["", "<", ">", "a<b", "a>b<c", "<p>x</p>y<", "x<b>y</b>z < 5 > 3 <", "<p>" * 5 + "q", "é<i>ü</i> ñ<", "<script>a<b</script>c<!-- > -->d"]
    rows = spark.createDataFrame([*enumerate(given), (99, None)], "i int, t string").select("i", strip_html(F.col("t")).alias("o")).collect()
    assert {r.i: r.o for r in rows} == {**{i: plain(t) for i, t in enumerate(given)}, 99: None}


def test_unfinished_references_in_pages_stay(spark):
    from pubmill.sources.pages import parse_pages

    html = '<meta name="a" content="p&amp;q&ampr"><h1>x&amp;y &amp</h1><p class="signed">&lt;a&#x27;b&gt &copy; &notit; \ue000</p><p>R&D &#38 & end&'
    row = parse_pages(spark.createDataFrame([(1, html), (2, None)], "key long, html string")).orderBy("key").collect()[0]
    assert row["title"] == "x&y &amp" and row["meta"] == {"a": "p&q&ampr"}
    assert row["signatures"] == ["<a'b&gt © &notit; \ue000"] and row["blocks"][1]["text"] == "R&D &#38 & end&"


def test_entries_and_archives_come_in_bounded_pieces():
    import pyarrow as pa

    from pubmill.plans.source_queries import _as_archives
    from pubmill.sources import archive as A

    texts = ["<a><texto>" + "x" * (A.BATCH // 3) + "</texto></a>"] * 10 + ["<a/>"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(11)), pa.array(texts)], ["doc_id", "xml"])
    archives = list(_as_archives(iter([batch])))
    assert len(archives) == 4
    found = [list(A._batches(A._entries("a.zip", pa.BufferReader(b["content"][0].as_buffer()), True))) for b in archives]
    assert sorted(n for bs in found for b in bs for n in b["xml_name"].to_pylist()) == sorted(f"g{k % 7}-{k}.XML" for k in range(11))
    assert all(b.nbytes < 2 * A.BATCH for bs in found for b in bs)


def test_inventory_files_are_not_written_by_one_task(spark, monkeypatch):
    from pubmill.plans import sink_queries

    calls, kind = [], type(spark.range(1))
    dealt = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, *by: calls.append(by) or dealt(self, *by))
    got = {tuple(r) for r in sink_queries.q_inventory(spark, "/root/testdata/sf0.001").collect()}
    assert {k for k, *_ in got} == {"JSON", "OTHER"} and calls and (1,) not in calls
