import threading
import uuid

from pyspark.sql import functions as F

from pubmill.llm.op3_tiered_shards import append, commit, compact, manifest, read, vacuum, version


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_append_compact_and_older_versions(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(i % 90, None if i % 7 == 0 else "x" * (i % 50), i) for i in range(400)] + [(None, "", 1)], "doc_id long, text string, merged_by int").repartition(6)
    for k in range(3):
        assert append(spark, root, docs.where(f"merged_by % 3 = {k}")) == k + 1
    assert append(spark, root, docs.limit(0)) == 4
    before = manifest(spark, root).count()
    assert compact(spark, root, docs.schema, target=1500) == 5
    live = manifest(spark, root, 5)
    assert live.count() < before and live.where("merged").count() > 1
    assert live.agg(F.sum("rows")).first()[0] == docs.count()
    assert rows_of(read(spark, root, docs.schema).drop("merged")) == rows_of(docs)
    assert rows_of(read(spark, root, docs.schema, 4).drop("merged")) == rows_of(docs)


def test_only_one_writer_makes_a_version(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    append(spark, root, docs)
    entries = manifest(spark, root)
    assert commit(spark, root, entries, 1) and not commit(spark, root, entries, 1)
    assert version(spark, root) == 2 and append(spark, root, docs) == 3


def test_empty_store(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([], "doc_id long, text string")
    append(spark, root, docs)
    compact(spark, root, docs.schema)
    assert read(spark, root, docs.schema).count() == 0


def test_racing_writers_lose_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(i, "x" * i) for i in range(20)], "doc_id long, text string")
    append(spark, root, docs.limit(0))
    writers = [threading.Thread(target=append, args=(spark, root, docs.where(f"doc_id % 4 = {k}"))) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert version(spark, root) == 5
    assert rows_of(read(spark, root, docs.schema)) == rows_of(docs)
    assert len(list((tmp_path / "store" / "manifests").iterdir())) == 5  # the losers' manifests are gone


def test_a_writer_that_died_leaves_the_store_whole(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1)
    append(spark, root, docs)
    append(spark, root, docs)
    (tmp_path / "store" / "versions" / f".{uuid.uuid4().hex}").write_text("")
    docs.write.parquet(f"{root}/data/{uuid.uuid4().hex}")
    docs.write.parquet(f"{root}/manifests/{uuid.uuid4().hex}")
    assert version(spark, root) == 2 and rows_of(read(spark, root, docs.schema)) == rows_of(docs.union(docs))
    assert compact(spark, root, docs.schema) == 3
    assert vacuum(spark, root) == 2 + 1 + 3 + 3  # versions, the dead marker, manifests, shards: two merged, one never listed
    assert rows_of(read(spark, root, docs.schema)) == rows_of(docs.union(docs))
    assert append(spark, root, docs) == 4


def test_columns_of_any_name(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(1, "a", 1, "t", "f"), (None, None, None, None, None)], "doc_id long, text string, merged int, tier string, file string")
    append(spark, root, docs)
    append(spark, root, docs)
    compact(spark, root, docs.schema)
    assert rows_of(read(spark, root, docs.schema)) == rows_of(docs.union(docs))


def test_compaction_makes_files_near_the_target(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    docs = spark.createDataFrame([(i, "x" * 92) for i in range(400)], "doc_id long, text string").repartition(20)
    append(spark, root, docs)
    compact(spark, root, docs.schema, target=10_000)
    sizes = [r["bytes"] for r in manifest(spark, root).collect()]
    assert len(sizes) == 4 and sum(sizes) == 40_000 and all(5_000 <= x <= 20_000 for x in sizes)
    assert compact(spark, root, docs.schema, target=10_000) == 3 and manifest(spark, root, 3).count() == 4


def test_paths_with_blanks_and_signs(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * i) for i in range(40)], "doc_id long, text string").repartition(5)
    for name in ("a b", "100%25 é+ä", "x&y=1,2"):
        root = f"{tmp_path}/{name}/store"
        append(spark, root, docs)
        append(spark, root, docs)
        compact(spark, root, docs.schema, target=200)
        assert rows_of(read(spark, root, docs.schema)) == sorted(rows_of(docs) * 2)
        assert vacuum(spark, root) > 0 and rows_of(read(spark, root, docs.schema)) == sorted(rows_of(docs) * 2)
