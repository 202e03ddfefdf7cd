"""Exactly-once tables: replays, lost drivers and races write nothing twice."""

import threading

from pyspark.sql import functions as F

from pubmill import sinks
from pubmill.streaming import ledger as L


def test_a_replayed_batch_writes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/a b"
    df = spark.createDataFrame([(i, "x") for i in range(20)], "k long, t string")
    assert L.write_once(df.where("k < 10"), root, 0) and not L.write_once(df, root, 0) and L.write_once(df.where("k >= 10"), root, 1)
    assert sorted(r.k for r in L.read_ledger(spark, root, df.schema).collect()) == list(range(20))
    # a driver that died before its entry leaves a folder that nothing reads
    df.write.parquet(f"{root}/data/orphan")
    assert L.read_ledger(spark, root, df.schema).count() == 20
    assert L.sweep(spark, root) == 1 and L.read_ledger(spark, root, df.schema).count() == 20
    assert L.read_ledger(spark, f"file://{tmp_path}/none", df.schema).count() == 0 and L.sweep(spark, f"file://{tmp_path}/none") == 0


def test_of_two_writers_one_wins(spark, tmp_path):
    root = f"file://{tmp_path}/race"
    df = spark.createDataFrame([(1,)], "k long")
    won = []
    writers = [threading.Thread(target=lambda: won.append(L.write_once(df, root, 7))) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(won) == [False, False, False, True] and L.read_ledger(spark, root, df.schema).count() == 1
    assert len(L.entries(spark, root)) == 1 and L.sweep(spark, root) == 0


def test_a_stream_started_over_writes_once(spark, tmp_path):
    """The same stream with a lost checkpoint: its batches are replayed, and the table stays as it was."""
    rows = spark.createDataFrame([(i, i % 3) for i in range(300)], "k long, part int")
    for p in range(3):
        rows.where(F.col("part") == p).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    root = f"file://{tmp_path}/out"
    for checkpoint in ("one", "one", "two"):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
        q = L.exactly_once(stream, root, f"{tmp_path}/{checkpoint}", lambda df: df.where("k >= 0")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
        assert sorted(r.k for r in L.read_ledger(spark, root, rows.schema).collect()) == list(range(300))
    assert len(L.entries(spark, root)) == 3 and L.sweep(spark, root) == 0


def test_superseded_tables_are_deleted(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    for k in range(5):
        folder = sinks.replace_table(spark.createDataFrame([(k,)], "k long"), root)
        assert sinks.current_table(spark, root).first().k == k
    held = sorted(p.name for p in (tmp_path / "table").iterdir() if p.is_dir())
    assert len(held) == 2 and folder.rsplit("/", 1)[1] in held
    sinks.replace_table(spark.createDataFrame([(9,)], "k long"), root, keep=1)
    assert len([p for p in (tmp_path / "table").iterdir() if p.is_dir()]) == 1
