"""Stateful streams against their batch forms: shuffled, late and replayed events."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pubmill.operators import state as S
from pubmill.streaming import stateful as X


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(X.STORE[0], None)
    spark.conf.set(*X.STORE)
    yield
    spark.conf.set(X.STORE[0], before) if before else spark.conf.unset(X.STORE[0])


def run(df, spark, name, tmp_path):
    q = df.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    return spark.table(name).collect()


def test_ordered_upsert_equals_batch(spark, rocks, tmp_path):
    rng = random.Random(6)
    kinds = [("SEARCHED_WITH", 2, "SITE", "r", None, 3), ("SEARCHED_WITH", 2, "SITE", "r", None, 4), ("SEARCHED_WITHOUT", 0, "SITE", "r", None, 1), ("FAILED", None, None, None, "why", None), ("FAILED", None, None, None, None, None), ("PARTIAL", 1, None, None, None, 9), (None, None, None, None, None, None)]
    base = datetime.datetime(2026, 1, 1)
    events = [(k, i, base + datetime.timedelta(hours=i, minutes=k), *rng.choice(kinds)) for k in range(6) for i in range(14)]
    schema = "key long, ord long, at timestamp, status string, found long, origin string, reference string, error string, expected long"
    want = {r.key: tuple(r) for r in S.upsert(spark.createDataFrame(events, schema)).collect()}
    given = sorted(events, key=lambda e: e[2] + datetime.timedelta(hours=rng.randrange(20)))  # out of order by less than a day
    given += rng.sample(events, 20)  # replayed, some of them long after
    given.append((99, 0, base + datetime.timedelta(days=30), *kinds[0]))  # moves the watermark past all
    chunk = -(-len(given) // 4)
    for part in range(4):
        spark.createDataFrame(given[part * chunk : (part + 1) * chunk], schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    last = {}
    for r in run(X.ordered_upsert(stream), spark, "ordered", tmp_path):
        last[r.key] = max(last.get(r.key, ()), (r.attempts + r.rejected, tuple(r)))
    assert {k: v[1] for k, v in last.items()} == want and len(want) == 6


def test_keys_are_forgotten(spark, rocks, tmp_path):
    ok = ("SEARCHED_WITH", 2, "SITE", "r", None, 3)
    base = datetime.datetime(2026, 1, 1)
    schema = "key long, ord long, at timestamp, status string, found long, origin string, reference string, error string, expected long"
    given = [[(1, 1, base, *ok)], [(9, 1, base + datetime.timedelta(days=40), *ok)], [(1, 2, base + datetime.timedelta(days=41), *ok)], [(9, 2, base + datetime.timedelta(days=60), *ok)]]
    for rows in given:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    rows = [tuple(r)[0::4] for r in run(X.ordered_upsert(stream, keep_days=10), spark, "forgotten", tmp_path) if r.key == 1]
    # the second event would change nothing, had the first been kept
    assert rows == [(1, 1), (1, 1)]


def test_gaps_hold_the_mark_back(spark, rocks, tmp_path):
    rng = random.Random(2)
    begin = datetime.date(2026, 1, 2)  # a Friday
    covered = {k: sorted({begin + datetime.timedelta(rng.randrange(1, 25)) for _ in range(60 if k < 2 else 12)}) for k in range(5)}
    given = [(k, begin, d) for k, ds in covered.items() for d in ds] * 2
    rng.shuffle(given)
    for part in range(3):
        spark.createDataFrame(given[part::3], "key long, begin date, day date").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("key long, begin date, day date").option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    last = {}
    for r in run(X.gap_block(stream), spark, "gaps", tmp_path):
        held = last.get(r.key)
        last[r.key] = max(held, tuple(r)[1:], key=lambda x: (x[0], x[2])) if held else tuple(r)[1:]
    for k, ds in covered.items():
        mark = begin
        following = lambda d: d + datetime.timedelta(3 if d.weekday() == 4 else 2 if d.weekday() == 5 else 1)
        while following(mark) in ds:
            mark = following(mark)
        ahead = sum(d > mark for d in ds)
        assert last[k] == (mark, following(mark) if ahead else None, ahead), k
