"""Exactly-once tables: a ledger names the folder of each batch, and only what it names is read.

A batch writes a folder of its own and then its ledger entry, in one step and only if
there is none. So a batch that is replayed, or written by two drivers, counts once, and
what a lost driver left behind is in no entry; ``sweep`` deletes it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _entry(batch: int) -> str:
    return f"{batch:012d}"


def write_once(df: DataFrame, root: str, batch: int) -> bool:
    """Write a batch as Parquet, unless the ledger has it; whether it was written."""
    spark = df.sparkSession
    entry, fs = _path(spark, f"{root}/ledger/{_entry(batch)}")
    if fs.exists(entry):
        return False
    folder = f"{root}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    staged, _ = _path(spark, f"{root}/staged/{uuid.uuid4().hex}")
    stream = fs.create(staged, False)
    stream.write(bytearray(folder.rsplit("/", 1)[1].encode()))
    stream.close()
    fs.mkdirs(entry.getParent())
    if _renamed(spark, staged, entry):
        return True
    fs.delete(staged, False)
    fs.delete(_path(spark, folder)[0], True)
    return False


def _renamed(spark: SparkSession, staged, entry) -> bool:
    """Rename that never replaces; False where the name is taken."""
    jvm = spark._jvm
    fs = entry.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":  # a local rename replaces, a link does not
        import os

        try:
            os.link(staged.toUri().getPath(), entry.toUri().getPath())
        except FileExistsError:
            return False
        fs.delete(staged, False)
        return True
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(entry.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, entry, options)
    except Exception:  # noqa: BLE001  the JVM's exceptions arrive wrapped; only a taken name is no error
        if fs.exists(entry):
            return False
        raise
    return True


def entries(spark: SparkSession, root: str) -> dict[int, str]:
    """The folder of each batch in the ledger."""
    path, fs = _path(spark, f"{root}/ledger")
    if not fs.exists(path):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return {int(n): spark.read.text(f"{root}/ledger/{n}").first()[0] for n in sorted(names) if n.isdigit()}


def read_ledger(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of the batches in the ledger."""
    folders = [f"{root}/data/{f}" for f in entries(spark, root).values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def sweep(spark: SparkSession, root: str) -> int:
    """Delete the folders that no entry names; how many. Not while a batch is being written."""
    held = set(entries(spark, root).values())
    gone = 0
    for part in ("data", "staged"):
        path, fs = _path(spark, f"{root}/{part}")
        for status in fs.listStatus(path) if fs.exists(path) else ():
            if part == "staged" or status.getPath().getName() not in held:
                gone += bool(fs.delete(status.getPath(), True))
    return gone


def exactly_once(stream: DataFrame, root: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataStreamWriter:
    """A writer, to be started, that appends each batch of a stream once, however often it is replayed."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, batch: write_once(prepare(df), root, batch) and None)
