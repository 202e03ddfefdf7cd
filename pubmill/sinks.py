"""Sinks: snapshots, replaced tables, delimited files, text reports, event logs and content-addressed archives."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Statuses that an event may have.
EVENT_STATUS = ("STARTED", "DONE", "PARTIAL", "ERROR")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, which only a local session may go without."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="pubmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/pubmill-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table below the shared folder: computed once, whatever reads it and whichever executors are lost."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def snapshot(records: DataFrame, path: str, *by: str) -> DataFrame:
    """Write records as JSON partitioned by day and purpose; the totals of each partition. Partitions that the records do not touch stay."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)
    return records.groupBy(*by).agg(F.count("*").alias("records"))


def replace_table(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write a table beside the old one and point ``current`` at it in one rename; readers see the old or the new, never a part.

    Superseded folders are deleted but for the ``keep`` - 1 last, which readers may still be reading.
    """
    spark = df.sparkSession
    folder = f"{root}/{uuid.uuid4().hex}"
    path = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    staged, current = path(f"{root}/.{uuid.uuid4().hex}"), path(f"{root}/current")
    fs = current.getFileSystem(spark._jsc.hadoopConfiguration())
    df.write.parquet(folder)
    stream = fs.create(staged, False)
    stream.write(bytearray(folder.encode()))
    stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, current, options)
    others = sorted(((s.getModificationTime(), s.getPath()) for s in fs.listStatus(path(root)) if s.isDirectory() and s.getPath().getName() != path(folder).getName()), key=lambda x: -x[0])
    for _, gone in others[max(0, keep - 1) :]:
        fs.delete(gone, True)
    return folder


def current_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(spark.read.text(f"{root}/current").first()[0])


def delimited(df: DataFrame, columns: list[str], path: str) -> None:
    """Files separated by ";" with these columns in this order: a missing one empty, others left out, lists joined by " | ", structs as JSON."""
    kinds = {f.name: f.dataType for f in df.schema}

    def shown(c: str):
        if c not in kinds:
            return F.lit("").alias(c)
        if isinstance(kinds[c], T.ArrayType) and not isinstance(kinds[c].elementType, (T.StructType, T.ArrayType, T.MapType)):
            return F.array_join(F.transform(c, lambda x: x.cast("string")), " | ").alias(c)
        return (F.to_json(c) if isinstance(kinds[c], (T.StructType, T.ArrayType, T.MapType)) else F.col(c).cast("string")).alias(c)

    df.select(*map(shown, columns)).write.mode("overwrite").option("sep", ";").option("header", "true").option("escape", '"').csv(path)


def report_lines(rows: DataFrame, heading: str, label: str, value: str) -> DataFrame:
    """(place, line): a heading and one line for each row of a report (label, value), in order; to be written as text."""
    lines = rows.select(F.lit(1).alias("part"), F.col(label).cast("string").alias("key"), F.format_string("%-40s %12s", F.col(label).cast("string"), F.col(value).cast("string")).alias("line"))
    top = rows.sparkSession.createDataFrame([(0, "", heading)], "part int, key string, line string")
    return top.unionByName(lines).orderBy("part", "key").select("line")


def append_events(events: DataFrame, path: str) -> None:
    """Append events (run, at, stage, status, details) as JSON lines; a status outside the list fails the job before anything is written."""
    wrong = F.raise_error(F.concat(F.lit("unknown status "), F.coalesce("status", F.lit("null"))))
    events.withColumn("status", F.when(F.col("status").isin(*EVENT_STATUS), F.col("status")).otherwise(wrong)).write.mode("append").json(path)


def archive_audit(files: DataFrame, listed: DataFrame) -> DataFrame:
    """(digest, verdict) of files (name, content) named by the hash of their bytes, against a list (digest): OK, MISNAMED, UNLISTED or LOST."""
    held = files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("digest"), F.sha2("content", 256).alias("own"))
    j = held.join(listed.select("digest", F.lit(True).alias("wanted")).distinct(), "digest", "full_outer")
    verdict = F.when(F.col("own").isNull(), "LOST").when(F.col("own") != F.col("digest"), "MISNAMED").when(F.col("wanted").isNull(), "UNLISTED").otherwise("OK")
    return j.select("digest", verdict.alias("verdict"))
