"""Size-tiered compaction of document shards under a versioned manifest.

``append`` writes arrivals as small immutable Parquet shards and commits a new
manifest that lists them. ``compact`` puts live shards into tiers by size (each
``FAN`` times the last), merges the shards of a tier into files near the target
size, writes them beside the old ones, and commits a manifest in which they take
the old ones' place. A version is committed by a marker, which names the
manifest's own folder: it is written under a temporary name and renamed without
overwriting, so a marker is whole or absent, and of two writers only one makes
version n; the other deletes what it wrote and starts again from the newer one.
Readers see whole versions. ``vacuum`` deletes what no kept version names: shards
that were merged, and folders that a writer left when it died.

Built-in functions only. What the driver handles is the manifest: one row a
shard. Cases: null ids and texts are rows like any others; repeated rows are
kept; an empty arrival commits a version without new shards; further columns,
of any name, travel along.
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, new_path

#: Bytes of text in a merged file, growth of a tier, size at which the lowest tier ends.
TARGET, FAN, FLOOR = 128 << 20, 4, 1 << 20
MANIFEST = "file string, tier int, bytes long, rows long, merged boolean"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def version(spark: SparkSession, root: str) -> int:
    """The last committed version; 0 before the first."""
    path, fs = _fs(spark, f"{root}/versions")
    if not fs.exists(path):
        return 0
    return max([int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v")], default=0)


def manifest(spark: SparkSession, root: str, at: int | None = None) -> DataFrame:
    """The live shards of a version."""
    at = version(spark, root) if at is None else at
    if not at:
        return spark.createDataFrame([], MANIFEST)
    folder = spark.read.text(f"{root}/versions/v{at:08d}").first()[0]
    return spark.read.schema(MANIFEST).parquet(folder)


def _publish(spark: SparkSession, made: str, name: str) -> bool:
    """Rename without overwriting; False if the name is taken."""
    source, fs = _fs(spark, made)
    target, _ = _fs(spark, name)
    if fs.getScheme() == "file":  # a local rename overwrites, a link does not
        try:
            os.link(source.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True
    jvm = spark._jvm
    none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
    except Exception:  # noqa: BLE001  the JVM's exceptions arrive wrapped; only a taken name is no error
        if fs.exists(target):
            return False
        raise
    return True


def commit(spark: SparkSession, root: str, entries: DataFrame, base: int) -> bool:
    """Make version base + 1; False, and nothing left behind, if another writer has made it."""
    name = uuid.uuid4().hex
    folder, made = f"{root}/manifests/{name}", f"{root}/versions/.{name}"
    entries.coalesce(1).write.parquet(folder)
    path, fs = _fs(spark, made)
    stream = fs.create(path, False)
    stream.write(bytearray(folder.encode()))
    stream.close()
    done = _publish(spark, made, f"{root}/versions/v{base + 1:08d}")
    fs.delete(path, False)
    if not done:
        delete_path(spark, folder)
    return done


def _tier(size):
    return F.greatest(F.lit(0), F.ceil(F.log(size / F.lit(FLOOR)) / F.lit(math.log(FAN)))).cast("int")


def _entries(spark: SparkSession, folder: str, schema, merged: bool) -> DataFrame:
    """A manifest row for each file of a folder, its size the bytes of its texts."""
    rows = spark.read.schema(schema).parquet(folder)
    # Spark reports names percent-encoded; its own file names hold nothing that this changes
    name = F.concat(F.lit(f"{folder}/"), F.substring_index(F.input_file_name(), "/", -1))
    per_file = rows.groupBy(name.alias("file")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8).alias("bytes"), F.count("*").alias("rows"))
    return per_file.select("file", _tier(F.col("bytes")).alias("tier"), "bytes", "rows", F.lit(merged).alias("merged"))


def append(spark: SparkSession, root: str, arrival: DataFrame) -> int:
    """Write one arrival as shards and commit them; the new version."""
    folder = f"{root}/data/{uuid.uuid4().hex}"
    arrival.write.parquet(folder)
    fresh = _entries(spark, folder, arrival.schema, False)
    while True:
        base = version(spark, root)
        if commit(spark, root, manifest(spark, root, base).unionByName(fresh), base):
            return base + 1


def compact(spark: SparkSession, root: str, schema, target: int = TARGET) -> int:
    """Merge each tier's shards below half the target into files near it; the new version.

    A tier of one such shard stays as it is.
    """
    while True:
        base = version(spark, root)
        live = manifest(spark, root, base)
        tiers: dict[int, list] = {}
        for row in live.where(F.col("bytes") < target // 2).orderBy("tier", "file").toLocalIterator():
            tiers.setdefault(row["tier"], []).append(row)
        fresh, gone, folders = spark.createDataFrame([], MANIFEST), [], []
        for held in tiers.values():
            if len(held) < 2:
                continue
            folders.append(f"{root}/data/{uuid.uuid4().hex}")
            files = max(1, round(sum(r["bytes"] for r in held) / target))
            spark.read.schema(schema).parquet(*(r["file"] for r in held)).coalesce(files).write.parquet(folders[-1])
            fresh = fresh.unionByName(_entries(spark, folders[-1], schema, True))
            gone += [(r["file"],) for r in held]
        after = live.join(spark.createDataFrame(gone, "file string"), "file", "left_anti").unionByName(fresh)
        if commit(spark, root, after.select("file", "tier", "bytes", "rows", "merged"), base):
            return base + 1
        for folder in folders:
            delete_path(spark, folder)


def read(spark: SparkSession, root: str, schema, at: int | None = None) -> DataFrame:
    """The rows of a version, with the columns of ``schema``."""
    files = [r["file"] for r in manifest(spark, root, at).select("file").toLocalIterator()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` versions and every shard and manifest that none of these names; the number deleted.

    Not while a writer works: what it has not committed yet would go too.
    """
    last = version(spark, root)
    kept = range(max(1, last - keep + 1), last + 1)
    folders = {spark.read.text(f"{root}/versions/v{at:08d}").first()[0].rsplit("/", 1)[1] for at in kept}
    named = {r["file"].rsplit("/", 1)[1] for at in kept for r in manifest(spark, root, at).select("file").toLocalIterator()}
    gone = []
    for part in ("versions", "manifests", "data"):
        path, fs = _fs(spark, f"{root}/{part}")
        for status in fs.listStatus(path) if fs.exists(path) else ():
            name = status.getPath().getName()
            if part == "versions":
                if name.startswith(".") or int(name[1:]) not in kept:
                    gone.append(status.getPath())
            elif part == "manifests":
                if name not in folders:
                    gone.append(status.getPath())
            else:
                gone += [f.getPath() for f in fs.listStatus(status.getPath()) if f.getPath().getName().startswith("part-") and f.getPath().getName() not in named]
    for path in gone:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)


#: Arrivals that the query's documents come in.
ARRIVALS = 4


def op3_tiered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, appended in arrivals by id hash, compacted, and read back from the live version."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = new_path(spark, "shards")
    for k in range(ARRIVALS):
        append(spark, root, docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == k))
    at = compact(spark, root, docs.schema)
    rows = read(spark, root, docs.schema, at)
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select("doc_id", "source", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("text_sha256"), F.lit(at).cast("long").alias("manifest_version"))


SQL = f"""
SELECT doc_id, source, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes, sha256(coalesce(text, '')) AS text_sha256,
       {ARRIVALS + 1}::BIGINT AS manifest_version
FROM documents
"""
