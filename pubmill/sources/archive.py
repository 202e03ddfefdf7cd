"""Daily archives: ZIP files of XML publications, and HTML pages."""

from __future__ import annotations

import os
import re
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pubmill.functions import text as T

# The XML tags read, matched without regard to case or namespace.
TAGS = ("identifica", "data", "ementa", "titulo", "subtitulo", "texto")


#: Bytes of an archive that a task reads at most, by the archive's size and the number of its entries.
SPLIT = 64 << 20
#: Characters of entries that a Python worker holds at a time, but for one entry that is longer.
BATCH = 4 << 20
_ENTRY = "zip string, xml_name string, place int, " + ", ".join(f"{t} string" for t in TAGS) + ", error string"


def _fields(xml: str) -> tuple[dict[str, str], str | None]:
    """The text of the first element of each tag, and why there is none where the XML is malformed."""
    try:
        root = ElementTree.fromstring(xml)
    except (ElementTree.ParseError, ValueError) as e:
        return {}, f"malformed XML: {e}"
    held: dict[str, str] = {}
    for element in root.iter():
        name = element.tag.rsplit("}", 1)[-1].lower() if isinstance(element.tag, str) else ""
        if name in TAGS and name not in held:
            held[name] = "".join(element.itertext()).strip()
    return held, None


def _natural(name: str) -> list:
    return [(0, int(p), "") if p.isascii() and p.isdigit() else (1, 0, p) for p in re.split(r"([0-9]+)", name) if p]


def _entries(name: str, file: BinaryIO, strict: bool, part: int = 0, parts: int = 1) -> Iterator[tuple]:
    """Rows of one of the parts of an archive's XML entries, which are numbered in natural order and dealt in turn; a broken archive is one row of its first part."""
    none = (None,) * len(TAGS)
    try:
        with zipfile.ZipFile(file) as z:
            names = sorted((e for e in z.namelist() if e.lower().endswith(".xml")), key=_natural)
            for k in range(part, len(names), parts):
                try:
                    held, error = _fields(z.read(names[k]).decode("utf-8-sig", "replace"))
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError) as e:
                    if strict:
                        raise ValueError(f"broken entry {names[k]} of {name}: {e}") from e
                    held, error = {}, f"broken entry: {e}"
                yield (name, names[k], k + 1, *(held.get(t) for t in TAGS), error)
    except (zipfile.BadZipFile, pa.ArrowInvalid) as e:
        if strict:
            raise ValueError(f"broken archive {name}: {e}") from e
        if part == 0:
            yield (name, None, None, *none, f"broken archive: {e}")


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark takes it (not encoded), and the path there."""
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(quote(path, safe=":/?&=@+,"))
    return fs.LocalFileSystem(), os.path.abspath(re.sub("^file:(//)?", "", path))


class _Part(InputPartition):
    def __init__(self, path: str, part: int, parts: int):
        self.path, self.part, self.parts = path, part, parts


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.strict = options["path"], str(options.get("strict", "false")).lower() == "true"
        self.split = int(options.get("split", SPLIT))

    def partitions(self) -> list[InputPartition]:
        """By the files' sizes alone; an archive is opened where it is read."""
        system, root = _system(self.path)
        found = system.get_file_info(root)
        files = [found] if found.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        zips = sorted((f.path, f.size) for f in files if f.is_file and f.path.lower().endswith(".zip"))
        parts = [(path, max(1, -(-size // self.split))) for path, size in zips]
        return [_Part(path, k, n) for path, n in parts for k in range(n)] or [_Part("", 0, 0)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if not partition.parts:
            return
        system, _ = _system(self.path)
        with system.open_input_file(partition.path) as file:
            yield from _batches(_entries(partition.path, file, self.strict, partition.part, partition.parts))


def _batches(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Entries as they are read, in batches of 1,000 rows and about ``BATCH`` characters at most."""
    rows: list[tuple] = []
    size = 0
    for row in found:
        rows.append(row)
        size += sum(len(x) for x in row if isinstance(x, str))
        if len(rows) >= 1000 or size > BATCH:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["zip", "xml_name", "place", *TAGS, "error"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "place" else pa.string()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


class ArchiveSource(DataSource):
    """``spark.read.format("zip_xml")``: a row for each XML entry of the ZIP files below a path.

    An archive of several times ``split`` bytes is as many tasks, each of which reads the directory and then only
    its own entries, one at a time; no archive is ever held whole.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_xml"

    def schema(self) -> str:
        return _ENTRY

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_zips(spark: SparkSession, path: str, strict: bool = False, split: int = SPLIT) -> DataFrame:
    """(zip, xml_name, place, the text of each tag, error): a row for each XML entry.

    place counts an archive's entries in their natural order (numbers in names by
    value). A broken archive gives one row with an error, and so does a broken entry or one that is
    no well-formed XML; with ``strict`` a broken archive or entry fails the job instead.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("zip_xml").options(strict=str(strict).lower(), split=split).load(path)


def zip_entries(archives: DataFrame, strict: bool = False) -> DataFrame:
    """The same rows of archives (path, content) that are in a table, as ``binaryFile`` gives them, where only Spark reaches the files."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                yield from _batches(_entries(name, pa.BufferReader(content.as_buffer() if content.is_valid else b""), strict))

    return archives.select("path", "content").mapInArrow(entries, _ENTRY)


def parse_publications(entries: DataFrame) -> DataFrame:
    """Readable entries with the group and index that the file name ends in, and a title with its fallbacks."""
    out = entries.where("error is null").drop("error").select("zip", "xml_name", "place", *(F.coalesce(F.trim(t), F.lit("")).alias(t) for t in TAGS))
    stem = F.regexp_replace("xml_name", r"(?i)\.xml$", "")
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    index = F.coalesce(F.expr(r"try_cast(nullif(regexp_extract(xml_name, '-([0-9]+)[.][^.]*$', 1), '') as int)"), F.lit(1))
    title = F.coalesce(filled("identifica"), filled("ementa"), filled("titulo"), filled("subtitulo"), F.substring(filled("texto"), 1, 80), F.lit("Untitled"))
    return out.withColumn("xml_group", F.regexp_replace(stem, r"-\d+$", "")).withColumn("xml_index", index).withColumn("title", title)


def strip_html(markup: Column) -> Column:
    """Scripts, styles, comments and tags off, paragraph ends to line breaks, white space of lines reduced."""
    t = F.regexp_replace(markup, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?is)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)</p>|<br ?/?>", "\n")
    # a tag needs its ">": behind the last one none begins, and searching there would take each "<" to the end
    end = lambda x: F.length(x) - F.instr(F.reverse(x), ">") + 1
    parts = T.let(t, lambda x: T.let(F.when(F.contains(x, F.lit(">")), end(x)).otherwise(0), lambda n: F.struct(F.left(x, n).alias("closed"), F.right(x, F.length(x) - n).alias("open"))))
    t = T.let(parts, lambda p: F.concat(F.regexp_replace(p["closed"], "<[^>]*>", " "), p["open"]))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    return F.btrim(t, F.lit(" \n"))
