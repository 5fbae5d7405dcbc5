"""Files out of zip and tar archives, and out of stored blobs.

Archives are read whole as binary files, one row each, and exploded where they are read; only entries that the path
rules admit are decompressed.
"""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records
from ..schemas import ARCHIVE_FILE


def _zip_entries(raw: BinaryIO) -> Iterator[tuple[str, int, Callable[[], bytes | None]]]:
    with zipfile.ZipFile(raw) as archive:
        for info in archive.infolist():
            if not info.is_dir():
                yield info.filename, info.file_size, lambda i=info: archive.read(i)


def _tar_entries(raw: BinaryIO) -> Iterator[tuple[str, int, Callable[[], bytes | None]]]:
    with tarfile.open(fileobj=raw, mode="r:*") as archive:
        for member in archive:
            if member.isfile():
                handle = archive.extractfile(member)
                yield member.name, member.size, lambda h=handle: None if h is None else h.read()


def entries(raw: bytes | BinaryIO, admits: Callable[[str, int], bool] = lambda path, size: True) -> Iterator[tuple[int, str, int, bytes]]:
    """ord, path below the archive's root folder, size and content of the files that ``admits`` takes, in archive order."""
    file = io.BytesIO(raw) if isinstance(raw, bytes) else raw
    is_zip = zipfile.is_zipfile(file)
    file.seek(0)
    opened = _zip_entries(file) if is_zip else _tar_entries(file)
    for ord_, (name, size, content) in enumerate(opened):
        _, root, path = name.partition("/")
        if root and path and admits(path, size) and (data := content()) is not None:
            yield ord_, path, size, data


def admitting(extensions: tuple[str, ...], ignored: frozenset[str], max_size: int | None = None) -> Callable[[str, int], bool]:
    """The path rules (and the size, if given) as a function of path and size."""

    def admits(path: str, size: int) -> bool:
        *folders, _ = path.lower().split("/")
        return path.lower().endswith(extensions) and ignored.isdisjoint(folders) and (max_size is None or size <= max_size)

    return admits


def read_archives(spark: SparkSession, path: str, admits: Callable[[str, int], bool] = lambda path, size: True, max_archive_bytes: int | None = None) -> DataFrame:
    """archive, ord, file_path, size, raw of every admitted file of the archives at ``path``; archives above the limit are
    not read, as the length is tested before the content."""
    found = spark.read.format("binaryFile").load(path)
    if max_archive_bytes is not None:
        found = found.filter(F.col("length") <= max_archive_bytes)

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, raw in zip(frame["path"], frame["content"]):
                held, size = [], 0
                for row in entries(raw, admits):
                    held.append((archive, *row))
                    size += len(row[3])
                    if size > 32 << 20:
                        yield pd.DataFrame(held, columns=["archive", "ord", "file_path", "size", "raw"])
                        held, size = [], 0
                yield pd.DataFrame(held, columns=["archive", "ord", "file_path", "size", "raw"])

    return found.select("path", "content").mapInPandas(explode, ARCHIVE_FILE)


def decode(files: DataFrame) -> DataFrame:
    """``files`` with text; bytes that are not UTF-8 become U+FFFD."""
    return files.withColumn("text", records.utf8(F.col("raw")))


def decode_blobs(blobs: DataFrame) -> DataFrame:
    """``blobs`` (encoding, content) with text; other encodings than base64 have an error instead."""
    good = F.col("encoding") == "base64"
    text = records.utf8(F.unbase64(F.regexp_replace("content", r"\s", "")))
    return blobs.withColumns({"text": F.when(good, text), "error": F.when(~F.coalesce(good, F.lit(False)), F.concat(F.lit("unsupported encoding: "), F.coalesce("encoding", F.lit("none"))))})


def explode_tree(trees: DataFrame) -> DataFrame:
    """trees: repository, prefix, tree (array of entries).  Its files with their whole path, in listing order."""
    each = trees.select("repository", "prefix", F.posexplode("tree").alias("ord", "entry")).filter("entry.type = 'blob'")
    path = F.concat_ws("/", F.nullif(F.col("prefix"), F.lit("")), F.col("entry.path"))
    return each.select("repository", "ord", path.alias("file_path"), F.col("entry.sha").alias("sha"), F.col("entry.size").alias("size"))


def walk_tree(fetch: Callable[[str], dict], root: str) -> list[tuple[str, dict]]:
    """(prefix, entry) of all files of a tree, going into subtrees one by one only where the listing was cut short."""
    whole = fetch(root)
    if not whole.get("truncated"):
        return [("", e) for e in whole.get("tree", []) if e.get("type") == "blob"]
    found, todo = [], [("", root)]
    while todo:
        prefix, sha = todo.pop()
        for e in fetch(sha).get("tree", []):
            path = f"{prefix}{e['path']}"
            if e.get("type") == "tree":
                todo.append((f"{path}/", e["sha"]))
            elif e.get("type") == "blob":
                found.append((prefix, e))
    return found
