"""What a run writes: JSON Lines by split, the manifest, the text export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records
from ..schemas import MANIFEST

MANIFEST_FIELDS = [f.split()[0] for f in MANIFEST.split(", ")]


def metadata() -> Column:
    return F.struct(*MANIFEST_FIELDS)


def write_records(accepted: DataFrame, path: str, with_metadata: bool, mode: str = "append") -> None:
    """A line of JSON for each row (code and the manifest's fields)."""
    row = records.record(F.col("code"), metadata() if with_metadata else None)
    accepted.select(row.alias("r")).select("r.*").write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_manifest(accepted: DataFrame, path: str, mode: str = "append") -> None:
    accepted.select(MANIFEST_FIELDS).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_text_export(texts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All texts, each with the mark that ends it."""
    # the writer ends each row with a line feed, which is the mark's last one
    value = F.regexp_replace(records.export_text(F.col("text")), r"\n\z", "")
    texts.filter("text <> ''").select(value.alias("value")).write.mode(mode).text(path)


def folder_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below the paths; a path that is missing has none."""
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total
