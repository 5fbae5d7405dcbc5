"""JSON Lines datasets as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The texts of a dataset; blank lines, broken ones and empty texts are left out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", "text string", {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.text").filter("text <> ''")
