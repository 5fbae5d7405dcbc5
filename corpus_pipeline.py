"""A corpus pipeline over ``documents``: clean, deduplicate, redact and pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; its result is written as
Parquet and read again for the next one.  All but the last return the columns of ``documents``.

Results for special cases, in any stage: an empty table gives an empty one; columns of any name pass through whole rows
untouched, but for text and n_chars where the text changes; null ids are documents of their own, which go where they
are near copies of others.  Null and empty texts
are rejected by the quality rules; given to later stages, they lose no line, are near-duplicates of each other, hold no
secret and are packed as their end token.  Rows that repeat are one document to line and near deduplication (of equal
rows one stays) and rows of their own elsewhere.  Of tied documents that with the least id stays, of equal lines those of
the greatest.  Texts of any length are taken whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sievecraft.llm import lines, packing, quality, secrets, simhash
from sievecraft.llm.common import remove, shared_folder
from sievecraft.shipping import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the failing lines of the others."""
    ship(spark)
    return quality.stage(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents hold stay in the last of these."""
    ship(spark)
    return lines.stage(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles are alike (0.8 or more), one stays."""
    ship(spark)
    return simhash.stage(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    ship(spark)
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences."""
    ship(spark)
    return packing.query_best_fit(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express fingerprints, similarity groups or tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:  # read by the next stage, which is written now
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
