"""Counts of runs and of state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import reason_class

OUTCOMES = ("skipped_large_file", "rejected_security", "rejected_exact_duplicate", "rejected_structural_duplicate", "accepted", "storage_limit")


def status_counts(repositories: DataFrame) -> DataFrame:
    return repositories.groupBy("status").agg(F.count("*").alias("n"))


def hash_counts(registry: DataFrame) -> DataFrame:
    """Exact and structural hashes, in one pass."""
    return registry.agg(*(F.count_if(F.col("hash_type") == k).alias(k) for k in ("exact", "structural")))


def file_counts(files: DataFrame) -> DataFrame:
    """One row of the file counters; files: outcome, reason, findings."""
    kind = reason_class(F.col("reason"))
    rejected = F.col("outcome") == "rejected_quality"
    return files.agg(
        F.count("*").alias("files_attempted"),
        F.count_if(F.col("outcome") == "accepted").alias("files_accepted"),
        F.count_if(rejected & (kind == "cleaning")).alias("rejected_cleaning"),
        F.count_if(rejected & (kind == "quality")).alias("rejected_quality"),
        F.count_if((F.size("findings") > 0) & F.col("reason").isNull() & (F.col("outcome") != "skipped_large_file")).alias("rejected_security"),
        F.count_if(F.col("outcome") == "rejected_exact_duplicate").alias("rejected_exact_duplicate"),
        F.count_if(F.col("outcome") == "rejected_structural_duplicate").alias("rejected_structural_duplicate"),
        F.count_if(F.col("outcome") == "skipped_large_file").alias("skipped_large_file"),
        (F.count_if(F.col("outcome") == "storage_limit") > 0).alias("storage_limit_reached"),
    )
