"""Limits on what is written: bytes and records, in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(rows: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` with the running sum of ``value`` over (group, order).

    Groups (repositories, of which a run has a bounded number) are summed first; only their totals meet in one window,
    and the rows stay dealt by group.
    """
    rows = rows.withColumn("v_", value.cast("long"))
    totals = rows.groupBy(F.col(group).alias("g_")).agg(F.sum("v_").alias("t_"))
    before = totals.select("g_", (F.sum("t_").over(Window.orderBy("g_").rowsBetween(Window.unboundedPreceding, -1))).alias("b_"))
    inside = F.sum("v_").over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.withColumn("i_", inside).join(before, F.col(group) == F.col("g_"))
    return joined.withColumn(name, F.coalesce("b_", F.lit(0)) + F.col("i_")).drop("v_", "g_", "b_", "i_")


def within_bytes(accepted: DataFrame, group: str, order: list[str], size: Column, limit: int, start: int = 0) -> DataFrame:
    """``accepted`` with fits: whether the record and all before it stay within the limit (0: none); the running sum
    only grows, so nothing after the first overflow fits."""
    if limit <= 0:
        return accepted.withColumn("fits", F.lit(True))
    summed = running(accepted, group, order, size, "bytes_so_far")
    return summed.withColumn("fits", F.col("bytes_so_far") + start <= limit)


def first_records(accepted: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """The first ``most`` rows in order; 0 means all."""
    if most <= 0:
        return accepted
    return running(accepted, group, order, F.lit(1), "nth_").filter(F.col("nth_") <= most).drop("nth_")
