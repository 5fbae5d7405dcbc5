"""Helpers that all operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of all contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all machines of a cluster share; a local one only where that is unset (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sievecraft-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, shuffle files go once their query has ended, as nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that a lost executor costs no recomputation; the shuffle files that led to
    it go."""
    shared_folder(df.sparkSession)
    with _cleaning(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_unique(left: DataFrame, key: str, right: DataFrame, other: str, n: str, share: int = 1000, least: int = 10_000) -> DataFrame:
    """``left`` joined with ``right``, whose ``other`` is unique and whose ``n`` says how many rows of ``left`` have it.

    Keys with more than a share of all rows are fewer than ``share``, so their rows of ``right`` are broadcast: the rows of
    ``left`` that have them stay where they are.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    hot = [r[0] for r in right.filter(F.col(n) > max(least, total / share)).select(other).collect()]
    same = F.col(key) == F.col(other)
    if not hot:
        return left.join(right, same)
    few = F.broadcast(right.filter(F.col(other).isin(hot)))
    return left.filter(~F.col(key).isin(hot)).join(right, same).union(left.filter(F.col(key).isin(hot)).join(few, same))


class Scratch:
    """Tables written to a folder of their own in the shared folder, which goes when they have been used."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.tables = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4()}", 0
        self.dropped = 0

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{self.tables}"
        self.tables += 1
        with _cleaning(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_only(self, df: DataFrame) -> DataFrame:
        """``df`` kept, and the tables before it gone."""
        out = self.keep(df)
        for i in range(self.dropped, self.tables - 1):
            remove(self.spark, f"{self.folder}/{i}")
        self.dropped = self.tables - 1
        return out

    def drop(self) -> None:
        remove(self.spark, self.folder)


def whole_text(text: Column | str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often and however deep in lambdas ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def running(items: Column, start: Column, none: Column, step, over=None, block: int = 256) -> tuple[Column, Column]:
    """What ``step(carry, item, given)`` gives, one item after another, as (found, carry at the end); step returns (carry, array
    of what it found).

    Items go in blocks, so that what has been found is copied once for each block and not for each item.  ``over(carry,
    items of the block)`` is computed once for each block and given to step.
    """

    def inner(part: Column, carry: Column, given: Column) -> Column:
        def one(state: Column, x: Column) -> Column:
            after, found = step(state["carry"], x, given)
            return F.struct(after.alias("carry"), F.concat(state["found"], found).alias("found"))

        return F.aggregate(part, F.struct(carry.alias("carry"), none.alias("found")), one)

    def outer(state: Column, k: Column) -> Column:
        def of(part: Column) -> Column:
            given = over(state["carry"], part) if over else F.lit(0)
            done = let(given, lambda g: inner(part, state["carry"], g))
            return let(done, lambda r: F.struct(r["carry"].alias("carry"), F.concat(state["found"], F.array(r["found"])).alias("found")))

        return let(F.slice(items, k * block + 1, F.lit(block)), of)

    blocks = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.floor((F.size(items) - 1) / block).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))
    done = F.aggregate(blocks, F.struct(start.alias("carry"), F.slice(F.array(none), 1, F.lit(0)).alias("found")), outer)
    return F.flatten(done["found"]), done["carry"]


def shards(df: DataFrame, size: Column, per_shard: int) -> int:
    """How many shards of about ``per_shard`` units the rows of ``df`` make; one at least."""
    total = df.agg(F.sum(size.cast("double"))).first()[0] or 0
    return max(1, -(-int(total) // per_shard))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as row_ (the whole row, and so the only copy of its text) and doc_id, so that no column clashes with ours."""
    return docs.select(F.struct(*docs.columns).alias("row_"), "doc_id")


def unpacked(found: DataFrame, columns: list[str], changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """The rows as they were; where ``changed`` holds, with another ``text`` and its length as n_chars."""
    row = {c: F.col("row_")[c] for c in columns}
    if changed is not None:
        kinds = {f.name: f.dataType for f in found.schema["row_"].dataType}
        row["text"] = F.when(changed, text).otherwise(row["text"])
        if "n_chars" in row:
            row["n_chars"] = F.when(changed, F.length(text).cast(kinds["n_chars"])).otherwise(row["n_chars"])
    return found.select(*(x.alias(c) for c, x in row.items()))
