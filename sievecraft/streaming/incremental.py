"""The file gates as a stream: texts that land in a folder are judged and deduplicated against all that came before.

The registry of hashes is a table that every batch reads and then extends; a batch's folder is named by its number and
overwritten when the batch is repeated, so a batch that breaks off leaves nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Dedup, FileFilter, Quality
from ..operators import files

FILES = "repository string, ord long, file_path string, text string"
_REGISTRY = "hash_type string, hash_value string, batch long"


def _registry(spark: SparkSession, folder: str, before: int) -> DataFrame:
    """Hashes of all earlier batches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _REGISTRY)
    return spark.read.schema(_REGISTRY).parquet(folder).filter(F.col("batch") < before)


def run(spark: SparkSession, source: str, out: str, file_filter: FileFilter, quality: Quality, dedup: Dedup = Dedup(), python: bool = True) -> StreamingQuery:
    """Takes all that has landed (Parquet of ``FILES``) and ends; a later call goes on from there."""

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        judged = files.process(rows, file_filter, quality, python=python)
        if not python:
            judged = judged.withColumn("structural_hash", F.col("exact_hash"))
        clear = judged.filter("reason is null")
        unique = files.dedup(clear, _registry(session, f"{out}/registry", number), ["repository", "ord"], dedup).filter("duplicate is null").drop("duplicate")
        accepted = f"{out}/accepted/batch={number}"
        unique.select("repository", "ord", "file_path", "code", "exact_hash", "structural_hash").write.mode("overwrite").parquet(accepted)
        written = session.read.parquet(accepted)
        kinds = ["exact", *(["structural"] if dedup.structural else [])]
        each = [written.select(F.lit(k).alias("hash_type"), F.col(f"{k}_hash").alias("hash_value")).distinct() for k in kinds]
        hashes = each[0] if len(each) == 1 else each[0].union(each[1])
        hashes.write.mode("overwrite").parquet(f"{out}/registry/batch={number}")

    stream = spark.readStream.schema(FILES).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/progress").trigger(availableNow=True).start()
