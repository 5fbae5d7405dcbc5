"""Versioned snapshots of the state tables.

A version is a folder with a Parquet table each; a marker file in it, written last, makes it count.  A run reads one
version and writes the next whole, so a run that breaks off leaves the state as it was.  One writer is assumed.  All
paths go through Hadoop's file system API, so any store that Spark can write holds the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STATE

_MARK = "_COMMITTED"


class Snapshots:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}".rstrip("/"))

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        if not self._fs.exists(self._path("")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
        return [n for n in numbers if self._fs.exists(self._path(f"v={n}/{_MARK}"))]

    def read(self) -> dict[str, DataFrame]:
        """The tables of the last committed version; empty ones where there is none."""
        found = self.versions()
        if not found:
            return {t: self.spark.createDataFrame([], schema) for t, schema in STATE.items()}
        return {t: self.spark.read.schema(schema).parquet(f"{self.folder}/v={found[-1]}/{t}") for t, schema in STATE.items()}

    def commit(self, tables: dict[str, DataFrame], keep: int = 2) -> int:
        """Writes the next version (tables left out stay as they are), then drops all but the last ``keep``."""
        found = self.versions()
        number = (found[-1] if found else 0) + 1
        before = self.read()
        for name, schema in STATE.items():
            table = tables.get(name, before[name])
            columns = [c.split()[0] for c in schema.split(", ")]
            table.select(columns).write.mode("overwrite").parquet(f"{self.folder}/v={number}/{name}")
        self._fs.create(self._path(f"v={number}/{_MARK}"), True).close()
        for old in found[: max(0, len(found) + 1 - keep)]:
            self._fs.delete(self._path(f"v={old}"), True)
        return number

    def reset(self) -> None:
        """Forgets everything."""
        self._fs.delete(self._path(""), True)
