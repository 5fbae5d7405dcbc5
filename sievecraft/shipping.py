"""Prepares a session: brings this package to the executors, which need not have it installed, and keeps batches small."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends the package's modules along with the application's tasks, once for each application.

    Rows here are whole texts, so where the session has Arrow's default of 10,000 rows a batch, it gets 1,000.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, "1000")
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="sievecraft-")) / "sievecraft.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for module in sorted(package.rglob("*.py")):
            archive.write(module, module.relative_to(package.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
