"""The package for Python workers that don't have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ARCHIVE = "somnolake-package.zip"
# Texts differ in size by orders: batches for Python workers end by bytes, unless the session says otherwise.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's sources to all executors, once a Spark context; Spark serves the file."""
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    context = spark.sparkContext
    if not any(name.endswith(ARCHIVE) for name in context._python_includes):
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="somnolake-")) / ARCHIVE
        with zipfile.ZipFile(target, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
    return spark
