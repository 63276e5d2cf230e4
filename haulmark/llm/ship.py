"""The package as a zip for executors that do not have it, and rows for their Python workers in small batches."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

#: Bytes of rows that go to a Python worker in one go. By Spark's default these are 10,000 rows of any
#: length, which an executor holds for each task, while it writes them up to three times, and the worker again.
BATCH_BYTES = 4 << 20
_MOST = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: SparkContext | None = None


def ship(spark: SparkSession) -> None:
    """Adds this package to the files of the application, once; as ``--py-files`` would."""
    global _shipped
    context = spark.sparkContext
    if _shipped is context:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder, name = os.path.split(package)
    with tempfile.TemporaryDirectory(prefix="package-") as work:
        copy = os.path.join(work, "copy")
        shutil.copytree(package, os.path.join(copy, name), ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="package-"), name), "zip", copy))
    _shipped = context


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python workers of at most ``BATCH_BYTES``, in this session; a lower bound that is set stays."""
    now = spark.conf.get(_MOST)
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_MOST, str(BATCH_BYTES))
