"""What the Python side of the operators needs of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

import tillmetrics
from pyspark.sql import SparkSession

#: Texts are long, so batches to Python are bounded by bytes, not by rows alone.
BATCH_BYTES = "4m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, unless it does so itself, and add this package to
    its Python files, once per application, so that the executors' workers can import it.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(tillmetrics.__file__)))
    folder = tempfile.mkdtemp(prefix="tillmetrics-ship-")
    copy = os.path.join(folder, "copy")
    shutil.copytree(
        os.path.join(root, "tillmetrics"),
        os.path.join(copy, "tillmetrics"),
        ignore=shutil.ignore_patterns("__pycache__"),
    )
    archive = shutil.make_archive(os.path.join(folder, "tillmetrics"), "zip", copy)
    context.addPyFile(os.path.abspath(archive))
    _shipped.add(context.applicationId)
