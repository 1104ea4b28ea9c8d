"""The package on the executors, and the size of the batches it gets there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import millrace

_SENT: set[str] = set()
# Rows of a batch between Spark and its Python workers. Texts are long, so batches of Spark's usual 10 000 rows would
# take memory for nothing.
BATCH_ROWS = 1000


def shipped(spark: SparkSession) -> None:
    """Send this package to Python workers, unless they find it on the path they inherit; set smaller batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.abspath(millrace.__file__)))
    if context.applicationId in _SENT or home in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # Spark takes the file from the driver's disk and serves it to the executors.
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="millrace-")), "millrace.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(home, "millrace")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, home))
    context.addPyFile(target)
    _SENT.add(context.applicationId)
