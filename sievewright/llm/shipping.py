"""Prepare a session for functions inside tasks: the package for the workers, the size of the batches they get."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import sievewright

#: Bytes of one Arrow batch. Spark's own limit lets a batch of long texts take ten times as much, in the executor and again
#: in the worker. A single longer row is a batch by itself.
BATCH_BYTES = 4 << 20

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to all workers, once per application: functions inside tasks import it there. Keep batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if spark.sparkContext.applicationId in _done:
        return
    root = os.path.dirname(os.path.abspath(sievewright.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="sievewright-"), "sievewright_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _done.add(spark.sparkContext.applicationId)
