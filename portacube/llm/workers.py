"""The package on Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

import portacube

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give every Python worker of the application this package, whatever folder it starts in."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(portacube.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "portacube.zip")  # the driver serves it to the workers
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("portacube", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


@contextmanager
def batch_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs begun inside give Python workers batches of about ``size`` bytes (or one row)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)
