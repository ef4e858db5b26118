"""Staged intermediate tables in the session's shared checkpoint folder.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading
it back, so a lost executor costs a re-read and no recomputation of what came
before.  Every folder is registered for removal when the session ends;
``drop`` removes a table as soon as nothing reads it any more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from portacube.session import ensure_checkpoint_dir


class Scratch:
    """A private folder of staged tables below the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(path)
        self.fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def folder(self, name: str) -> str:
        """An empty folder for files that tasks write themselves."""
        self.fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)))
        return self.path(name)

    def drop(self, *names: str) -> None:
        for name in names:
            self.fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)
