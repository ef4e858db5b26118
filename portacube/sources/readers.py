"""Readers for operational and warehouse tables."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portacube.schemas import SOURCE_SCHEMAS, WAREHOUSE_SCHEMAS


def read_source(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet",
                **options) -> DataFrame:
    """Read one operational table with its declared schema.

    ``fmt='jdbc'`` reads a database table (pass ``url``, ``dbtable`` or
    ``query`` and, for parallel reads, ``partitionColumn``/``lowerBound``/
    ``upperBound``/``numPartitions``).  A failed read raises; it does not
    silently yield an empty table.
    """
    schema = SOURCE_SCHEMAS[name]
    reader = spark.read.options(**options)
    if fmt == "jdbc":
        df = reader.format("jdbc").load()
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return reader.schema(schema).format(fmt).load(path)


def read_sources(spark: SparkSession, root: str, fmt: str = "parquet", stamp: str | None = None,
                 optional: Collection[str] = ()) -> dict[str, DataFrame]:
    """All operational tables stored as ``<root>/<name>`` (S14 input).

    ``stamp`` names the column of the last change, read with every table
    (incremental loads need it).  Tables in ``optional`` may be absent and are
    then empty (S15); any other absent table is an error.
    """
    out = {}
    for name, schema in SOURCE_SCHEMAS.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        if name in optional and not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            out[name] = empty_table(spark, name)
            if stamp:
                out[name] = out[name].withColumn(stamp, F.lit(None).cast("timestamp"))
        elif stamp:
            whole = T.StructType([*schema.fields, T.StructField(stamp, T.TimestampType())])
            out[name] = spark.read.schema(whole).format(fmt).load(f"{root}/{name}")
        else:
            out[name] = read_source(spark, name, f"{root}/{name}", fmt)
    return out


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every warehouse table stored as ``<root>/<name>`` (parquet)."""
    return {n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in WAREHOUSE_SCHEMAS.items()}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """Typed empty table for an absent source or warehouse table."""
    schema = SOURCE_SCHEMAS.get(name) or WAREHOUSE_SCHEMAS[name]
    return spark.createDataFrame([], schema)
