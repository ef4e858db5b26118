"""Global positions and prefix sums without a single-task window.

Rows are range-partitioned by their order, each partition is totalled, the
totals (one row per partition) are accumulated, and every row adds its
partition's base to a running sum inside its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portacube.llm.scratch import Scratch


def with_prefix(df: DataFrame, order: list, sums: dict[str, str], scratch: Scratch, name: str = "ranged",
                position: str = "pos") -> DataFrame:
    """Add ``position`` (0-based place in ``order``) and, per ``{new: column}``, the sum over all rows before.

    ``order`` lists column names; nulls come first.  Equal rows are told apart
    by a row tag, so a run of equal keys is split over several partitions.
    The range-partitioned rows are staged once: partition numbers stay fixed.
    """
    spark = scratch.spark
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tagged = df.withColumn("_tag", F.monotonically_increasing_id())
    keys = [*[F.col(c).asc_nulls_first() for c in order], F.col("_tag").asc()]
    ranged = scratch.stage(tagged.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), name)
    totals = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"),
                                         *[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                          *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_b_{new}") for new in sums])
    inside = Window.partitionBy("_part").orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    # bases has one row per shuffle partition
    out = ranged.join(F.broadcast(bases), "_part").select(
        *[F.col(c) for c in df.columns],
        (F.col("_base") + F.row_number().over(inside) - 1).cast("long").alias(position),
        *[(F.col(f"_b_{new}") + F.coalesce(F.sum(c).over(running), F.lit(0))).cast("long").alias(new)
          for new, c in sums.items()])
    return out
