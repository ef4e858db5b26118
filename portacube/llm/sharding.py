"""Contiguous shards of nearly equal byte size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portacube.llm.ranks import with_prefix
from portacube.llm.scratch import Scratch

N_SHARDS = 40
ROW_OVERHEAD = 16


def shard_by_bytes(spark: SparkSession, rows: DataFrame, size: str, order: list[str],
                   n_shards: int = N_SHARDS) -> DataFrame:
    """Cut ``rows`` in ``order`` into ``n_shards`` contiguous shards at equal byte targets.

    Sizes are summed per range partition, the partition totals are
    accumulated, and a row goes to the shard in which the middle of its bytes
    falls.  Shards therefore differ from the target by at most one row at
    each end.  Adds ``shard`` (int), ``slot`` (place in the shard, gapless
    from 0) and ``byte_start`` (bytes of all rows before).

    Defined cases: null sizes count as 0; if all sizes are 0 every row goes
    to shard 0; null order keys come first; repeated rows each get a slot of
    their own; an empty input gives an empty result.  Only the columns given
    are shuffled: pass keys and sizes, and join texts by key where needed.
    """
    scratch = Scratch(spark, "shards")
    sized = rows.withColumn(size, F.coalesce(F.col(size), F.lit(0)).cast("long"))
    placed = with_prefix(sized, order, {"byte_start": size}, scratch, position="_pos")
    total = spark.read.parquet(scratch.path("ranged")).agg(F.coalesce(F.sum(size), F.lit(0)).alias("t"))
    middle = F.col("byte_start") * 2 + F.col(size)
    cut = F.expr(f"least({n_shards - 1}, greatest(0, "
                 f"cast(((byte_start * 2 + `{size}`) * {n_shards}) div (2 * greatest(_total, 1)) as int)))")
    placed = placed.withColumn("_total", total.scalar()).withColumn("_middle", middle).withColumn("shard", cut)
    placed = scratch.stage(placed.drop("_total", "_middle"), "placed")
    scratch.drop("ranged")
    # one row per shard
    firsts = placed.groupBy("shard").agg(F.min("_pos").alias("_first"))
    return (placed.join(F.broadcast(firsts), "shard")
            .withColumn("slot", (F.col("_pos") - F.col("_first")).cast("long")).drop("_pos", "_first"))


def shard_totals(sharded: DataFrame, size: str) -> DataFrame:
    """Rows, bytes and their share of the mean per shard (a report of ``n_shards`` rows)."""
    per = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"))
    everything = Window.partitionBy()
    return per.withColumn("of_mean", F.col("bytes") / F.avg("bytes").over(everything))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 40 contiguous byte-balanced shards by doc_id.

    A null text has no bytes (crc 0); its row still costs the overhead of 16.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shard_by_bytes(spark, rows, "size", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"),
                      "slot", F.lit(None).cast("int").alias("grown_shard"), "byte_start")
