"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm.ranks import with_prefix
from portacube.llm.scratch import Scratch

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words of a text: runs of characters that are no ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, budget: float, max_epochs: float, scratch: Scratch) -> DataFrame:
    """Targets of ``sources`` (source_size, weight): weight shares of ``budget``, capped at ``max_epochs`` sizes.

    Each round clamps every source whose share of the remaining budget is
    above its cap and shares the excess out again by weight, until no source
    is above.  A round is one aggregate over the source table; three numbers
    reach the driver.  If the budget exceeds all caps, every source stops at
    its cap.  Sources of size 0 get 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        free = sources.agg(F.sum(F.when(over, 1).otherwise(0)).alias("n"),
                           F.sum(F.when(over, cap).otherwise(0.0)).alias("taken"),
                           F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("w")).first()
        if (free["n"] or 0) == clamped or not free["w"]:
            break
        clamped, level = free["n"], (budget - free["taken"]) / free["w"]
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.least(cap, share).cast("double"))


def mix(spark: SparkSession, docs: DataFrame, source: str = "source", size: str = "size", key: str = "doc_id",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """Decide how many words the mix takes of every document.

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share ``share`` times all words; ``water_fill`` gives their targets.  With
    target / size = whole + fraction, each document is repeated ``whole``
    times.  The fraction is drawn in a seeded order of the source's
    documents: they are taken once more until the source's words are full,
    and the one at the boundary gives only its first words.  So the words
    taken equal the target rounded down, and no document exceeds
    ``max_epochs`` times its size.

    Adds ``source_size``, ``target`` (its source's) and ``taken``; columns of
    the same names in ``docs`` are replaced.  Defined cases: null and empty
    texts have size 0 and are never taken; a null source is a source of its
    own; rows with equal keys are separate documents; an empty input gives an
    empty result; reruns agree whatever the partitioning, but for rows equal
    in key, source and size, which are interchangeable.
    """
    scratch = Scratch(spark, "mix")
    docs = docs.drop("source_size", "target", "taken")
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    rows = docs.withColumns({"_null": F.col(source).isNull(), "_draw": draw})
    # source, then the seeded draw: positions of one source are contiguous, and a hot source spans many partitions
    placed = scratch.stage(with_prefix(rows, ["_null", source, "_draw", key, size], {"_before": size}, scratch),
                           "placed")
    scratch.drop("ranged")
    per = scratch.stage(placed.groupBy("_null", source).agg(F.sum(size).alias("source_size"),
                                                            F.min("_before").alias("_first")), "sources")
    ranked = with_prefix(per, ["_null", source], {}, scratch, "ranked", "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = scratch.stage(ranked.withColumn("weight", weight), "weighed")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(ranked, total * share, max_epochs, scratch).withColumnRenamed(source, "_source")
    joined = placed.alias("d").join(
        filled.drop("_rank", "weight").withColumnRenamed("_null", "_no_source"),
        F.col(f"d.{source}").eqNullSafe(F.col("_source")), "left")
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.floor(F.col("target")) - whole * F.col("source_size")
    extra = F.least(F.col(size), F.greatest(F.lit(0), rest - (F.col("_before") - F.col("_first"))))
    taken = F.coalesce(whole * F.col(size) + extra, F.lit(0)).cast("long")
    return joined.withColumn("taken", taken).select(
        *docs.columns, "source_size", "target", "taken")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the words the mix takes of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    return mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken", "source")
