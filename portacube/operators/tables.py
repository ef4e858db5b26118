"""Reusable table operators of the transform layer.

All of them are lazy DataFrame compositions.  Two design rules hold throughout:

* aggregate before joining, and prefer partial-aggregatable aggregates
  (``min_by``/``max_by``) over per-key windows, so one hot key never lands
  whole in a single task;
* nothing but bounded, one-row or one-row-per-partition data is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portacube.session import ensure_checkpoint_dir, shuffles_removed


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def fk_filter(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Keep rows whose ``key`` exists in ``parent`` (B1): a left semi join.

    Deliberate deviation: an empty parent removes every row (the original
    builders skipped the check for an empty parent, keeping orphans).
    """
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias("__fk"))
    return df.join(keys, df[key] == keys["__fk"], "left_semi")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows removed by the FK filter (B2): a left anti join; NULL keys are not orphans."""
    pk = parent_key or key
    keys = parent.select(F.col(pk).alias("__fk"))
    return df.where(F.col(key).isNotNull()).join(keys, df[key] == keys["__fk"], "left_anti")


def orphan_count(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """One-row DataFrame ``(orphans)`` with the number of rows the FK filter drops."""
    return orphans(df, key, parent, parent_key).agg(F.count(F.lit(1)).cast("long").alias("orphans"))


def lookup_last(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
                values: Sequence[str], order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Dictionary lookup key -> value(s) as a left join.

    Missing keys give NULL; for a duplicated key the *last* row wins, last
    meaning the greatest ``order_by`` value (default: the value itself).  The
    de-duplication is a ``max_by`` aggregate, so partial aggregation absorbs
    hot keys before the shuffle.
    """
    values = list(values)
    order = _cols(order_by) if order_by is not None else values
    if len(values) == 1 and len(order) == 1:
        # one value: a fixed-width max / max_by keeps this a hash aggregate
        pick = F.max(values[0]) if order == values else F.max_by(values[0], order[0])
        dedup = lookup.groupBy(F.col(lookup_key).alias("__lk")).agg(pick.alias(values[0]))
    else:
        dedup = (lookup.groupBy(F.col(lookup_key).alias("__lk"))
                 .agg(F.max_by(F.struct(*[F.col(v) for v in values]),
                               F.struct(*[F.col(o) for o in order])).alias("__v"))
                 .select("__lk", *[F.col("__v")[v].alias(v) for v in values]))
    base = df.drop(*[v for v in values if v in df.columns])
    return base.join(dedup, base[key] == dedup["__lk"], "left").drop("__lk")


def keep_first(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple.

    Implemented as ``min_by`` aggregates — partial aggregation, not a per-key
    window — so a key holding a third of the data is combined map-side
    instead of sorted in one task.  With a single order column every value
    column gets its own ``min_by`` (a hash aggregate for fixed-width values,
    a map-side-combined sort aggregate for strings; the order column must
    then be unique within a key); otherwise the row and the order are packed
    in structs.
    """
    keys, order = _cols(keys), _cols(order_by)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    if len(order) == 1:
        picked = df.groupBy(*keys).agg(*[(F.min(c) if c == order[0] else F.min_by(c, order[0])).alias(c)
                                         for c in others])
        return picked.select(*df.columns)
    picked = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*[F.col(c) for c in others]),
                            F.struct(*[F.col(o) for o in order])).alias("__row")))
    return picked.select(*[F.col("__row")[c].alias(c) if c not in keys else F.col(c)
                           for c in df.columns])


MATERIALIZE_CONF = "portacube.materialize.dir"


def _materialize(df: DataFrame, tag: str) -> tuple[DataFrame, Callable[[], None]]:
    """Write ``df`` once; returns its read-back (lineage cut, no recomputation) and how to remove it.

    The folder is ``portacube.materialize.dir`` where the batch job sets it
    (its staging area on the shared file system), else the session's
    checkpoint folder; what is left there goes when the session ends.
    """
    spark = df.sparkSession
    root = spark.conf.get(MATERIALIZE_CONF, None) or ensure_checkpoint_dir(spark)
    path = f"{root}/{tag}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    stored = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = stored.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(stored)
    return spark.read.schema(df.schema).parquet(path), lambda: files.delete(stored, True)


def stored_once(df: DataFrame, tag: str) -> DataFrame:
    """``df`` evaluated and written once, for a table that several others are built from; its read-back."""
    return _materialize(df, tag)[0]


def dense_id(df: DataFrame, order_by: Sequence[str | Column], name: str = "id",
             first: bool = True, stored: bool = False, keep: Sequence[str] | None = None) -> DataFrame:
    """Sequential surrogate key 1..n in ``order_by`` order (B5).  Runs two jobs when called.

    Scalable and deterministic: the input is evaluated and staged once, then a
    global range-partitioned sort (a hot leading key is split across
    partitions by the remaining sort columns) stamps every row with its sort
    partition and position (``monotonically_increasing_id``); that stamped
    copy is staged too, and the first copy removed, so the layout is fixed
    across executor loss and recomputation.  Per-partition offsets (one row
    per partition, broadcast) turn positions into ids.  ``order_by`` must be a
    total order for the result to be fully repeatable (end it with the
    natural key).  An input that is ``stored`` already is not staged again,
    nor needs one to be that is cheap to evaluate from its shuffles twice: once
    to find the ranges, once to be sorted.  ``keep`` names the columns of the
    result; the others of ``df`` serve the order only and are not stored.
    """
    kept = list(df.columns if keep is None else keep)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    staged, drop = (df, lambda: None) if stored else _materialize(df, "dense-in")
    fixed, _ = _materialize(staged.orderBy(*order).select(*kept, F.monotonically_increasing_id().alias("__mid")),
                            "dense-sorted")
    drop()
    with_pid = (fixed.withColumn("__pid", F.shiftright(F.col("__mid"), 33))
                .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = with_pid.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    out = (with_pid.join(F.broadcast(offsets), "__pid")
           .withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos") + 1).cast("long"))
           .drop("__mid", "__pid", "__pos", "__off"))
    cols = [name] + [c for c in kept if c != name] if first else kept + [name]
    return out.select(*cols)


def date_bounds(dated: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One-row ``(lo, hi)`` of all non-missing dates in the given table columns.

    Each table is scanned once — one partial aggregate over all its date
    columns — so only one row per table is unioned.
    """
    parts = []
    for df, cols in dated:
        ds = [F.col(c).try_cast("date") for c in cols]
        lo = F.least(*[F.min(d) for d in ds]) if len(ds) > 1 else F.min(ds[0])
        hi = F.greatest(*[F.max(d) for d in ds]) if len(ds) > 1 else F.max(ds[0])
        parts.append(df.agg(lo.alias("lo"), hi.alias("hi")))
    if not parts:
        raise ValueError("no date columns given")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def calendar(bounds: DataFrame, extend_start: str | None = None, extend_end: str | None = None,
             default: tuple[str, str] | None = None) -> DataFrame:
    """Daily calendar ``(ID_Tiempo, Fecha, Dia, Mes, Anio)`` over ``bounds``.

    The range is widened to ``extend_start``/``extend_end`` when given; with no
    dates at all ``default`` is used.  ``ID_Tiempo`` is ``days since start + 1``
    — dense by construction, no window needed.  The row count is bounded by
    the date range (days), not by the data volume.
    """
    lo, hi = F.col("lo"), F.col("hi")
    if default is not None:
        lo = F.coalesce(lo, F.to_date(F.lit(default[0])))
        hi = F.coalesce(hi, F.to_date(F.lit(default[1])))
    if extend_start is not None:
        lo = F.least(lo, F.to_date(F.lit(extend_start)))
    if extend_end is not None:
        hi = F.greatest(hi, F.to_date(F.lit(extend_end)))
    days = (bounds.select(lo.alias("lo"), hi.alias("hi"))
            .where(F.col("lo").isNotNull())
            .select("lo", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("Fecha")))
    return days.select(
        (F.datediff("Fecha", "lo") + 1).cast("int").alias("ID_Tiempo"),
        "Fecha",
        F.dayofmonth("Fecha").alias("Dia"),
        F.month("Fecha").alias("Mes"),
        F.year("Fecha").alias("Anio"),
    )


def calendar_summary(cal: DataFrame) -> DataFrame:
    """One-row ``(cal_start, cal_days)`` of a calendar: the base and size of its keys."""
    return cal.agg(F.min("Fecha").alias("cal_start"), F.count(F.lit(1)).cast("int").alias("cal_days"))


def union_tagged(parts: Sequence[tuple[DataFrame, dict]]) -> DataFrame:
    """Concatenate tables, adding constant tag columns per part."""
    out = None
    for df, tags in parts:
        tagged = df.select(*df.columns, *[F.lit(v).alias(k) for k, v in tags.items()])
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
