"""Pivot with margins (M1–M5) in long form.

The canonical result is *long*: one row per (row keys, column keys) cell plus
the margin rows, produced by a single ``GROUPING SETS ((R, C), (R), (C), ())``
aggregate — one scan, one shuffle, partial aggregation map-side.  Margin rows
carry the margin label in the key columns and ``grouping_id`` tells them
apart.  ``to_wide`` pivots a long result into ``measure__colvalue`` columns
for display when the column domain is small.

Semantics follow the classic spreadsheet pivot table:

* rows whose row or column key is missing are ignored everywhere;
* cells aggregate every remaining row, margins only rows in which *all*
  used measures are present;
* a cell's sum over only missing values is 0, its mean is missing; a
  margin with no complete row is missing;
* a cell or margin whose measures are all missing is dropped, then
  ``fill_value`` replaces missing values.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portacube.functions import exprs as X

AGGREGATIONS = ("sum", "mean", "count", "min", "max", "mean100")


def agg_column(kind: str, c: Column, integral: bool = False) -> Column:
    """Aggregation name -> aggregate ``Column`` (M2).  ``mean100`` is mean x 100.

    Sums and means of non-integral measures are exact (``exprs.exact_sum``),
    so cells do not depend on partitioning.
    """
    if kind == "sum":
        return F.sum(c) if integral else X.exact_sum(c)
    if kind == "mean":
        return X.exact_mean(c)
    if kind == "count":
        return F.count(c)
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    if kind == "mean100":
        return X.exact_mean(c) * F.lit(100.0)
    raise ValueError(f"unknown aggregation {kind!r}; expected one of {AGGREGATIONS}")


def default_aggregation(measure: str) -> str:
    """Aggregation chosen from the measure name (M4); first matching rule wins."""
    from portacube.schemas import NAME_AGG_RULES
    for needles, kind in NAME_AGG_RULES:
        if any(n in measure for n in needles):
            return kind
    return "sum"


def crosstab(df: DataFrame, rows: Sequence[str], cols: Sequence[str] = (),
             measures: Mapping[str, str] | None = None, *, fill_value=None, margins: bool = True,
             margins_name: str = "All", drop_empty: bool = True) -> DataFrame:
    """Long-form pivot table with margins.

    Output columns: row keys, column keys (as strings, margin label where a
    key is aggregated away), ``grouping_id`` (Spark bit order: first key is
    the most significant bit) and one column per measure.
    """
    rows, cols = list(rows), list(cols)
    keys = rows + cols
    if not keys:
        raise ValueError("need at least one row or column key")
    measures = dict(measures or {})
    if not measures:
        raise ValueError("need at least one measure")
    for name in keys + list(measures):
        if name not in df.columns:
            raise ValueError(f"column {name!r} not in data")
    data = df.select(*keys, *[F.col(m) for m in dict.fromkeys(measures)])
    data = data.where(F.lit(True) if not keys else
                      _all([F.col(k).isNotNull() for k in keys]))
    present = _all([F.col(m).isNotNull() for m in measures])

    sets = [keys]
    if margins:
        if rows and cols:
            sets += [rows, cols, []]
        else:
            sets += [[]]
    gid = F.grouping_id(*keys)
    aggs = []
    for m, kind in measures.items():
        integral = isinstance(df.schema[m].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
        # one aggregate per measure: margin rows (grouping id != 0) only see the
        # value where every measure is present; the mask is evaluated on the
        # Expand output, before the partial aggregate
        value = F.when((gid == 0) | present, F.col(m)) if margins else F.col(m)
        expr = agg_column(kind, value, integral)
        if kind == "sum":
            # a cell whose values are all missing sums to 0; a margin without
            # any complete row stays missing
            expr = F.when(gid == 0, F.coalesce(expr, F.lit(0))).otherwise(expr)
        aggs.append(_typed(kind, expr, df.schema[m].dataType).alias(m))
    grouped = data.groupingSets(sets, *keys).agg(gid.cast("int").alias("grouping_id"), *aggs)
    if drop_empty:
        grouped = grouped.where(_any([F.col(m).isNotNull() for m in measures]))
    label = F.lit(margins_name)
    out = grouped.select(
        *[F.when(F.col("grouping_id").bitwiseAND(1 << (len(keys) - 1 - i)) != 0, label)
          .otherwise(F.col(k).cast("string")).alias(k) for i, k in enumerate(keys)],
        "grouping_id",
        *[(F.coalesce(F.col(m), F.lit(fill_value).cast(_out_type(kind, df.schema[m].dataType)))
           if fill_value is not None else F.col(m)).alias(m) for m, kind in measures.items()])
    return out


def _typed(kind: str, expr: Column, dtype) -> Column:
    return expr.cast(_out_type(kind, dtype))


def _out_type(kind: str, dtype) -> str:
    from pyspark.sql import types as T
    if kind == "count":
        return "long"
    if kind in ("mean", "mean100"):
        return "double"
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return "long"
    if isinstance(dtype, T.DecimalType):
        return "double"
    return dtype.simpleString()


def _all(conds: list[Column]) -> Column:
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def densify(long_df: DataFrame, rows: Sequence[str], cols: Sequence[str],
            domains: Mapping[str, Sequence], measures: Mapping[str, str], fill_value=0) -> DataFrame:
    """Add the unobserved category combinations of the cell rows (M5).

    Every key needs a fixed domain (category lists, e.g. the bin labels) except
    at most one, whose observed values are used.  The crosstab is computed
    once: each cell row also stands for the empty cells of its free value
    (without one, the empty cells are literals), and one aggregate keeps the
    filled cell of each key.  Empty cells get ``fill_value``; with None, sums
    and counts are 0 and means NULL.  Margins pass through.
    """
    keys = list(rows) + list(cols)
    free = [k for k in keys if k not in domains]
    if len(free) > 1:
        raise ValueError(f"at most one key without a fixed domain, got {free}")
    kinds = {m: long_df.schema[m].dataType for m in measures}
    combos = list(itertools.product(*[[str(v) for v in domains[k]] for k in keys if k in domains]))

    def empty(combo):
        fixed = iter(combo)
        return F.struct(*[(F.lit(next(fixed)) if k in domains else F.col(k)).cast("string").alias(k) for k in keys],
                        F.lit(0).alias("grouping_id"), *[F.lit(None).cast(t).alias(m) for m, t in kinds.items()])
    own = F.struct(*[F.col(k).cast("string").alias(k) for k in keys], F.col("grouping_id").cast("int").alias("grouping_id"),
                   *[F.col(m) for m in measures])
    if free:
        cells = F.when(F.col("grouping_id") == 0, F.array(own, *[empty(c) for c in combos])).otherwise(F.array(own))
        laid = long_df.select(F.explode(cells).alias("x")).select("x.*")
    else:
        empties = long_df.sparkSession.range(1).select(F.explode(F.array(*[empty(c) for c in combos])).alias("x"))
        laid = long_df.select(own.alias("x")).select("x.*").unionByName(empties.select("x.*"))
    full = laid.groupBy(*keys, "grouping_id").agg(*[F.max(m).alias(m) for m in measures])

    def filled(m, kind):
        fill = fill_value if fill_value is not None else (0 if kind in ("sum", "count") else None)
        return F.when(F.col("grouping_id") == 0, F.coalesce(F.col(m), F.lit(fill).cast(kinds[m]))).otherwise(
            F.col(m)).alias(m)
    return full.select(*keys, "grouping_id", *[filled(m, k) for m, k in measures.items()])


def to_wide(long_df: DataFrame, rows: Sequence[str], col: str, measures: Sequence[str],
            values: Sequence[str], sep: str = "__") -> DataFrame:
    """Wide view ``measure{sep}colvalue`` of a long crosstab with one column key.

    ``values`` is the column domain: nothing is collected to find it.
    """
    wide = long_df.groupBy(*rows).pivot(col, list(values)).agg(*[F.first(m).alias(m) for m in measures])
    if len(measures) == 1:
        return wide.select(*rows, *[F.col(f"`{c}`").alias(f"{measures[0]}{sep}{c}")
                                    for c in wide.columns if c not in rows])
    # Spark names multi-aggregate pivot columns "<value>_<alias>"; the alias is the
    # measure name, so strip it from the end (values may contain "_")
    ren = []
    for c in wide.columns:
        if c in rows:
            ren.append(F.col(c))
            continue
        m = next(m for m in sorted(measures, key=len, reverse=True) if c.endswith("_" + m))
        ren.append(F.col(f"`{c}`").alias(f"{m}{sep}{c[:-len(m) - 1]}"))
    return wide.select(*ren)
