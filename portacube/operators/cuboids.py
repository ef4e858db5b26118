"""Stored cuboids: cube operations from partial aggregates instead of the dataset.

A cuboid holds, per combination of its dimensions (missing values included),
the row count and of every measure an exact decimal sum, the number of
values, least and greatest value.  These states add up, so any coarser group
is an aggregate of cuboid rows: slice, dice, roll-up, drill-down and pivot
read the cuboid only.  Distinct counts do not add up; they are kept as
HyperLogLog sketches, which unite.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators.crosstab import _out_type, densify
from portacube.operators.cube import Cube
from portacube.schemas import MARGIN_TOTAL

ROWS = "__rows"
SKETCH_BITS = 14
#: relative error of a distinct count that three standard errors of a sketch allow
SKETCH_ERROR = 3 * 1.04 / (1 << SKETCH_BITS) ** 0.5


def cuboid(cube: Cube, levels: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """Partial states of ``cube`` by its dimensions and further ``levels``; sketches of the ``distinct`` columns."""
    states = [F.count(F.lit(1)).alias(ROWS)]
    for m in cube.measures:
        c = F.col(m).cast("double")
        states += [F.sum(c.cast(X.EXACT_SUM_TYPE)).alias(f"{m}__sum"), F.count(c).alias(f"{m}__n"),
                   F.min(c).alias(f"{m}__min"), F.max(c).alias(f"{m}__max")]
    states += [F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(f"{c}__hll") for c in distinct]
    return cube.data.groupBy(*dict.fromkeys([*cube.dimensions, *levels])).agg(*states)


class _OnStates(Cube):
    """The operations of a cube over its cuboid."""

    def __init__(self, cube: Cube, states: DataFrame):
        self.data, self.dimensions, self.measures = states, cube.dimensions, cube.measures
        self.types = {m: cube.data.schema[m].dataType for m in cube.measures}

    def _aggs(self, extra: bool = False) -> list[Column]:
        out = []
        for m in self.measures:
            out += [F.coalesce(self._total(m), F.lit(0.0)).alias(f"{m}_sum"),
                    F.coalesce(self._mean(m), F.lit(0.0)).alias(f"{m}_mean"),
                    F.coalesce(F.sum(f"{m}__n"), F.lit(0)).alias(f"{m}_count")]
            if extra:
                out += [F.min(f"{m}__min").alias(f"{m}_min"), F.max(f"{m}__max").alias(f"{m}_max")]
        return out

    def _carried(self) -> list[str]:
        return [f"{m}__{s}" for m in self.measures for s in ("sum", "n", "min", "max")]

    @staticmethod
    def _total(m: str) -> Column:
        return F.sum(f"{m}__sum").cast("double")

    def _mean(self, m: str) -> Column:
        return F.try_divide(self._total(m), F.sum(f"{m}__n").cast("double"))

    def _counted(self) -> DataFrame:
        return self.data.groupBy(*self.dimensions).agg(F.sum(ROWS).alias(ROWS))

    def pivot(self, rows: Sequence[str], cols: Sequence[str], measure: str, aggregation: str = "sum",
              domains: Mapping[str, Sequence] | None = None) -> DataFrame:
        """C7.  With one measure the rows that margins count, those that have it, are those its states hold."""
        if measure not in self.measures:
            raise ValueError(f"measure {measure!r} is not in the cube")
        rows, cols = list(rows), list(cols)
        keys = rows + cols
        for d in keys:
            self._check_dim(d)
        gid = F.grouping_id(*keys)
        value = {"sum": self._total(measure), "mean": self._mean(measure), "mean100": self._mean(measure) * 100.0,
                 "count": F.sum(f"{measure}__n"), "min": F.min(f"{measure}__min"),
                 "max": F.max(f"{measure}__max")}[aggregation]
        if aggregation == "sum":
            value = F.when(gid == 0, F.coalesce(value, F.lit(0.0))).otherwise(value)
        kind = _out_type(aggregation, self.types[measure])
        sets = [keys, rows, cols, []] if rows and cols else [keys, []]
        kept = self.data
        for k in keys:
            kept = kept.where(F.col(k).isNotNull())
        grouped = kept.groupingSets(sets, *keys).agg(gid.cast("int").alias("grouping_id"), value.cast(kind).alias(measure))
        out = grouped.where(F.col(measure).isNotNull()).select(
            *[F.when(F.col("grouping_id").bitwiseAND(1 << (len(keys) - 1 - i)) != 0, F.lit(MARGIN_TOTAL))
              .otherwise(F.col(k).cast("string")).alias(k) for i, k in enumerate(keys)], "grouping_id", measure)
        return densify(out, rows, cols, domains, {measure: aggregation}) if domains else out

    def distinct(self, column: str, dims: Sequence[str]) -> DataFrame:
        united = F.hll_sketch_estimate(F.hll_union_agg(f"{column}__hll"))
        if not dims:
            return self.data.agg(united.alias("distintos"))
        kept = self.data
        for d in dims:
            kept = kept.where(F.col(d).isNotNull())
        return kept.groupBy(*dims).agg(united.alias("distintos"))


class CubeSession:
    """A cube loaded once and asked many times (C11): from its cuboid where that has the columns, else from the data."""

    def __init__(self, cube: Cube, states: DataFrame):
        self.cube, self.states = cube, _OnStates(cube, states)
        self.dimensions, self.measures = cube.dimensions, cube.measures

    def _on(self, *columns: str) -> Cube:
        return self.states if set(columns) <= set(self.states.data.columns) else self.cube

    def base(self) -> DataFrame:
        return self.states.base()

    def slice(self, dimension: str, value: Any) -> DataFrame:
        return self.states.slice(dimension, value)

    def dice(self, filters: Mapping[str, Any]) -> DataFrame:
        return self.states.dice(filters)

    def roll_up(self, dimension: str, hierarchy: Sequence[str]) -> DataFrame:
        return self._on(dimension, *[h for h in hierarchy if h in self.cube.data.columns]).roll_up(dimension, hierarchy)

    def drill_down(self, dimension: str, parent_value: Any, child: str) -> DataFrame:
        return self._on(dimension, child).drill_down(dimension, parent_value, child)

    def pivot(self, rows: Sequence[str], cols: Sequence[str], measure: str, aggregation: str = "sum",
              domains: Mapping[str, Sequence] | None = None) -> DataFrame:
        return self.states.pivot(rows, cols, measure, aggregation, domains)

    def info(self) -> DataFrame:
        return self.states.info()

    def shape(self) -> DataFrame:
        return self.states.shape()

    def distinct(self, column: str, dims: Sequence[str] = (), approximate: bool = True) -> DataFrame:
        """Distinct values of ``column`` by ``dims``, ``distintos``: united sketches, within SKETCH_ERROR of the exact
        count in all but about three groups of a thousand; exact counts from the data otherwise."""
        if approximate and f"{column}__hll" in self.states.data.columns and set(dims) <= set(self.states.data.columns):
            return self.states.distinct(column, dims)
        kept = self.cube.data
        for d in dims:
            kept = kept.where(F.col(d).isNotNull())
        counted = F.count_distinct(column).alias("distintos")
        return kept.groupBy(*dims).agg(counted) if dims else kept.agg(counted)


def open_session(spark: SparkSession, cube: Cube, path: str, levels: Sequence[str] = (),
                 distinct: Sequence[str] = ()) -> CubeSession:
    """Compute the cuboid of ``cube`` once, store it below ``path`` and answer from there."""
    states = cuboid(cube, levels, distinct)
    states.write.mode("overwrite").parquet(path)
    return CubeSession(cube, spark.read.schema(states.schema).parquet(path))
