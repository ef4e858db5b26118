"""OLAP cube over a DataFrame.

A ``Cube`` is a DataFrame plus dimension and measure names.  Every operation
returns a lazy DataFrame in long form with ``<measure>_sum``, ``<measure>_mean``
and ``<measure>_count`` columns.  Rows with a missing grouping key are
ignored (as the pandas group-by did), sums of all-missing groups are 0 and
means of all-missing groups are filled with 0.  Sums and means are exact
decimal sums (see ``exprs.exact_sum``), independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators.crosstab import crosstab, densify
from portacube.schemas import MARGIN_TOTAL


def _measure_aggs(measures: Sequence[str], extra: bool = False) -> list[Column]:
    out = []
    for m in measures:
        c = F.col(m).cast("double")
        out += [F.coalesce(X.exact_sum(c), F.lit(0.0)).alias(f"{m}_sum"),
                F.coalesce(X.exact_mean(c), F.lit(0.0)).alias(f"{m}_mean"),
                F.count(c).alias(f"{m}_count")]
        if extra:
            out += [F.min(c).alias(f"{m}_min"), F.max(c).alias(f"{m}_max")]
    return out


class Cube:
    """Cube definition (C1): data, dimension names, measure names."""

    def __init__(self, data: DataFrame, dimensions: Sequence[str], measures: Sequence[str]):
        missing = [c for c in list(dimensions) + list(measures) if c not in data.columns]
        if missing:
            raise ValueError(f"columns not in data: {missing}")
        self.data = data
        self.dimensions = list(dimensions)
        self.measures = list(measures)

    # -- what a group is computed from (see ``cuboids``)
    def _aggs(self, extra: bool = False) -> list[Column]:
        return _measure_aggs(self.measures, extra)

    def _carried(self) -> list[str]:
        return self.measures

    # -- helpers ---------------------------------------------------------
    def _check_dim(self, dim: str) -> None:
        if dim not in self.dimensions:
            raise ValueError(f"dimension {dim!r} is not in the cube")

    def _group(self, df: DataFrame, dims: Sequence[str]) -> DataFrame:
        dims = list(dims)
        if not dims:
            # no row matched: an empty result, not one row of zeros
            total = df.agg(F.count(F.lit(1)).alias("__rows"), *self._aggs(extra=True))
            return total.where("__rows > 0").drop("__rows")
        kept = df.where(_not_null(dims))
        return kept.groupBy(*dims).agg(*self._aggs())

    # -- operations ------------------------------------------------------
    def base(self) -> DataFrame:
        """Group by all dimensions; sum, mean, count of every measure."""
        return self._group(self.data, self.dimensions)

    def slice(self, dimension: str, value: Any) -> DataFrame:
        """Fix one dimension to a value and aggregate over the others.

        With no dimension left the result is one row with sum, mean, count,
        min and max of every measure.
        """
        self._check_dim(dimension)
        filtered = self.data.where(F.col(dimension) == F.lit(value))
        return self._group(filtered, [d for d in self.dimensions if d != dimension])

    def dice(self, filters: Mapping[str, Any]) -> DataFrame:
        """C4: AND of equality (scalar) or IN (list) filters, then as slice."""
        df = self.data
        for dim, value in filters.items():
            self._check_dim(dim)
            if isinstance(value, (list, tuple, set)):
                df = df.where(F.col(dim).isin(*list(value)))
            else:
                df = df.where(F.col(dim) == F.lit(value))
        return self._group(df, [d for d in self.dimensions if d not in filters])

    def roll_up(self, dimension: str, hierarchy: Sequence[str]) -> DataFrame:
        """One aggregate per hierarchy level, in one pass.

        Each level groups by the other dimensions plus ``<dimension>_nivel``
        holding that level's value (``'TOTAL'`` for the top level; a level
        name that is not a column falls back to the dimension itself).
        Output column ``nivel`` is ``Nivel_<i>_<level>``.  The rows are
        replicated once per level by exploding a level array (the Expand of
        GROUPING SETS), then aggregated by a single hash aggregate.
        """
        self._check_dim(dimension)
        others = [d for d in self.dimensions if d != dimension]
        lvl_col = f"{dimension}_nivel"
        levels = []
        for i, level in enumerate(hierarchy):
            if level == MARGIN_TOTAL:
                v = F.lit(MARGIN_TOTAL)
            elif level in self.data.columns:
                v = F.col(level).cast("string")
            else:
                v = F.col(dimension).cast("string")
            levels.append(F.struct(F.lit(f"Nivel_{i + 1}_{level}").alias("nivel"), v.alias("v")))
        exploded = (self.data.select(*others, *self._carried(), F.explode(F.array(*levels)).alias("__l"))
                    .select(*others, *self._carried(), F.col("__l.nivel").alias("nivel"),
                            F.col("__l.v").alias(lvl_col)))
        return self._group(exploded, ["nivel"] + others + [lvl_col])

    def roll_up_levels(self, dimension: str, hierarchy: Sequence[str]) -> dict[str, DataFrame]:
        """C5 as the original dict ``{Nivel_i_level: DataFrame}`` (filters of one plan)."""
        r = self.roll_up(dimension, hierarchy)
        return {f"Nivel_{i + 1}_{lv}": r.where(F.col("nivel") == f"Nivel_{i + 1}_{lv}").drop("nivel")
                for i, lv in enumerate(hierarchy)}

    def drill_down(self, dimension: str, parent_value: Any, child: str) -> DataFrame:
        """Filter the parent value and group by the child instead of the parent."""
        self._check_dim(dimension)
        if child not in self.data.columns:
            raise ValueError(f"child dimension {child!r} is not a data column")
        filtered = self.data.where(F.col(dimension) == F.lit(parent_value))
        dims = [d for d in self.dimensions if d != dimension]
        dims = dims + ([child] if child not in dims else [])
        return self._group(filtered, dims)

    def pivot(self, rows: Sequence[str], cols: Sequence[str], measure: str, aggregation: str = "sum",
              domains: Mapping[str, Sequence] | None = None) -> DataFrame:
        """Pivot with fill 0 and ``TOTAL`` margins (long form, see ``crosstab``).

        ``domains`` (label lists of all keys but one at most) adds the unobserved cells.
        """
        if measure not in self.measures:
            raise ValueError(f"measure {measure!r} is not in the cube")
        for d in list(rows) + list(cols):
            self._check_dim(d)
        out = crosstab(self.data, rows, cols, {measure: aggregation}, fill_value=0, margins_name=MARGIN_TOTAL)
        return densify(out, rows, cols, domains, {measure: aggregation}) if domains else out

    def preview(self, n: int = 20) -> DataFrame:
        """M6: the first ``n`` rows of the base cube in dimension order (a top-n, by design)."""
        return self.base().orderBy(*self.dimensions).limit(n)

    def _counted(self) -> DataFrame:
        """Rows per combination of the dimensions, missing ones included."""
        return self.data.groupBy(*self.dimensions).agg(F.count(F.lit(1)).alias("__rows"))

    def info(self) -> DataFrame:
        """One row — record count and distinct values per dimension (missing excluded).

        Values are counted over the combinations of the dimensions, so the
        rows of the data are not multiplied by the distinct counts.
        """
        return self._counted().agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("num_registros"),
                                   *[F.count_distinct(d).alias(f"distintos_{d}") for d in self.dimensions])

    def shape(self) -> DataFrame:
        """One row — dimension and measure names, and rows and columns of the base cube.

        Its rows are the combinations without missing values; no measure is computed.
        """
        filled = self._counted().where(_not_null(self.dimensions))
        return filled.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(", ".join(self.dimensions)).alias("dimensiones"), F.lit(", ".join(self.measures)).alias("medidas"),
            "filas", F.lit(len(self.dimensions) + 3 * len(self.measures)).alias("columnas"))


def _not_null(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


PROJECT_CUBE_DIMS = ["CodigoClienteReal", "Estado", "AnioInicio", "MesInicio", "CategoriaPresupuesto",
                     "TipoDesviacion", "CategoriaProductividad", "CategoriaCalidad", "PeriodoInicio"]
PROJECT_CUBE_MEASURES = ["Presupuesto", "CosteReal", "DesviacionPresupuestal", "ProductividadPromedio",
                         "TasaDeExitoEnPruebas", "PorcentajeTareasRetrasadas", "PorcentajeHitosRetrasados"]
KPI_CUBE_DIMS = ["Estado", "CategoriaPresupuesto", "CategoriaProductividad", "CategoriaCalidad",
                 "AnioInicio", "PeriodoInicio"]
KPI_CUBE_MEASURES = ["Presupuesto", "CosteReal", "DesviacionPresupuestal", "ProductividadPromedio",
                     "TasaDeExitoEnPruebas", "PorcentajeTareasRetrasadas", "PorcentajeHitosRetrasados",
                     "TasaDeErroresEncontrados", "PenalizacionesMonto"]


def project_cube(df: DataFrame) -> Cube:
    """Project cube; wanted names are intersected with the columns present."""
    return Cube(df, [d for d in PROJECT_CUBE_DIMS if d in df.columns],
                [m for m in PROJECT_CUBE_MEASURES if m in df.columns])


def kpi_cube(df: DataFrame) -> Cube:
    """KPI cube; wanted names are intersected with the columns present."""
    return Cube(df, [d for d in KPI_CUBE_DIMS if d in df.columns],
                [m for m in KPI_CUBE_MEASURES if m in df.columns])
