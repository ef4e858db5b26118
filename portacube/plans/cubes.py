"""Ready-made cubes P1–P10 and the cube session (C11), all via ``crosstab``.

Derived per-project measures are plain column expressions evaluated before
the single grouping-sets aggregate.  Division by zero yields NULL (skipped by
means) instead of inf/NaN; the budget-compliance rule keeps the original
outcome for a zero cost (100).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators.crosstab import crosstab, default_aggregation, densify
from portacube.operators.cuboids import CubeSession, open_session
from portacube.operators.cube import Cube, kpi_cube, project_cube
from portacube.schemas import (BUDGET_BINS, DEVIATION_LABELS, MARGIN_ALL, MARGIN_AVERAGE, MARGIN_TOTAL,
                               PRODUCTIVITY_BINS, QUALITY_BINS)


def budget_compliance(p="Presupuesto", c="CosteReal") -> Column:
    """P>0 ? min(100, P/C*100) : 100; a zero cost counts as fully compliant."""
    P, C = F.col(p), F.col(c)
    return (F.when(P > 0, F.when(C == 0, F.lit(100.0))
                   .otherwise(X.capped(X.safe_div(P, C) * 100, 100)))
            .otherwise(F.lit(100.0)))


def on_time(delay="RetrasoFinalDias") -> Column:
    return X.pct_indicator(F.col(delay) <= 0)


def category_domains(keys: list[str]) -> dict[str, list[str]]:
    """The fixed label lists of those of ``keys`` that are categories."""
    known = {"CategoriaPresupuesto": BUDGET_BINS[1], "CategoriaProductividad": PRODUCTIVITY_BINS[1],
             "CategoriaCalidad": QUALITY_BINS[1], "TipoDesviacion": list(DEVIATION_LABELS)}
    return {k: known[k] for k in keys if k in known}


def cube_base(df: DataFrame) -> DataFrame:
    """Client, state x start quarter; budget/cost sums, productivity mean."""
    return crosstab(df, ["CodigoClienteReal", "Estado"], ["PeriodoInicio"],
                    {"Presupuesto": "sum", "CosteReal": "sum", "ProductividadPromedio": "mean"},
                    margins_name=MARGIN_TOTAL)


def cube_productivity_quality(df: DataFrame, dense: bool = False) -> DataFrame:
    """Productivity x quality category by state; ``dense`` adds the unobserved category pairs."""
    rows, cols = ["CategoriaProductividad", "CategoriaCalidad"], ["Estado"]
    measures = {"ID_Proyecto": "count", "Presupuesto": "mean", "DesviacionPresupuestal": "mean"}
    out = crosstab(df, rows, cols, measures, fill_value=0, margins_name=MARGIN_ALL)
    return densify(out, rows, cols, category_domains(rows + cols), measures) if dense else out


def cube_financial(df: DataFrame, column: str = "CodigoClienteReal", dense: bool = False) -> DataFrame:
    """Budget category x deviation type by client; ``dense`` adds the unobserved category pairs per client."""
    rows = ["CategoriaPresupuesto", "TipoDesviacion"]
    measures = {"ID_Proyecto": "count", "Presupuesto": "sum", "CosteReal": "sum", "DesviacionPresupuestal": "sum"}
    out = crosstab(df, rows, [column], measures, fill_value=0, margins_name=MARGIN_ALL)
    return densify(out, rows, [column], category_domains(rows), measures) if dense else out


def cube_time_state(df: DataFrame) -> DataFrame:
    """Start year, state x quality category."""
    return crosstab(df, ["AnioInicio", "Estado"], ["CategoriaCalidad"],
                    {"ID_Proyecto": "count", "TasaDeExitoEnPruebas": "mean", "ProductividadPromedio": "mean"},
                    fill_value=0, margins_name=MARGIN_ALL)


def cube_multi_measure(df: DataFrame, row: str = "CodigoClienteReal") -> DataFrame:
    """P5: client x state with three money sums and four means."""
    return crosstab(df, [row], ["Estado"],
                    {"Presupuesto": "sum", "CosteReal": "sum", "DesviacionPresupuestal": "sum",
                     "ProductividadPromedio": "mean", "TasaDeExitoEnPruebas": "mean",
                     "PorcentajeTareasRetrasadas": "mean", "PorcentajeHitosRetrasados": "mean"},
                    margins_name=MARGIN_ALL)


def executive_measures(df: DataFrame) -> DataFrame:
    """Derived measures of P6: ROI, budget efficiency and quality index."""
    P, C = F.col("Presupuesto"), F.col("CosteReal")
    return df.withColumns({
        "ROI": X.safe_div(P - C, P) * 100,
        "EficienciaPresupuestal": X.safe_div(P, C),
        "IndicadorCalidad": F.col("TasaDeExitoEnPruebas") * 0.4
        + (F.lit(100.0) - F.col("PorcentajeTareasRetrasadas")) / 100 * 0.6,
    })


def cube_executive(df: DataFrame, row: str = "CodigoClienteReal") -> DataFrame:
    """Client x start quarter, executive KPIs."""
    return crosstab(executive_measures(df), [row], ["PeriodoInicio"],
                    {"ID_Proyecto": "count", "Presupuesto": "sum", "CosteReal": "sum", "ROI": "mean",
                     "EficienciaPresupuestal": "mean", "IndicadorCalidad": "mean",
                     "ProductividadPromedio": "mean"}, margins_name=MARGIN_ALL)


def cube_custom(df: DataFrame, dimensions: Sequence[str], measures: Sequence[str],
                columns: Sequence[str] | None = None,
                aggregations: Mapping[str, str] | None = None) -> DataFrame:
    """caller's dimensions/measures; aggregation per measure or by name rule (M4); fill 0."""
    aggs = dict(aggregations) if aggregations else {m: default_aggregation(m) for m in measures}
    return crosstab(df, dimensions, columns or [], {m: aggs[m] for m in measures}, fill_value=0,
                    margins_name=MARGIN_ALL)


def kpi_measures(df: DataFrame) -> DataFrame:
    """Per-project KPI columns shared by P8–P10."""
    P = F.col("Presupuesto")
    return df.withColumns({
        "cumplimiento_presupuesto": budget_compliance(),
        "desviacion_presupuestal": F.when(P > 0, F.abs(F.col("CosteReal") - P) / P * 100).otherwise(F.lit(0.0)),
        "penalizaciones_pct": F.when(P > 0, F.col("PenalizacionesMonto") / P * 100).otherwise(F.lit(0.0)),
        "proyecto_a_tiempo": on_time(),
        "proyecto_cancelado": (F.col("Cancelado") * 100).cast("double"),
        "proyecto_exitoso": X.pct_indicator((F.col("RetrasoFinalDias") <= 0) & (F.col("Cancelado") == 0)
                                            & (F.col("TasaDeExitoEnPruebas") >= 0.9)),
    })


def cube_kpis_main(df: DataFrame, row: str = "CodigoClienteReal") -> DataFrame:
    """Client, start year x state; means of ten KPIs, margin PROMEDIO."""
    return crosstab(kpi_measures(df), [row, "AnioInicio"], ["Estado"],
                    {"cumplimiento_presupuesto": "mean", "desviacion_presupuestal": "mean",
                     "penalizaciones_pct": "mean", "proyecto_a_tiempo": "mean", "proyecto_cancelado": "mean",
                     "PorcentajeTareasRetrasadas": "mean", "PorcentajeHitosRetrasados": "mean",
                     "TasaDeErroresEncontrados": "mean", "ProductividadPromedio": "mean",
                     "TasaDeExitoEnPruebas": "mean100"}, margins_name=MARGIN_AVERAGE)


def cube_kpis_time(df: DataFrame) -> DataFrame:
    """Start year x start month; compliance, on time, cancelled, productivity, success, count."""
    return crosstab(kpi_measures(df), ["AnioInicio"], ["MesInicio"],
                    {"cumplimiento_presupuesto": "mean", "proyecto_a_tiempo": "mean",
                     "proyecto_cancelado": "mean", "TasaDeExitoEnPruebas": "mean100",
                     "ProductividadPromedio": "mean", "ID_Proyecto": "count"}, margins_name=MARGIN_AVERAGE)


def cube_kpis_category(df: DataFrame, dense: bool = False) -> DataFrame:
    """P10: budget category x productivity category; ``dense`` adds the unobserved pairs."""
    rows, cols = ["CategoriaPresupuesto"], ["CategoriaProductividad"]
    measures = {"cumplimiento_presupuesto": "mean", "proyecto_exitoso": "mean",
                "TasaDeExitoEnPruebas": "mean100", "ProductividadPromedio": "mean",
                "PorcentajeTareasRetrasadas": "mean", "ID_Proyecto": "count"}
    out = crosstab(kpi_measures(df), rows, cols, measures, margins_name=MARGIN_TOTAL)
    return densify(out, rows, cols, category_domains(rows + cols), measures, fill_value=None) if dense else out


#: per cube the columns below its dimensions that its cuboid holds too, and those whose distinct values it sketches
CUBOID_LEVELS = {"cubo_proyectos": [], "cubo_kpis": ["MesInicio"]}
CUBOID_DISTINCT = {"cubo_proyectos": [], "cubo_kpis": ["CodigoClienteReal"]}


def build_cubes(dataset: DataFrame) -> dict[str, Cube]:
    """C11: both cubes over one OLAP dataset."""
    return {"cubo_proyectos": project_cube(dataset), "cubo_kpis": kpi_cube(dataset)}


def open_cubes(dataset: DataFrame, root: str) -> dict[str, CubeSession]:
    """C11: both cubes with their cuboids stored below ``root``; operations read these instead of the dataset."""
    return {name: open_session(dataset.sparkSession, cube, f"{root}/{name}", CUBOID_LEVELS[name], CUBOID_DISTINCT[name])
            for name, cube in build_cubes(dataset).items()}


def cube_sizes(sessions: Mapping[str, CubeSession]) -> DataFrame:
    """Per cube its records, its columns (dimensions and measures) and whether it has any records."""
    out = None
    for name, s in sessions.items():
        one = s.info().select(F.lit(name).alias("cubo"), F.col("num_registros").alias("registros"),
                              F.lit(len(s.dimensions) + len(s.measures)).alias("columnas"),
                              (F.col("num_registros") > 0).alias("activo"))
        out = one if out is None else out.union(one)
    return out
