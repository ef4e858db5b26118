"""KPIs, traffic lights, alerts and statistics.

Each KPI table is one aggregate pass over the OLAP dataset; the one-row
result is turned into one row per KPI by exploding an array of structs
(no join to a threshold table).  Values are rounded half-to-even to two
digits like the original report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.schemas import (ALERT_MONITOR_PREFIX, ALERT_MONITOR_SUFFIX, ALERT_REVIEW_PREFIX,
                               CLIENT_BADGE, DESCRIPTION_OLAP_SUFFIX, KPI_BAD, KPI_DEFINITIONS, KPI_GOOD,
                               SEVERITY_HIGH, SEVERITY_MEDIUM)


def share_pct(cond: Column) -> Column:
    """Share of rows meeting ``cond`` x 100; a NULL condition counts as not met."""
    return F.sum(F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)).cast("double") * 100 / F.count(F.lit(1))


def individual_compliance(p="Presupuesto", c="CosteReal") -> Column:
    """Variant B per-project compliance: min(P/C, 1) x 100; zero cost -> 100 (was inf clipped)."""
    P, C = F.col(p), F.col(c)
    return F.when((C == 0) & (P > 0), F.lit(100.0)).otherwise(X.capped(X.safe_div(P, C), 1.0) * 100)


def deviation_pct(p="Presupuesto", c="CosteReal") -> Column:
    """|C - P| / P x 100; NULL for a zero budget."""
    return X.safe_div(F.abs(F.col(c) - F.col(p)), F.col(p)) * 100


def _kpi_values_a(df: DataFrame) -> list[Column]:
    P, C = F.col("Presupuesto"), F.col("CosteReal")
    return [
        share_pct(C <= P).alias("cumplimiento_presupuesto"),
        X.exact_mean(deviation_pct()).alias("desviacion_presupuestal"),
        X.exact_mean(X.safe_div(F.col("PenalizacionesMonto"), P) * 100).alias("penalizaciones"),
        share_pct(F.col("RetrasoFinalDias") <= 0).alias("proyectos_a_tiempo"),
        (X.exact_mean("Cancelado") * 100).alias("proyectos_cancelados"),
        X.exact_mean("PorcentajeTareasRetrasadas").alias("tareas_retrasadas"),
        X.exact_mean("PorcentajeHitosRetrasados").alias("hitos_retrasados"),
        (X.exact_mean(1 - F.col("TasaDeExitoEnPruebas")) * 100).alias("tasa_errores"),
        X.capped(X.exact_mean("ProductividadPromedio") / 1000 * 100, 100).alias("productividad"),
        (X.exact_mean("TasaDeExitoEnPruebas") * 100).alias("exito_pruebas"),
    ]


def _kpi_values_b(df: DataFrame) -> list[Column]:
    P = F.col("Presupuesto")
    prod = F.col("ProductividadPromedio")
    return [
        X.exact_mean(individual_compliance()).alias("cumplimiento_presupuesto"),
        X.exact_mean(deviation_pct()).alias("desviacion_presupuestal"),
        X.exact_mean(X.safe_div(F.col("PenalizacionesMonto"), P) * 100).alias("penalizaciones"),
        share_pct(F.col("RetrasoFinalDias") <= 0).alias("proyectos_a_tiempo"),
        share_pct(F.col("Cancelado") == 1).alias("proyectos_cancelados"),
        X.exact_mean("PorcentajeTareasRetrasadas").alias("tareas_retrasadas"),
        X.exact_mean("PorcentajeHitosRetrasados").alias("hitos_retrasados"),
        (X.exact_mean(1 - F.col("TasaDeExitoEnPruebas")) * 100).alias("tasa_errores"),
        X.exact_mean((F.lit(1000.0) - X.capped(prod, 1000)) / 1000 * 100).alias("productividad"),
        (X.exact_mean("TasaDeExitoEnPruebas") * 100).alias("exito_pruebas"),
    ]


def hours_ratio(fact_assignments: DataFrame) -> DataFrame:
    """Sum of real hours / sum of planned hours x 100, from the assignment fact."""
    return fact_assignments.agg(
        X.safe_div(F.sum(F.col("HorasReales").cast("long")), F.sum(F.col("HorasPlanificadas").cast("long")))
        .__mul__(100).alias("relacion_horas"))


def _to_rows(wide: DataFrame, names: list[str], olap_suffix: bool) -> DataFrame:
    defs = {d[0]: d for d in KPI_DEFINITIONS}
    structs = []
    for n in names:
        _, target, unit, desc, direction, good, bad = defs[n]
        v = F.bround(F.col(n), 2)
        structs.append(F.struct(
            F.lit(n).alias("kpi"), v.alias("valor"), F.lit(float(target)).alias("objetivo"),
            F.lit(unit).alias("unidad"),
            F.lit(desc + (DESCRIPTION_OLAP_SUFFIX if olap_suffix else "")).alias("descripcion"),
            X.status_class(F.col(n), direction, good, bad).alias("estado")))
    return wide.select(F.explode(F.array(*structs)).alias("k")).select("k.*")


def kpi_table(dataset: DataFrame, fact_assignments: DataFrame | None = None, variant: str = "A") -> DataFrame:
    """One row per KPI ``(kpi, valor, objetivo, unidad, descripcion, estado)``.

    Variant A is the set the report uses; variant B the alternative
    definitions (compliance as capped ratio, inverted productivity).  K11 is
    computed from the assignment fact when it is given.
    """
    vals = _kpi_values_a(dataset) if variant.upper() == "A" else _kpi_values_b(dataset)
    names = [d[0] for d in KPI_DEFINITIONS if d[0] != "relacion_horas"]
    rows = _to_rows(dataset.agg(*vals), names, olap_suffix=variant.upper() == "A")
    if fact_assignments is not None:
        rows = rows.unionByName(_to_rows(hours_ratio(fact_assignments), ["relacion_horas"],
                                         olap_suffix=variant.upper() == "A"))
    return rows


def alerts(kpis: DataFrame) -> DataFrame:
    """KPIs not in the good state, with severity and a recommendation."""
    label = F.regexp_replace(F.col("kpi"), "_", " ")
    return kpis.where(F.col("estado") != KPI_GOOD).select(
        "kpi", "valor", "objetivo", "unidad", "descripcion",
        F.when(F.col("estado") == KPI_BAD, F.lit(SEVERITY_HIGH)).otherwise(F.lit(SEVERITY_MEDIUM)).alias("severidad"),
        F.when(F.col("estado") == KPI_BAD, F.concat(F.lit(ALERT_REVIEW_PREFIX), label))
         .otherwise(F.concat(F.lit(ALERT_MONITOR_PREFIX), label, F.lit(ALERT_MONITOR_SUFFIX)))
         .alias("recomendacion"))


def alert_count(kpis: DataFrame) -> DataFrame:
    """Total number of alerts (one row)."""
    return alerts(kpis).agg(F.count(F.lit(1)).alias("total_alertas"))


def kpis_by_client(dataset: DataFrame) -> DataFrame:
    """Per client — mean compliance, mean deviation %, % on time, #projects, budget sum."""
    return dataset.where(F.col("CodigoClienteReal").isNotNull()).groupBy("CodigoClienteReal").agg(
        F.bround(X.exact_mean(individual_compliance()), 2).alias("cumplimiento_presupuesto"),
        F.bround(X.exact_mean(deviation_pct()), 2).alias("desviacion_presupuestal"),
        F.bround(share_pct(F.col("RetrasoFinalDias") <= 0), 2).alias("proyectos_a_tiempo"),
        F.count("ID_Hecho").alias("total_proyectos"),
        F.bround(X.exact_sum("Presupuesto"), 2).alias("presupuesto_total"))


def client_badge(by_client: DataFrame) -> DataFrame:
    """Client compliance badge (good >= 90, warning >= 85, else bad)."""
    good, warn, g, w, b = CLIENT_BADGE
    c = F.col("cumplimiento_presupuesto")
    return by_client.withColumn("badge", F.when(c >= good, g).when(c >= warn, w).otherwise(b))


def stats(dataset: DataFrame) -> DataFrame:
    """Global statistics of the dataset, 0 when it is empty."""
    n_cols = len(dataset.columns)
    return dataset.agg(
        F.count(F.lit(1)).alias("proyectos_analizados"),
        F.coalesce(X.exact_sum("Presupuesto"), F.lit(0.0)).alias("presupuesto_total"),
        F.coalesce(X.exact_sum("CosteReal"), F.lit(0.0)).alias("costo_total"),
        F.count_distinct("CodigoClienteReal").alias("clientes_activos"),
        F.lit(n_cols).alias("dataset_dimensiones"),
        F.coalesce(X.exact_mean("DesviacionPresupuestal"), F.lit(0.0)).alias("desviacion_promedio"),
        F.coalesce(X.exact_mean("ProductividadPromedio"), F.lit(0.0)).alias("productividad_promedio"),
        F.coalesce(X.exact_mean("TasaDeExitoEnPruebas") * 100, F.lit(0.0)).alias("tasa_exito_pruebas"))


def trend_by_year(dataset: DataFrame) -> DataFrame:
    """Start year -> mean compliance and project count."""
    return dataset.where(F.col("AnioInicio").isNotNull()).groupBy("AnioInicio").agg(
        F.bround(X.exact_mean(individual_compliance()), 2).alias("cumplimiento_presupuesto"),
        F.count(F.lit(1)).alias("proyectos"))
