"""Dimension builders (D1–D8).  Each takes the extract dict (plus already built
dimensions) and returns a lazy DataFrame in the warehouse schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators import tables as TB
from portacube.schemas import (DEFAULT_TEXT, DEFAULT_VERSION, PENALTY_CATEGORY, PENALTY_TYPE,
                               STATUS_CANCELLED)


def dim_clientes(ext: dict[str, DataFrame]) -> DataFrame:
    """Client dimension; the natural key is copied."""
    return ext["clientes"].select(F.col("ID_Cliente").cast("long"),
                                  F.col("ID_Cliente").cast("long").alias("CodigoClienteReal"))


def dim_empleados(ext: dict[str, DataFrame]) -> DataFrame:
    """Employee dimension; role trimmed, seniority trimmed with a default."""
    e = ext["empleados"]
    return e.select(F.col("ID_Empleado").cast("long"),
                    F.col("ID_Empleado").cast("long").alias("CodigoEmpleado"),
                    X.trim_default("Rol", None).alias("Rol"),
                    X.trim_default("Seniority", DEFAULT_TEXT).alias("Seniority"))


def dim_proyectos(ext: dict[str, DataFrame], clients: DataFrame | None = None) -> DataFrame:
    """D3: one row per project with a known client.

    Cancel flag (B15), version default (B14), error count (B17), distinct
    worker count (B18), FK filter on clients (B1) and then keep-first per
    project (B4, tie-break: smallest contract id).  Counts are aggregated per
    project before the joins, so no fan-out.
    """
    p = ext["proyectos"]
    clients = ext["clientes"] if clients is None else clients
    base = p.select(
        "ID_Proyecto", "ID_Contrato", "ID_Cliente",
        X.flag_equals("EstadoProyecto", STATUS_CANCELLED).alias("Cancelado"),
        X.trim_default("Version", DEFAULT_VERSION).alias("Version"))
    errs = ext["errores"].groupBy("ID_Proyecto").agg(F.count("ID_Error").alias("TotalErrores"))
    workers = (ext["asignaciones"].groupBy("ID_Proyecto")
               .agg(F.count_distinct("ID_Empleado").alias("NumTrabajadores")))
    with_client = TB.fk_filter(base, "ID_Cliente", clients, "ID_Cliente")
    first = TB.keep_first(with_client, "ID_Proyecto", ["ID_Contrato"])
    out = first.join(errs, "ID_Proyecto", "left").join(workers, "ID_Proyecto", "left")
    return out.select(
        F.col("ID_Proyecto").cast("long"), F.col("ID_Proyecto").cast("long").alias("CodigoProyecto"),
        "Version", F.col("Cancelado").cast("int"), F.col("ID_Cliente").cast("long"),
        F.coalesce(F.col("TotalErrores"), F.lit(0)).cast("int").alias("TotalErrores"),
        F.coalesce(F.col("NumTrabajadores"), F.lit(0)).cast("int").alias("NumTrabajadores"))


def calendar_dates(ext: dict[str, DataFrame]) -> DataFrame:
    """One-row min/max over the eight date columns the calendar must cover."""
    return TB.date_bounds([
        (ext["proyectos"], ["FechaInicio", "FechaFin"]),
        (ext["hitos"], ["FechaInicio", "FechaFinPlanificada", "FechaFinReal"]),
        (ext["asignaciones"], ["FechaAsignacion"]),
        (ext["gastos"], ["Fecha"]),
        (ext["penalizaciones"], ["Fecha"]),
    ])


def dim_tiempo(ext: dict[str, DataFrame], extend_start: str | None = None,
               extend_end: str | None = None, default: tuple[str, str] | None = None) -> DataFrame:
    """Daily calendar covering all data dates (optionally widened)."""
    return TB.calendar(calendar_dates(ext), extend_start, extend_end, default)


#: order of the expense dimension's ids: expenses before penalties; inside each, the extract order (project or
#: contract, date) and finally the natural id
EXPENSE_ORDER = ["__src", "__k1", "__k2", "__k3", "TipoGasto", "Categoria", "Monto"]


def expense_rows(ext: dict[str, DataFrame]) -> DataFrame:
    """D5 without the id: expenses and penalties in one table (B19, B13, B14), with the columns of EXPENSE_ORDER."""
    g = ext["gastos"].select(
        F.lit(0).alias("__src"), F.col("ID_Proyecto").alias("__k1"), F.col("Fecha").alias("__k2"),
        F.col("ID_Gasto").alias("__k3"),
        X.trim_default("TipoGasto", DEFAULT_TEXT).alias("TipoGasto"),
        X.trim_default("Categoria", DEFAULT_TEXT).alias("Categoria"),
        F.coalesce(F.col("Monto"), F.lit(0).cast("decimal(15,2)")).cast("decimal(15,2)").alias("Monto"))
    p = ext["penalizaciones"].select(
        F.lit(1).alias("__src"), F.col("ID_Contrato").alias("__k1"), F.col("Fecha").alias("__k2"),
        F.col("ID_Penalizacion").alias("__k3"),
        F.lit(PENALTY_TYPE).alias("TipoGasto"), F.lit(PENALTY_CATEGORY).alias("Categoria"),
        F.coalesce(F.col("Monto"), F.lit(0).cast("decimal(15,2)")).cast("decimal(15,2)").alias("Monto"))
    return g.unionByName(p)


def dim_gastos(ext: dict[str, DataFrame]) -> DataFrame:
    """Expenses and penalties in one dimension with a dense id (B5) in EXPENSE_ORDER."""
    return TB.dense_id(expense_rows(ext), EXPENSE_ORDER, name="ID_Finanza", stored=True,
                       keep=["TipoGasto", "Categoria", "Monto"])


def dim_hitos(ext: dict[str, DataFrame], dim_proj: DataFrame, cal_summary: DataFrame) -> DataFrame:
    """Milestones of projects in the project dimension (B1), date keys (B7), delays.

    The start delay is always 0: milestones carry no real start date.
    ``cal_summary`` is the one-row (cal_start, cal_days) of the calendar; the
    keys use its start as the base (a scalar subquery, evaluated once), so
    they always join to the calendar.
    """
    h = TB.fk_filter(ext["hitos"], "ID_Proyecto", dim_proj, "ID_Proyecto")
    start = cal_summary.select("cal_start").scalar()
    return h.select(
        F.col("ID_Hito").cast("string"), F.col("ID_Hito").cast("string").alias("CodigoHito"),
        F.col("ID_Proyecto").cast("long").alias("ID_proyectos"),
        X.date_key_clamped("FechaInicio", start).alias("ID_FechaInicio"),
        X.date_key_clamped("FechaFinReal", start).alias("ID_FechaFin"),
        F.lit(0).alias("RetrasoInicioDias"),
        X.delay_days("FechaFinReal", "FechaFinPlanificada").alias("RetrasoFinDias"))


def dim_tareas(ext: dict[str, DataFrame], dim_hit: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tasks of kept milestones; 1 if start or end deviates from plan (B11); ``keep`` names further columns of the
    extract."""
    t = TB.fk_filter(ext["tareas"], "ID_Hito", dim_hit, "ID_Hito")
    return t.select(
        F.col("ID_Tarea").cast("string"), F.col("ID_Tarea").cast("string").alias("CodigoTarea"),
        F.col("ID_Hito").cast("string"),
        X.any_changed(("FechaInicioPlanificada", "FechaInicioReal"),
                      ("FechaFinPlanificada", "FechaFinReal")).alias("SeRetraso"), *keep)


def dim_pruebas(ext: dict[str, DataFrame], dim_hit: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Tests of kept milestones; missing success flag -> 0 (B16); ``keep`` names further columns of the extract."""
    t = TB.fk_filter(ext["pruebas"], "ID_Hito", dim_hit, "ID_Hito")
    return t.select(
        F.col("ID_Prueba").cast("string"), F.col("ID_Prueba").cast("string").alias("CodigoPrueba"),
        F.col("ID_Hito").cast("string"), X.trim_default("TipoPrueba", None).alias("TipoPrueba"),
        X.flag_or_zero("Exitosa").alias("PruebaExitosa"), *keep)
