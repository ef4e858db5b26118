"""Warehouse views (V1–V3) and the OLAP dataset (O1).

Dimensions are joined with plain left joins; AQE turns them into broadcast
joins when their measured size is below the threshold.  The milestone view
pre-aggregates tests per milestone before joining (no test x task fan-out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.schemas import (BUDGET_BINS, DEVIATION_LABELS, PRODUCTIVITY_BINS, QUALITY_BINS,
                               STATE_BY_FLAG)


def _unique(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``, stated as an aggregate: a left join that uses no other column is dropped by the planner.

    Keys of dimensions are unique already; the aggregate changes no row.
    """
    return df.groupBy(key).agg(*[F.first(c).alias(c) for c in df.columns if c != key])


def _project_attributes(w: dict[str, DataFrame], key: str, *columns: str) -> DataFrame:
    """Projects with their client's code, joined on the project-sized side."""
    dc = w["dim_clientes"].select(F.col("ID_Cliente").alias("__cli"), "CodigoClienteReal")
    dp = w["dim_proyectos"].select(F.col("ID_Proyecto").alias(key), *columns, F.col("ID_Cliente").alias("__cli"))
    return dp.join(dc, "__cli", "left").drop("__cli")


def vista_proyectos_completa(w: dict[str, DataFrame]) -> DataFrame:
    """V1: project fact + project, client, start/end calendar and expense attributes.

    The expense key of a project is only ever 0 or 1, so the expense
    dimension (a row per expense line) is reduced to those keys, a pushed-down
    filter, and not shuffled.
    """
    hp = w["hechos_proyectos"]
    dp = _project_attributes(w, "ID_Proyecto", "CodigoProyecto", "Version", "Cancelado", "TotalErrores",
                             "NumTrabajadores")
    t = w["dim_tiempo"]
    ts = t.select(F.col("ID_Tiempo").alias("ID_FechaInicio"), F.col("Anio").alias("AnioInicio"),
                  F.col("Mes").alias("MesInicio"))
    te = t.select(F.col("ID_Tiempo").alias("ID_FechaFin"), F.col("Anio").alias("AnioFin"),
                  F.col("Mes").alias("MesFin"))
    dg = w["dim_gastos"].where(F.col("ID_Finanza").isin(0, 1)).select(
        F.col("ID_Finanza").alias("ID_Gasto"), "TipoGasto", F.col("Categoria").alias("CategoriaGasto"),
        F.col("Monto").alias("MontoGasto"))
    v = (hp.join(dp, "ID_Proyecto", "left").join(_unique(ts, "ID_FechaInicio"), "ID_FechaInicio", "left")
         .join(_unique(te, "ID_FechaFin"), "ID_FechaFin", "left").join(_unique(dg, "ID_Gasto"), "ID_Gasto", "left"))
    return v.select(*hp.columns, "CodigoProyecto", "Version", "Cancelado", "TotalErrores", "NumTrabajadores",
                    "CodigoClienteReal", "AnioInicio", "MesInicio", "AnioFin", "MesFin", "TipoGasto",
                    "CategoriaGasto", "MontoGasto")


def vista_asignaciones_completa(w: dict[str, DataFrame]) -> DataFrame:
    """V2: assignment fact + employee, project, client and calendar attributes."""
    ha = w["hechos_asignaciones"]
    de = w["dim_empleados"].select("ID_Empleado", "CodigoEmpleado", "Rol", "Seniority")
    dp = _project_attributes(w, "ID_Proyecto", "CodigoProyecto", "Version", "Cancelado")
    dt = w["dim_tiempo"].select(F.col("ID_Tiempo").alias("ID_FechaAsignacion"), "Anio", "Mes", "Dia")
    v = (ha.join(de, "ID_Empleado", "left").join(dp, "ID_Proyecto", "left")
         .join(dt, "ID_FechaAsignacion", "left"))
    return v.select(*ha.columns, "CodigoEmpleado", "Rol", "Seniority", "CodigoProyecto", "Version",
                    "Cancelado", "CodigoClienteReal", "Anio", "Mes", "Dia")


def vista_hitos_tareas(w: dict[str, DataFrame]) -> DataFrame:
    """V3: one row per (milestone, task) with the milestone's test count and successes.

    Same result as grouping the milestone x task x test join, computed
    without the fan-out: tests are aggregated per milestone, identical task
    rows are collapsed with a multiplicity, then joined.  A milestone without
    tests has count 0 and a NULL success sum.
    """
    dh = w["dim_hitos"].select("ID_Hito", "CodigoHito", "ID_proyectos",
                               F.col("RetrasoInicioDias").alias("HitoRetrasoInicio"),
                               F.col("RetrasoFinDias").alias("HitoRetrasoFin"))
    dp = _project_attributes(w, "ID_proyectos", "CodigoProyecto", "Version", "Cancelado")
    tasks = (w["dim_tareas"].groupBy("ID_Hito", "ID_Tarea", "CodigoTarea", F.col("SeRetraso").alias("TareaSeRetraso"))
             .agg(F.count(F.lit(1)).alias("__mult")))
    tests = w["dim_pruebas"].groupBy("ID_Hito").agg(F.count("ID_Prueba").alias("__n"),
                                                    F.sum("PruebaExitosa").alias("__ok"))
    v = dh.join(dp, "ID_proyectos", "left").join(tasks, "ID_Hito", "left").join(tests, "ID_Hito", "left")
    mult = F.coalesce(F.col("__mult"), F.lit(1))
    return v.select("ID_Hito", "CodigoHito", "ID_proyectos", "HitoRetrasoInicio", "HitoRetrasoFin",
                    "CodigoProyecto", "Version", "Cancelado", "CodigoClienteReal", "ID_Tarea", "CodigoTarea",
                    "TareaSeRetraso",
                    (F.coalesce(F.col("__n"), F.lit(0)) * mult).cast("long").alias("TotalPruebas"),
                    (F.col("__ok") * mult).cast("long").alias("PruebasExitosas"))


def olap_dataset(view_projects: DataFrame) -> DataFrame:
    """O1: the denormalised project view plus analysis categories.

    Estado (B23), budget/productivity/quality bins (B22, right-closed),
    deviation type (B24) and start quarter (B25).
    """
    return view_projects.withColumns({
        "Estado": X.code_label("Cancelado", STATE_BY_FLAG),
        "CategoriaPresupuesto": X.bin_right_closed("Presupuesto", *BUDGET_BINS),
        "TipoDesviacion": X.sign_label("DesviacionPresupuestal", *DEVIATION_LABELS),
        "CategoriaProductividad": X.bin_right_closed("ProductividadPromedio", *PRODUCTIVITY_BINS),
        "CategoriaCalidad": X.bin_right_closed("TasaDeExitoEnPruebas", *QUALITY_BINS),
        "PeriodoInicio": X.quarter_label("AnioInicio", "MesInicio"),
    })
