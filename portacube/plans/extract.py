"""Cascaded extracts (E1–E14): every table restricted to closed/cancelled projects.

The status predicate is written once, on projects; Catalyst pushes it into
the scan and the other tables reach it through semi/inner joins.  Small
parents are broadcast by AQE at run time from measured sizes (no blind hints):
the project table is not small at scale, so its joins stay shuffle joins on
the project key and AQE's skew-join split handles hot projects.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portacube.schemas import INCLUSION_IN, INCLUSION_OUT, IN_SCOPE_STATUSES


def in_scope(status: str | Column = "Estado") -> Column:
    """Project status is closed or cancelled."""
    c = F.col(status) if isinstance(status, str) else status
    return c.isin(*IN_SCOPE_STATUSES)


def _stamp(extracted_at) -> Column:
    """Extraction timestamp; pass a value to make the extract repeatable."""
    if extracted_at is None:
        return F.current_timestamp().alias("fecha_extraccion")
    return F.lit(extracted_at).cast("timestamp").alias("fecha_extraccion")


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, str)):
        return F.to_date(F.lit(str(as_of)))
    return as_of


def closed_projects(proyectos: DataFrame, since=None, date_column: str | None = None) -> DataFrame:
    """Projects in scope, optionally only those changed after a watermark."""
    p = proyectos.where(in_scope("Estado"))
    if since is not None and date_column is not None:
        p = p.where(F.col(date_column) > F.lit(since))
    return p


def extract_all(src: dict[str, DataFrame], as_of=None, extracted_at=None,
                since=None, since_column: str | None = None, hitos: DataFrame | None = None,
                stored: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """E2–E12 as a lazy dict (names of the original extract set).

    ``as_of`` replaces the current date in the delay columns (E6, E7) and
    ``extracted_at`` the extraction time (E13), making runs repeatable.
    ``hitos`` is the milestone extract where it has been stored: tasks, tests
    and errors then find their projects in it.  ``stored`` has extracts of the
    same sources that have been stored, of EXTRACT_LEVELS before those that
    are asked for: they are returned as they are, and the others follow from
    them instead of the sources they were made of.
    """
    stored = dict(stored or {})
    stamp = _stamp(extracted_at)
    today = _as_of(as_of)
    proj = closed_projects(src["proyectos"], since, since_column)
    pid = stored.get("proyectos", proj).select("ID_Proyecto")
    contratos = src["contratos"]

    contracts_in = stored["contratos"] if "contratos" in stored else contratos.join(pid, "ID_Proyecto", "left_semi")
    clientes = (src["clientes"].join(contracts_in.select("ID_Cliente"), "ID_Cliente", "left_semi")
                .select("ID_Cliente", "NombreCliente", stamp))
    asign_in = src["asignaciones"].join(pid, "ID_Proyecto", "left_semi")
    # stored assignments are those of the same projects whose employee there is
    empleados = (src["empleados"].join(stored.get("asignaciones", asign_in).select("ID_Empleado"), "ID_Empleado", "left_semi")
                 .select("ID_Empleado", "NombreCompleto", "Rol", "Seniority", "CostoPorHora", stamp))
    contratos_x = contracts_in.select("ID_Contrato", "ID_Cliente", "ID_Proyecto", "ValorTotalContrato",
                                      "Estado", stamp)
    c = contratos.select("ID_Contrato", "ID_Cliente", "ID_Proyecto", "ValorTotalContrato",
                         F.col("Estado").alias("EstadoContrato"))
    proyectos = proj.join(c, "ID_Proyecto", "left").select(
        "ID_Proyecto", "NombreProyecto", "Version", "FechaInicio", "FechaFin", "FechaInicioReal",
        "FechaFinReal", F.col("Estado").alias("EstadoProyecto"), "TipoProyecto", "ID_Contrato",
        "ID_Cliente", "ValorTotalContrato", "EstadoContrato",
        F.when(in_scope("Estado"), F.lit(INCLUSION_IN)).otherwise(F.lit(INCLUSION_OUT)).alias("razon_inclusion"),
        stamp)
    hitos = stored.get("hitos", hitos)
    if hitos is None:
        hitos = src["hitos"].join(pid, "ID_Proyecto", "left_semi").select(
            "ID_Hito", "ID_Proyecto", "Descripcion", "Estado", "FechaInicio", "FechaFinPlanificada",
            "FechaFinReal",
            F.datediff(F.coalesce(F.col("FechaFinReal"), today), F.col("FechaFinPlanificada")).cast("int")
            .alias("dias_retraso"),
            stamp)
    hito_proj = hitos.select("ID_Hito", "ID_Proyecto")
    tareas = src["tareas"].join(hito_proj, "ID_Hito").select(
        "ID_Tarea", "ID_Hito", "ID_Proyecto", "NombreTarea", "Descripcion", "Estado",
        "FechaInicioPlanificada", "FechaInicioReal", "FechaFinPlanificada", "FechaFinReal",
        F.datediff(F.coalesce(F.col("FechaFinReal"), today), F.col("FechaFinPlanificada")).cast("int")
        .alias("dias_retraso"),
        stamp)
    emp_cost = src["empleados"].select("ID_Empleado", "CostoPorHora")
    asignaciones = asign_in.join(emp_cost, "ID_Empleado").select(
        "ID_Asignacion", "ID_Proyecto", "ID_Empleado", "HorasPlanificadas", "HorasReales",
        "FechaAsignacion", "CostoPorHora",
        (F.col("HorasReales") * F.col("CostoPorHora")).cast("decimal(18,2)").alias("costo_real_horas"),
        (F.col("HorasPlanificadas") * F.col("CostoPorHora")).cast("decimal(18,2)").alias("costo_planificado_horas"),
        stamp)
    pruebas = src["pruebas"].join(hito_proj, "ID_Hito").select(
        "ID_Prueba", "ID_Hito", "ID_Proyecto", "TipoPrueba", "Fecha", "Exitosa", stamp)
    if "tareas" in stored:
        task_proj = stored["tareas"].select("ID_Tarea", "ID_Hito", "ID_Proyecto")
    else:
        task_proj = src["tareas"].select("ID_Tarea", "ID_Hito").join(hito_proj, "ID_Hito")
    errores = (src["errores"].join(task_proj, "ID_Tarea")
               .select("ID_Error", "ID_Tarea", "ID_Hito", "ID_Proyecto", "TipoError", "Descripcion",
                       "FaseDeteccion", "FechaDeteccion", "FechaCorreccion", stamp))
    gastos = (src["gastos"].join(pid, "ID_Proyecto", "left_semi")
              .select("ID_Gasto", "ID_Proyecto", "TipoGasto", "Categoria", "Monto", "Fecha", stamp))
    contract_client = contracts_in.select("ID_Contrato", "ID_Cliente")
    penalizaciones = (src["penalizaciones_contrato"].join(contract_client, "ID_Contrato")
                      .select("ID_Penalizacion", "ID_Contrato", "ID_Cliente", "Monto", "Motivo", "Fecha", stamp))
    return {"clientes": clientes, "empleados": empleados, "contratos": contratos_x,
            "proyectos": proyectos, "hitos": hitos, "tareas": tareas, "asignaciones": asignaciones,
            "pruebas": pruebas, "errores": errores, "gastos": gastos, "penalizaciones": penalizaciones, **stored}


#: the extracts in the order of the cascade: those of a level follow from the levels before
EXTRACT_LEVELS = [["proyectos"], ["contratos", "hitos", "asignaciones", "gastos"],
                  ["clientes", "empleados", "tareas", "pruebas", "penalizaciones"], ["errores"]]
