"""Fact builders (F1, F2).

The project fact is built the Spark way: the child tables are aggregated by
project (partial + final hash aggregate) in two unions, the small per-project
results are joined to the project spine, and missing measures become 0.
No per-project loop and no row fan-out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators import tables as TB
from portacube.schemas import CAPEX, OPEX


#: order of the assignment fact's ids: the extract order (project, date), then the natural id
ASSIGNMENT_ORDER = ["ID_Proyecto", "FechaAsignacion", "ID_Asignacion", "ID_Empleado", "HorasPlanificadas", "HorasReales"]


def assignment_rows(ext: dict[str, DataFrame], dim_proj: DataFrame, cal_summary: DataFrame) -> DataFrame:
    """F1 without the id: the assignment fact with the columns of ASSIGNMENT_ORDER.

    FK filter on projects (B1), date key floored at 1 and clipped to the
    calendar size, missing date -> 0 (B7, B8), hours coerced with default 0
    (B13), ValorHoras = real hours x the employee's hourly cost, which the
    extract carries, with missing cost -> 0 (F1a), RetrasoHoras = real - planned (F1b).
    """
    a = TB.fk_filter(ext["asignaciones"], "ID_Proyecto", dim_proj, "ID_Proyecto")
    a = a.select("ID_Asignacion", "ID_Proyecto", "ID_Empleado", "FechaAsignacion",
                 F.coalesce(F.col("HorasPlanificadas").try_cast("int"), F.lit(0)).alias("HorasPlanificadas"),
                 F.coalesce(F.col("HorasReales").try_cast("int"), F.lit(0)).alias("HorasReales"), "CostoPorHora")
    start = cal_summary.select("cal_start").scalar()
    days = cal_summary.select("cal_days").scalar()
    return a.select(
        F.col("ID_Asignacion"), F.col("FechaAsignacion"),
        F.col("ID_Empleado").cast("long"), F.col("ID_Proyecto").cast("long"),
        X.date_key_clamped("FechaAsignacion", start, null_value=0, upper=days).alias("ID_FechaAsignacion"),
        "HorasPlanificadas", "HorasReales",
        (F.col("HorasReales") * F.coalesce(F.col("CostoPorHora"), F.lit(0))).cast("decimal(15,2)")
        .alias("ValorHoras"),
        (F.col("HorasReales") - F.col("HorasPlanificadas")).cast("int").alias("RetrasoHoras"))


def hechos_asignaciones(ext: dict[str, DataFrame], dim_proj: DataFrame, cal_summary: DataFrame) -> DataFrame:
    """assignment fact with a dense id in ASSIGNMENT_ORDER."""
    return TB.dense_id(assignment_rows(ext, dim_proj, cal_summary), ASSIGNMENT_ORDER, name="ID_HechoAsignacion",
                       stored=True, keep=["ID_Empleado", "ID_Proyecto", "ID_FechaAsignacion", "HorasPlanificadas",
                                          "HorasReales", "ValorHoras", "RetrasoHoras"])


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def project_measures(ext: dict[str, DataFrame], dim_proj: DataFrame, dim_tar: DataFrame,
                     cal_summary: DataFrame) -> DataFrame:
    """F2a–F2o for every project of the project dimension (without the surrogate id).

    Child tables are projected to ``(ID_Proyecto, <their measure inputs>)``
    and meet in two aggregates by project, each over one union (partial
    aggregation before the shuffle): the tables that carry amounts and dates,
    and those that are only counted, whose many rows then do not drag the
    amounts' empty columns along.  A project holding a third of all rows is
    combined map-side.
    """
    zero = F.lit(0)
    money0 = F.lit(0).cast("decimal(15,2)")
    cat = F.upper(F.col("Categoria"))
    # F2c / F2i: contracts with the penalty total of each contract (contract-level join)
    pen = ext["penalizaciones"].groupBy("ID_Contrato").agg(F.sum("Monto").cast("decimal(18,2)").alias("pen"))
    contracts = ext["contratos"].select("ID_Proyecto", "ID_Contrato", "ValorTotalContrato").join(
        pen, "ID_Contrato", "left")
    # F2n: delayed tasks of the task dimension, pre-aggregated per milestone, beside their milestone
    tpm = dim_tar.groupBy("ID_Hito").agg(F.count(F.lit(1)).alias("t_n"),
                                         F.sum(F.when(F.col("SeRetraso") == 1, 1).otherwise(0)).alias("t_late"))
    one = F.lit(1).cast("long")
    milestones = ext["hitos"].select(
        "ID_Hito", "ID_Proyecto", one.alias("h_n"),
        F.when(F.col("FechaFinReal") > F.col("FechaFinPlanificada"), 1).otherwise(0).cast("long").alias("h_late")).join(
        tpm, "ID_Hito", "left")
    amounts = _union([
        ext["proyectos"].select("ID_Proyecto", "FechaInicio", "FechaFin", "FechaInicioReal", "FechaFinReal"),
        contracts.select("ID_Proyecto", "ID_Contrato", "ValorTotalContrato", "pen"),
        ext["gastos"].select("ID_Proyecto", one.alias("e_n"), F.col("Monto").alias("e_amt"),
                             F.when(cat == CAPEX, F.col("Monto")).alias("e_capex"),
                             F.when(cat == OPEX, F.col("Monto")).alias("e_opex")),
        ext["asignaciones"].select(
            "ID_Proyecto", one.alias("a_n"),
            (F.col("HorasReales").try_cast("decimal(20,2)") * F.col("CostoPorHora").try_cast("decimal(20,2)"))
            .alias("a_cost"), F.col("HorasReales").cast("long").alias("a_hours")),
    ]).groupBy("ID_Proyecto").agg(
        F.min("FechaInicio").alias("FechaInicio"), F.min("FechaFin").alias("FechaFin"),
        F.min("FechaInicioReal").alias("FechaInicioReal"), F.min("FechaFinReal").alias("FechaFinReal"),
        # first contract = smallest id (unique); rows without a contract id are ignored by
        # min_by.  Two fixed-width min_by keep this a hash aggregate (a struct would not).
        F.min_by("ValorTotalContrato", "ID_Contrato").alias("fc_value"),
        F.min_by("pen", "ID_Contrato").alias("fc_pen"),
        F.min("ID_Contrato").alias("fc_id"),
        F.sum("e_n").alias("n_expenses"), F.sum("e_amt").alias("expense_total"),
        F.coalesce(F.sum("e_capex"), money0).alias("capex"), F.coalesce(F.sum("e_opex"), money0).alias("opex"),
        F.sum("a_n").alias("n_assign"), F.sum("a_cost").alias("labour"),
        F.coalesce(F.sum("a_hours"), F.lit(0).cast("long")).alias("hours"))
    counts = _union([
        milestones.select("ID_Proyecto", "h_n", "h_late", "t_n", "t_late"),
        ext["tareas"].select("ID_Proyecto", one.alias("k_n")),
        ext["errores"].select("ID_Proyecto", one.alias("r_n")),
        ext["pruebas"].select("ID_Proyecto", one.alias("p_n"),
                              F.coalesce(F.col("Exitosa"), zero).cast("long").alias("p_ok")),
    ]).groupBy("ID_Proyecto").agg(
        F.sum("h_n").alias("n_hitos"), F.sum("h_late").alias("late_hitos"),
        F.sum("k_n").alias("n_tasks"), F.sum("r_n").alias("n_errors"),
        F.sum("p_n").alias("n_tests"), F.sum("p_ok").alias("ok_tests"),
        F.sum("t_n").alias("dt_n"), F.sum("t_late").alias("dt_late"))
    # spine: projects of the dimension that exist in the project extract
    j = (dim_proj.select("ID_Proyecto").join(amounts, "ID_Proyecto")
         .where(F.col("FechaInicio").isNotNull() | F.col("fc_id").isNotNull()).join(counts, "ID_Proyecto", "left"))
    start = cal_summary.select("cal_start").scalar()
    days = cal_summary.select("cal_days").scalar()

    budget = F.coalesce(F.col("fc_value"), money0)
    cost = F.coalesce(F.col("expense_total"), money0) + F.coalesce(F.col("labour"), money0)
    dbl = lambda c: c.cast("double")
    ratio = lambda a, b: F.try_divide(dbl(F.col(a)), dbl(F.col(b)))
    return j.select(
        F.col("ID_Proyecto").cast("long"),
        # F2e: first row of the expense dimension (id 1 by construction) if the project has expenses
        F.when(F.coalesce(F.col("n_expenses"), zero) > 0, F.lit(1)).otherwise(zero).cast("long").alias("ID_Gasto"),
        X.date_key_ranged("FechaInicio", start, days).alias("ID_FechaInicio"),
        X.date_key_ranged(F.coalesce(F.col("FechaFinReal"), F.col("FechaFin")), start, days).alias("ID_FechaFin"),
        X.delay_days("FechaInicioReal", "FechaInicio").alias("RetrasoInicioDias"),
        X.delay_days("FechaFinReal", "FechaFin").alias("RetrasoFinalDias"),
        dbl(budget).alias("Presupuesto"),
        dbl(cost).alias("CosteReal"),
        dbl(budget - cost).alias("DesviacionPresupuestal"),
        dbl(F.coalesce(F.col("fc_pen"), money0)).alias("PenalizacionesMonto"),
        F.when(F.coalesce(F.col("opex"), money0) > 0, ratio("capex", "opex"))
         .otherwise(F.lit(0.0)).alias("ProporcionCAPEX_OPEX"),
        F.when(F.col("n_tasks") > 0, F.coalesce(ratio("n_errors", "n_tasks"), F.lit(0.0)))
         .otherwise(F.lit(0.0)).alias("TasaDeErroresEncontrados"),
        F.when(F.col("n_tests") > 0, ratio("ok_tests", "n_tests")).otherwise(F.lit(0.0))
         .alias("TasaDeExitoEnPruebas"),
        F.when((F.col("n_assign") > 0) & (F.col("n_hitos") > 0), ratio("hours", "n_hitos"))
         .otherwise(F.lit(0.0)).alias("ProductividadPromedio"),
        F.when(F.col("dt_n") > 0, ratio("dt_late", "dt_n") * 100).otherwise(F.lit(0.0))
         .alias("PorcentajeTareasRetrasadas"),
        F.when(F.col("n_hitos") > 0, ratio("late_hitos", "n_hitos") * 100)
         .otherwise(F.lit(0.0)).alias("PorcentajeHitosRetrasados"))


def hechos_proyectos(ext: dict[str, DataFrame], dim_proj: DataFrame, dim_tar: DataFrame,
                     cal_summary: DataFrame) -> DataFrame:
    """project fact with a dense id ordered by project id.

    ``ID_Gasto`` is 1 (the first row of the expense dimension, whose dense
    ids start at 1) for a project with expenses and 0 otherwise, so the
    expense dimension itself is not needed here.
    """
    m = project_measures(ext, dim_proj, dim_tar, cal_summary)
    return TB.dense_id(m, ["ID_Proyecto"], name="ID_Hecho")
