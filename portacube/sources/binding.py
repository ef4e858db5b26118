"""Operational source tables re-read from the TPC-H-shaped test tables.

The engine consumes eleven operational tables (clients, contracts, projects,
employees, assignments, milestones, tasks, tests, errors, expenses,
penalties).  The test data is a TPC-H-shaped star, so each operational table
is a fixed, deterministic re-reading of it:

* projects/contracts from ``orders`` (status F -> closed, P -> cancelled,
  O -> in progress; real start/end = first/last ship date of the lines);
* milestones from ``lineitem`` grouped by (order, line number);
* assignments, tasks, tests, expenses from the line items, errors from the
  returned ones, penalties from lines with tax >= 6 %;
* employees from ``supplier`` x ``nation``.

Money is cast to DECIMAL(15,2) on entry so sums are exact.  Composite ids
(task, test, error, expense, penalty: order, line, part, supplier; milestone,
assignment: order, line) are text, so no key value can overflow or collide.
The mirrored SQL used by the oracle checks lives in ``oracle_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.schemas import MONEY, SOURCE_SCHEMAS

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def read_test_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """Read the driver's parquet tables by name."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in (names or TEST_TABLES)}


def _d(c: str):
    return F.col(c).cast("date")


def _key(*cols: str):
    """A composite key as text, its parts apart by ``-``: different parts never give one key, at any size."""
    return F.concat_ws("-", F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in cols]))


def _task_id():
    return _key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _milestone_id():
    return _key("l_orderkey", "l_linenumber")


def bind_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy dict of the eleven operational tables over the test data."""
    t = read_test_tables(spark, sf_dir, ["nation", "customer", "supplier", "orders", "lineitem"])
    orders, li = t["orders"], t["lineitem"]

    clientes = t["customer"].select(F.col("c_custkey").alias("ID_Cliente"),
                                    F.col("c_name").alias("NombreCliente"))

    contratos = orders.select(
        F.col("o_orderkey").alias("ID_Contrato"), F.col("o_custkey").alias("ID_Cliente"),
        F.col("o_orderkey").alias("ID_Proyecto"),
        F.col("o_totalprice").cast(MONEY).alias("ValorTotalContrato"),
        F.col("o_orderstatus").alias("Estado"))

    ship = li.groupBy("l_orderkey").agg(F.min(_d("l_shipdate")).alias("real_start"),
                                        F.max(_d("l_shipdate")).alias("real_end"))
    proyectos = orders.join(ship, orders["o_orderkey"] == ship["l_orderkey"], "left").select(
        F.col("o_orderkey").alias("ID_Proyecto"),
        F.concat(F.lit("PRJ-"), F.col("o_orderkey").cast("string")).alias("NombreProyecto"),
        F.when(F.col("o_orderpriority").startswith("5"), F.lit(None).cast("string"))
         .otherwise(F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0"))).alias("Version"),
        _d("o_orderdate").alias("FechaInicio"),
        F.date_add(_d("o_orderdate"), 90).alias("FechaFin"),
        F.col("real_start").alias("FechaInicioReal"),
        F.col("real_end").alias("FechaFinReal"),
        F.when(F.col("o_orderstatus") == "F", "Cerrado")
         .when(F.col("o_orderstatus") == "P", "Cancelado").otherwise("En Curso").alias("Estado"),
        F.substring("o_orderpriority", 3, 20).alias("TipoProyecto"))

    empleados = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("ID_Empleado"), F.col("s_name").alias("NombreCompleto"),
        F.col("n_name").alias("Rol"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
         .when(F.col("s_acctbal") < 3000, "Junior")
         .when(F.col("s_acctbal") < 7000, "Semi-Senior").otherwise("Senior").alias("Seniority"),
        (F.lit(10) + F.col("s_suppkey") % 50).cast("decimal(10,2)").alias("CostoPorHora"))

    qty = F.col("l_quantity").cast("int")
    asignaciones = li.select(
        _milestone_id().alias("ID_Asignacion"), F.col("l_orderkey").alias("ID_Proyecto"),
        F.col("l_suppkey").alias("ID_Empleado"), (qty * 10).alias("HorasPlanificadas"),
        (qty * 10 + F.col("l_linenumber") - 4).alias("HorasReales"),
        _d("l_shipdate").alias("FechaAsignacion"))

    odate = orders.select("o_orderkey", _d("o_orderdate").alias("odate"))
    li_o = li.join(odate, li["l_orderkey"] == odate["o_orderkey"])
    plan_start = F.date_add(F.col("odate"), (F.col("l_linenumber") - 1) * 30)
    plan_end = F.date_add(F.col("odate"), F.col("l_linenumber") * 30)

    hitos = (li_o.groupBy("l_orderkey", "l_linenumber", "odate")
             .agg(F.max(_d("l_shipdate")).alias("real_end"))
             .select(_milestone_id().alias("ID_Hito"), F.col("l_orderkey").alias("ID_Proyecto"),
                     F.concat(F.lit("Hito "), F.col("l_linenumber").cast("string")).alias("Descripcion"),
                     F.lit("Completado").alias("Estado"),
                     plan_start.alias("FechaInicio"), plan_end.alias("FechaFinPlanificada"),
                     F.col("real_end").alias("FechaFinReal")))

    tareas = li_o.select(
        _task_id().alias("ID_Tarea"), _milestone_id().alias("ID_Hito"),
        F.concat(F.lit("Tarea "), F.col("l_partkey").cast("string")).alias("NombreTarea"),
        F.lit(None).cast("string").alias("Descripcion"),
        F.col("l_linestatus").alias("Estado"),
        plan_start.alias("FechaInicioPlanificada"),
        F.date_add(plan_start, (F.col("l_partkey") % 3).cast("int") - 1).alias("FechaInicioReal"),
        plan_end.alias("FechaFinPlanificada"),
        F.when(F.col("l_linestatus") == "F", _d("l_shipdate")).alias("FechaFinReal"))

    pruebas = li.select(
        _task_id().alias("ID_Prueba"), _milestone_id().alias("ID_Hito"),
        F.when(F.col("l_returnflag") == "A", "Unitaria").when(F.col("l_returnflag") == "N", "Integracion")
         .otherwise("Regresion").alias("TipoPrueba"),
        _d("l_shipdate").alias("Fecha"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("Exitosa"))

    errores = li.where(F.col("l_returnflag") == "R").select(
        _task_id().alias("ID_Error"), _task_id().alias("ID_Tarea"), F.lit("Devolucion").alias("TipoError"),
        F.lit(None).cast("string").alias("Descripcion"), F.lit("Produccion").alias("FaseDeteccion"),
        _d("l_shipdate").alias("FechaDeteccion"), F.lit(None).cast("date").alias("FechaCorreccion"))

    gastos = li.select(
        _task_id().alias("ID_Gasto"), F.col("l_orderkey").alias("ID_Proyecto"),
        F.when(F.col("l_returnflag") == "A", "Material").when(F.col("l_returnflag") == "N", "Servicios")
         .otherwise("Licencias").alias("TipoGasto"),
        F.when(F.col("l_returnflag") == "A",
               F.when(F.col("l_linenumber") == 7, "capex").otherwise("CAPEX")).otherwise("OPEX")
         .alias("Categoria"),
        F.col("l_extendedprice").cast(MONEY).alias("Monto"),
        _d("l_shipdate").alias("Fecha"))

    penalizaciones = li.where(F.col("l_tax") >= 0.06).select(
        _task_id().alias("ID_Penalizacion"), F.col("l_orderkey").alias("ID_Contrato"),
        (F.col("l_extendedprice").cast(MONEY) * F.col("l_tax").cast("decimal(4,2)")).cast(MONEY).alias("Monto"),
        F.lit("Retraso").alias("Motivo"), _d("l_shipdate").alias("Fecha"))

    out = {"clientes": clientes, "contratos": contratos, "proyectos": proyectos,
           "empleados": empleados, "asignaciones": asignaciones, "hitos": hitos, "tareas": tareas,
           "pruebas": pruebas, "errores": errores, "gastos": gastos,
           "penalizaciones_contrato": penalizaciones}
    # project onto the declared source schemas (names, order, types)
    return {k: v.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_SCHEMAS[k].fields])
            for k, v in out.items()}


#: column of the last change, as the operational tables carry it
STAMP = "fecha_modificacion"
#: when the rows below were changed, and all others were written
CHANGED_AT, WRITTEN_AT = "2024-02-01 00:00:00", "2023-01-01 00:00:00"


def bind_changed_sources(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The operational tables as they were, and as they are (``bind_sources``), with the time of each row's last change.

    By the number of their order, some tasks have ended since, some penalties
    and expenses are new, some projects have closed; some employees cost less.
    """
    now = bind_sources(spark, sf_dir)

    def order(c: str):
        return F.split(c, "-")[0].cast("long")
    hit = {"tareas": order("ID_Tarea") % 211 == 1, "penalizaciones_contrato": F.col("ID_Contrato") % 223 == 2,
           "proyectos": F.col("ID_Proyecto") % 227 == 3, "gastos": F.col("ID_Proyecto") % 229 == 4,
           "empleados": F.col("ID_Empleado") % 97 == 5}
    then = {**now, "tareas": now["tareas"].withColumn("FechaFinReal", F.when(~hit["tareas"], F.col("FechaFinReal"))),
            "penalizaciones_contrato": now["penalizaciones_contrato"].where(~hit["penalizaciones_contrato"]),
            "proyectos": now["proyectos"].withColumn("Estado", F.when(hit["proyectos"], "En Curso").otherwise(F.col("Estado"))),
            "gastos": now["gastos"].where(~hit["gastos"]),
            "empleados": now["empleados"].withColumn("CostoPorHora", (F.col("CostoPorHora") + F.when(
                hit["empleados"], 5).otherwise(0)).cast("decimal(10,2)"))}
    stamp = {n: F.when(hit[n], F.lit(CHANGED_AT)).otherwise(F.lit(WRITTEN_AT)) if n in hit else F.lit(WRITTEN_AT) for n in now}
    return ({n: df.withColumn(STAMP, F.lit(WRITTEN_AT).cast("timestamp")) for n, df in then.items()},
            {n: df.withColumn(STAMP, stamp[n].cast("timestamp")) for n, df in now.items()})
