"""Schemas, key lists, category domains and KPI thresholds.

Source tables keep the operational column names, warehouse tables keep the
dimensional model's column names, so existing reports keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES — these literals must equal the original system's for equal
# results (status texts, default texts, labels, bin edges, thresholds).
# --------------------------------------------------------------------------
STATUS_CLOSED = "Cerrado"
STATUS_CANCELLED = "Cancelado"
IN_SCOPE_STATUSES = (STATUS_CLOSED, STATUS_CANCELLED)
INCLUSION_IN = "Por proyecto"
INCLUSION_OUT = "No aplica"
DEFAULT_TEXT = "No especificado"
DEFAULT_VERSION = "1.0"
PENALTY_TYPE = "Penalizaciones"
PENALTY_CATEGORY = "OPEX"
CAPEX = "CAPEX"
OPEX = "OPEX"
# cancel flag -> project state label
STATE_BY_FLAG = {0: "Cerrado", 1: "Cancelado"}
# right-closed bins: (edges, labels)
BUDGET_BINS = ([0.0, 50000.0, 100000.0, 200000.0, float("inf")],
               ["Pequeño", "Mediano", "Grande", "Mega"])
PRODUCTIVITY_BINS = ([0.0, 200.0, 400.0, 600.0, float("inf")],
                     ["Baja", "Media", "Alta", "Muy Alta"])
QUALITY_BINS = ([0.0, 0.7, 0.85, 0.95, 1.0],
                ["Baja", "Media", "Alta", "Excelente"])
DEVIATION_LABELS = ("Sobre Presupuesto", "Bajo Presupuesto", "En Presupuesto")
# date-key conventions of the two builders and the default calendar range
CALENDAR_DEFAULT_START = "2019-01-01"
CALENDAR_DEFAULT_END = "2025-12-31"
# margin labels of the pivot cubes
MARGIN_TOTAL = "TOTAL"
MARGIN_ALL = "All"
MARGIN_AVERAGE = "PROMEDIO"
# KPI status and alert texts
KPI_GOOD, KPI_REGULAR, KPI_BAD = "bueno", "regular", "malo"
SEVERITY_HIGH, SEVERITY_MEDIUM = "alta", "media"
ALERT_REVIEW_PREFIX = "Revisar procesos relacionados con "
ALERT_MONITOR_PREFIX = "Monitorear "
ALERT_MONITOR_SUFFIX = " de cerca"
DESCRIPTION_OLAP_SUFFIX = " (OLAP)"
# KPI: (name, target, unit, description, direction, good cut, bad cut)
# direction "higher": good if v >= good, bad if v < bad.
# direction "lower":  good if v <= good, bad if v > bad.  Otherwise regular.
KPI_DEFINITIONS = [
    ("cumplimiento_presupuesto", 90.0, "%", "Capacidad de ejecutar proyectos dentro del presupuesto", "higher", 90.0, 85.0),
    ("desviacion_presupuestal", 5.0, "%", "Variación promedio entre presupuesto y costo real", "lower", 5.0, 10.0),
    ("penalizaciones", 2.0, "%", "Impacto financiero de penalizaciones contractuales", "lower", 2.0, 5.0),
    ("proyectos_a_tiempo", 85.0, "%", "Puntualidad en la entrega de proyectos", "higher", 85.0, 70.0),
    ("proyectos_cancelados", 5.0, "%", "Tasa de proyectos no completados", "lower", 5.0, 10.0),
    ("tareas_retrasadas", 10.0, "%", "Porcentaje de tareas que no cumplen fechas", "lower", 10.0, 20.0),
    ("hitos_retrasados", 10.0, "%", "Retrasos en hitos críticos del proyecto", "lower", 10.0, 20.0),
    ("tasa_errores", 5.0, "%", "Proporción de errores durante desarrollo", "lower", 5.0, 10.0),
    ("productividad", 75.0, "%", "Eficiencia del equipo (valor/esfuerzo)", "higher", 75.0, 60.0),
    ("exito_pruebas", 90.0, "%", "Efectividad del proceso de testing", "higher", 90.0, 80.0),
    ("relacion_horas", 110.0, "%", "Precisión en estimación de esfuerzo", "lower", 110.0, 130.0),
]
# client badge cut points (good >= 90, warning >= 85, else bad)
CLIENT_BADGE = (90.0, 85.0, "good", "warning", "bad")
# custom-cube default aggregation by measure name (first match wins)
NAME_AGG_RULES = [
    (("Presupuesto", "Costo", "Monto"), "sum"),
    (("Porcentaje", "Tasa", "Productividad"), "mean"),
    (("ID_",), "count"),
]
# --------------------------------------------------------------------------

MONEY = T.DecimalType(15, 2)

_L, _I, _S, _D, _DT = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in
                         [(c + (True,))[:3] for c in cols]])


# Operational source tables (inputs of the extracts)
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "clientes": _schema(("ID_Cliente", _L), ("NombreCliente", _S)),
    "contratos": _schema(("ID_Contrato", _L), ("ID_Cliente", _L), ("ID_Proyecto", _L),
                         ("ValorTotalContrato", MONEY), ("Estado", _S)),
    "proyectos": _schema(("ID_Proyecto", _L), ("NombreProyecto", _S), ("Version", _S),
                         ("FechaInicio", _DT), ("FechaFin", _DT), ("FechaInicioReal", _DT),
                         ("FechaFinReal", _DT), ("Estado", _S), ("TipoProyecto", _S)),
    "empleados": _schema(("ID_Empleado", _L), ("NombreCompleto", _S), ("Rol", _S),
                         ("Seniority", _S), ("CostoPorHora", T.DecimalType(10, 2))),
    "asignaciones": _schema(("ID_Asignacion", _S), ("ID_Proyecto", _L), ("ID_Empleado", _L),
                            ("HorasPlanificadas", _I), ("HorasReales", _I), ("FechaAsignacion", _DT)),
    "hitos": _schema(("ID_Hito", _S), ("ID_Proyecto", _L), ("Descripcion", _S), ("Estado", _S),
                     ("FechaInicio", _DT), ("FechaFinPlanificada", _DT), ("FechaFinReal", _DT)),
    "tareas": _schema(("ID_Tarea", _S), ("ID_Hito", _S), ("NombreTarea", _S), ("Descripcion", _S),
                      ("Estado", _S), ("FechaInicioPlanificada", _DT), ("FechaInicioReal", _DT),
                      ("FechaFinPlanificada", _DT), ("FechaFinReal", _DT)),
    "pruebas": _schema(("ID_Prueba", _S), ("ID_Hito", _S), ("TipoPrueba", _S), ("Fecha", _DT),
                       ("Exitosa", _I)),
    "errores": _schema(("ID_Error", _S), ("ID_Tarea", _S), ("TipoError", _S), ("Descripcion", _S),
                       ("FaseDeteccion", _S), ("FechaDeteccion", _DT), ("FechaCorreccion", _DT)),
    "gastos": _schema(("ID_Gasto", _S), ("ID_Proyecto", _L), ("TipoGasto", _S), ("Categoria", _S),
                      ("Monto", MONEY), ("Fecha", _DT)),
    "penalizaciones_contrato": _schema(("ID_Penalizacion", _S), ("ID_Contrato", _L), ("Monto", MONEY),
                                       ("Motivo", _S), ("Fecha", _DT)),
}

# Warehouse tables (outputs of the builders). FLOAT columns are kept as DOUBLE.
WAREHOUSE_SCHEMAS: dict[str, T.StructType] = {
    "dim_clientes": _schema(("ID_Cliente", _L, False), ("CodigoClienteReal", _L, False)),
    "dim_empleados": _schema(("ID_Empleado", _L, False), ("CodigoEmpleado", _L, False),
                             ("Rol", _S), ("Seniority", _S)),
    "dim_gastos": _schema(("ID_Finanza", _L, False), ("TipoGasto", _S, False), ("Categoria", _S),
                          ("Monto", MONEY, False)),
    "dim_proyectos": _schema(("ID_Proyecto", _L, False), ("CodigoProyecto", _L, False), ("Version", _S),
                             ("Cancelado", _I), ("ID_Cliente", _L), ("TotalErrores", _I),
                             ("NumTrabajadores", _I)),
    "dim_tiempo": _schema(("ID_Tiempo", _I, False), ("Fecha", _DT), ("Dia", _I), ("Mes", _I), ("Anio", _I)),
    "dim_hitos": _schema(("ID_Hito", _S, False), ("CodigoHito", _S, False), ("ID_proyectos", _L),
                         ("ID_FechaInicio", _I), ("ID_FechaFin", _I), ("RetrasoInicioDias", _I),
                         ("RetrasoFinDias", _I)),
    "dim_pruebas": _schema(("ID_Prueba", _S, False), ("CodigoPrueba", _S, False), ("ID_Hito", _S, False),
                           ("TipoPrueba", _S), ("PruebaExitosa", _I)),
    "dim_tareas": _schema(("ID_Tarea", _S, False), ("CodigoTarea", _S, False), ("ID_Hito", _S, False),
                          ("SeRetraso", _I)),
    "hechos_asignaciones": _schema(("ID_HechoAsignacion", _L, False), ("ID_Empleado", _L),
                                   ("ID_Proyecto", _L), ("ID_FechaAsignacion", _I),
                                   ("HorasPlanificadas", _I), ("HorasReales", _I),
                                   ("ValorHoras", MONEY), ("RetrasoHoras", _I)),
    "hechos_proyectos": _schema(("ID_Hecho", _L, False), ("ID_Proyecto", _L), ("ID_Gasto", _L),
                                ("ID_FechaInicio", _I), ("ID_FechaFin", _I), ("RetrasoInicioDias", _I),
                                ("RetrasoFinalDias", _I), ("Presupuesto", _D, False), ("CosteReal", _D),
                                ("DesviacionPresupuestal", _D), ("PenalizacionesMonto", _D),
                                ("ProporcionCAPEX_OPEX", _D), ("TasaDeErroresEncontrados", _D),
                                ("TasaDeExitoEnPruebas", _D), ("ProductividadPromedio", _D),
                                ("PorcentajeTareasRetrasadas", _D), ("PorcentajeHitosRetrasados", _D)),
}

# Parent-before-child load order of the warehouse.
LOAD_ORDER = ["dim_clientes", "dim_empleados", "dim_proyectos", "dim_tiempo", "dim_gastos",
              "dim_hitos", "dim_tareas", "dim_pruebas", "hechos_asignaciones", "hechos_proyectos"]

PRIMARY_KEYS = {
    "dim_clientes": "ID_Cliente", "dim_empleados": "ID_Empleado", "dim_gastos": "ID_Finanza",
    "dim_proyectos": "ID_Proyecto", "dim_tiempo": "ID_Tiempo", "dim_hitos": "ID_Hito",
    "dim_pruebas": "ID_Prueba", "dim_tareas": "ID_Tarea",
    "hechos_asignaciones": "ID_HechoAsignacion", "hechos_proyectos": "ID_Hecho",
}

# (child table, column, parent table, parent key) — 13 declared relations.
FOREIGN_KEYS = [
    ("dim_proyectos", "ID_Cliente", "dim_clientes", "ID_Cliente"),
    ("dim_hitos", "ID_proyectos", "dim_proyectos", "ID_Proyecto"),
    ("dim_hitos", "ID_FechaInicio", "dim_tiempo", "ID_Tiempo"),
    ("dim_hitos", "ID_FechaFin", "dim_tiempo", "ID_Tiempo"),
    ("dim_pruebas", "ID_Hito", "dim_hitos", "ID_Hito"),
    ("dim_tareas", "ID_Hito", "dim_hitos", "ID_Hito"),
    ("hechos_asignaciones", "ID_Empleado", "dim_empleados", "ID_Empleado"),
    ("hechos_asignaciones", "ID_Proyecto", "dim_proyectos", "ID_Proyecto"),
    ("hechos_asignaciones", "ID_FechaAsignacion", "dim_tiempo", "ID_Tiempo"),
    ("hechos_proyectos", "ID_Proyecto", "dim_proyectos", "ID_Proyecto"),
    ("hechos_proyectos", "ID_Gasto", "dim_gastos", "ID_Finanza"),
    ("hechos_proyectos", "ID_FechaInicio", "dim_tiempo", "ID_Tiempo"),
    ("hechos_proyectos", "ID_FechaFin", "dim_tiempo", "ID_Tiempo"),
]

# NOT NULL columns declared by the warehouse DDL.
NOT_NULL_COLUMNS = {
    "dim_clientes": ["CodigoClienteReal"],
    "dim_empleados": ["CodigoEmpleado"],
    "dim_gastos": ["TipoGasto", "Monto"],
    "dim_proyectos": ["CodigoProyecto"],
    "dim_hitos": ["CodigoHito"],
    "dim_pruebas": ["CodigoPrueba", "ID_Hito", "TipoPrueba"],
    "dim_tareas": ["CodigoTarea", "ID_Hito"],
    "hechos_asignaciones": ["ID_HechoAsignacion", "ID_Empleado", "ID_Proyecto"],
    "hechos_proyectos": ["ID_Proyecto", "Presupuesto"],
}

# Column defaults declared by the warehouse DDL (applied when conforming).
COLUMN_DEFAULTS = {
    "dim_proyectos": {"Cancelado": 0},
    "hechos_asignaciones": {"HorasPlanificadas": 0, "HorasReales": 0},
    "hechos_proyectos": {"RetrasoInicioDias": 0, "CosteReal": 0.0, "DesviacionPresupuestal": 0.0,
                         "PenalizacionesMonto": 0.0, "TasaDeErroresEncontrados": 0.0,
                         "PorcentajeTareasRetrasadas": 0.0, "PorcentajeHitosRetrasados": 0.0},
}
