"""DuckDB SQL for every registered query (see ``oracle_sql.py`` for the shared CTEs)."""

from __future__ import annotations

from oracle_sql import ALL_CTES, q

# ------------------------------------------------------------------ helpers


def _nn(cols):
    return " AND ".join(f"{c} IS NOT NULL" for c in cols) or "TRUE"


def _esum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,9))) AS DOUBLE)"


def _emean(x: str) -> str:
    return f"({_esum(x)} / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def _agg(kind: str, x: str, integral: bool = False) -> str:
    return {"sum": f"SUM({x})" if integral else _esum(x), "mean": _emean(x), "count": f"COUNT({x})",
            "min": f"MIN({x})", "max": f"MAX({x})", "mean100": f"({_emean(x)} * 100)"}[kind]


def _cast(kind: str, integral: bool) -> str:
    if kind == "count":
        return "BIGINT"
    if kind in ("mean", "mean100"):
        return "DOUBLE"
    return "BIGINT" if integral else "DOUBLE"


INTEGRAL = {"ID_Proyecto", "NumTrabajadores", "Cancelado", "TotalErrores", "AnioInicio", "MesInicio"}


def crosstab_sql(src: str, rows, cols, measures: dict, fill=None, label="All") -> str:
    """Bare SELECT (no CTE prefix) of the long-form pivot with margins over ``src``."""
    keys = list(rows) + list(cols)
    sets = [keys] + ([list(rows), list(cols), []] if rows and cols else [[]])
    gs = ", ".join("(" + ", ".join(s) + ")" for s in sets)
    g = f"GROUPING({', '.join(keys)})"
    present = _nn(measures)
    aggs = []
    for m, kind in measures.items():
        t = _cast(kind, m in INTEGRAL)
        integral = m in INTEGRAL
        cell = _agg(kind, m, integral)
        if kind == "sum":
            cell = f"COALESCE({cell}, 0)"
        aggs.append(f"CAST(CASE WHEN {g} = 0 THEN {cell} ELSE "
                    f"{_agg(kind, f'CASE WHEN {present} THEN {m} END', integral)}"
                    f" END AS {t}) AS {m}")
    n = len(keys)
    key_out = [f"CASE WHEN (grouping_id & {1 << (n - 1 - i)}) <> 0 THEN '{label}' ELSE CAST({k} AS VARCHAR) END AS {k}"
               for i, k in enumerate(keys)]
    meas_out = [(f"COALESCE({m}, {fill})" if fill is not None else m) + f" AS {m}" for m in measures]
    inner = (f"SELECT {', '.join(keys)}, CAST({g} AS INTEGER) AS grouping_id, {', '.join(aggs)} "
             f"FROM (SELECT * FROM {src} WHERE {_nn(keys)}) GROUP BY GROUPING SETS ({gs})")
    any_present = " OR ".join(f"{m} IS NOT NULL" for m in measures)
    return f"SELECT {', '.join(key_out + ['grouping_id'] + meas_out)} FROM ({inner}) WHERE {any_present}"


def _with(extra_cte: str, select: str) -> str:
    """q() plus one more CTE appended after the shared ones."""
    from oracle_sql import ALL_CTES
    return f"WITH {ALL_CTES},\n{extra_cte}\n{select}"


def _crosstab(src_select: str, rows, cols, measures, fill=None, label="All") -> str:
    body = crosstab_sql("__src", rows, cols, measures, fill, label)
    return _with(f"__src AS ({src_select})", body)


def _measure_aggs(measures, extra=False):
    out = []
    for m in measures:
        c = f"CAST({m} AS DOUBLE)"
        out += [f"COALESCE({_esum(c)}, 0.0) AS {m}_sum", f"COALESCE({_emean(c)}, 0.0) AS {m}_mean",
                f"COUNT({c}) AS {m}_count"]
        if extra:
            out += [f"MIN({c}) AS {m}_min", f"MAX({c}) AS {m}_max"]
    return ", ".join(out)


KPI_DIMS = ["Estado", "CategoriaPresupuesto", "CategoriaProductividad", "CategoriaCalidad", "AnioInicio", "PeriodoInicio"]
KPI_MEAS = ["Presupuesto", "CosteReal", "DesviacionPresupuestal", "ProductividadPromedio", "TasaDeExitoEnPruebas",
            "PorcentajeTareasRetrasadas", "PorcentajeHitosRetrasados", "TasaDeErroresEncontrados", "PenalizacionesMonto"]


def _group_select(src: str, dims, measures=KPI_MEAS) -> str:
    if not dims:
        return f"SELECT {_measure_aggs(measures, True)} FROM {src}"
    d = ", ".join(dims)
    return f"SELECT {d}, {_measure_aggs(measures)} FROM {src} WHERE {_nn(dims)} GROUP BY {d}"


def _group(src: str, dims, measures=KPI_MEAS) -> str:
    return q(_group_select(src, dims, measures))


def _safe(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _capped(x: str, cap: float) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN least({x}, {cap}) END)"


def _pct(cond: str) -> str:
    return f"(CASE WHEN COALESCE({cond}, FALSE) THEN 100.0 ELSE 0.0 END)"


def _share(cond: str) -> str:
    return f"(CAST(SUM(CASE WHEN COALESCE({cond}, FALSE) THEN 1 ELSE 0 END) AS DOUBLE) * 100 / COUNT(*))"


COMPLIANCE_P8 = ("(CASE WHEN Presupuesto > 0 THEN (CASE WHEN CosteReal = 0 THEN 100.0 ELSE "
                 f"{_capped(_safe('Presupuesto', 'CosteReal') + ' * 100', 100.0)} END) ELSE 100.0 END)")
COMPLIANCE_IND = ("(CASE WHEN CosteReal = 0 AND Presupuesto > 0 THEN 100.0 ELSE "
                  f"{_capped(_safe('Presupuesto', 'CosteReal'), 1.0)} * 100 END)")
DEVIATION_PCT = f"({_safe('abs(CosteReal - Presupuesto)', 'Presupuesto')} * 100)"

KPI_MEASURES_SRC = f"""SELECT *,
  {COMPLIANCE_P8} AS cumplimiento_presupuesto,
  CASE WHEN Presupuesto > 0 THEN abs(CosteReal - Presupuesto) / Presupuesto * 100 ELSE 0.0 END AS desviacion_presupuestal,
  CASE WHEN Presupuesto > 0 THEN PenalizacionesMonto / Presupuesto * 100 ELSE 0.0 END AS penalizaciones_pct,
  {_pct('RetrasoFinalDias <= 0')} AS proyecto_a_tiempo,
  CAST(Cancelado * 100 AS DOUBLE) AS proyecto_cancelado,
  {_pct('RetrasoFinalDias <= 0 AND Cancelado = 0 AND TasaDeExitoEnPruebas >= 0.9')} AS proyecto_exitoso
FROM olap"""

# Fixed values of the KPI table: name: (target, direction, good, bad, description); the unit is % throughout.
KPI_TABLE = {
    "cumplimiento_presupuesto": (90, "higher", 90, 85, "Capacidad de ejecutar proyectos dentro del presupuesto"),
    "desviacion_presupuestal": (5, "lower", 5, 10, "Variación promedio entre presupuesto y costo real"),
    "penalizaciones": (2, "lower", 2, 5, "Impacto financiero de penalizaciones contractuales"),
    "proyectos_a_tiempo": (85, "higher", 85, 70, "Puntualidad en la entrega de proyectos"),
    "proyectos_cancelados": (5, "lower", 5, 10, "Tasa de proyectos no completados"),
    "tareas_retrasadas": (10, "lower", 10, 20, "Porcentaje de tareas que no cumplen fechas"),
    "hitos_retrasados": (10, "lower", 10, 20, "Retrasos en hitos críticos del proyecto"),
    "tasa_errores": (5, "lower", 5, 10, "Proporción de errores durante desarrollo"),
    "productividad": (75, "higher", 75, 60, "Eficiencia del equipo (valor/esfuerzo)"),
    "exito_pruebas": (90, "higher", 90, 80, "Efectividad del proceso de testing"),
    "relacion_horas": (110, "lower", 110, 130, "Precisión en estimación de esfuerzo"),
}


def _kpi_rows(values: dict, suffix: bool, src: str) -> str:
    parts = []
    for name, expr in values.items():
        target, direction, good, bad, desc = KPI_TABLE[name]
        desc, unit = desc + (" (OLAP)" if suffix else ""), "%"
        if direction == "higher":
            status = f"CASE WHEN v >= {good} THEN 'bueno' WHEN v < {bad} THEN 'malo' ELSE 'regular' END"
        else:
            status = f"CASE WHEN v <= {good} THEN 'bueno' WHEN v > {bad} THEN 'malo' ELSE 'regular' END"
        parts.append(f"SELECT '{name}' AS kpi, round_even(v, 2) AS valor, CAST({target} AS DOUBLE) AS objetivo, "
                     f"'{unit}' AS unidad, '{desc}' AS descripcion, {status} AS estado "
                     f"FROM (SELECT CAST({expr} AS DOUBLE) AS v FROM {src})")
    return " UNION ALL ".join(parts)


KPI_A = {
    "cumplimiento_presupuesto": _share("CosteReal <= Presupuesto"),
    "desviacion_presupuestal": _emean(DEVIATION_PCT),
    "penalizaciones": _emean(_safe("PenalizacionesMonto", "Presupuesto") + " * 100"),
    "proyectos_a_tiempo": _share("RetrasoFinalDias <= 0"),
    "proyectos_cancelados": f"({_emean('Cancelado')} * 100)",
    "tareas_retrasadas": _emean("PorcentajeTareasRetrasadas"),
    "hitos_retrasados": _emean("PorcentajeHitosRetrasados"),
    "tasa_errores": f"({_emean('1 - TasaDeExitoEnPruebas')} * 100)",
    "productividad": _capped(f"({_emean('ProductividadPromedio')} / 1000 * 100)", 100.0),
    "exito_pruebas": f"({_emean('TasaDeExitoEnPruebas')} * 100)",
}
KPI_B = dict(KPI_A)
KPI_B.update({
    "cumplimiento_presupuesto": _emean(COMPLIANCE_IND),
    "proyectos_cancelados": _share("Cancelado = 1"),
    "productividad": _emean(f"(1000.0 - {_capped('ProductividadPromedio', 1000.0)}) / 1000 * 100"),
})
HOURS = ("SELECT " + _safe("SUM(CAST(HorasReales AS BIGINT))", "SUM(CAST(HorasPlanificadas AS BIGINT))")
         + " * 100 AS relacion_horas FROM hechos_asignaciones")


def _kpi_table(values: dict, suffix: bool) -> str:
    return q(_kpi_rows(values, suffix, "olap") + " UNION ALL "
             + _kpi_rows({"relacion_horas": "relacion_horas"}, suffix, f"({HOURS})"))


def _alerts() -> str:
    base = _kpi_rows(KPI_A, True, "olap") + " UNION ALL " + _kpi_rows({"relacion_horas": "relacion_horas"}, True,
                                                                       f"({HOURS})")
    return q(f"""SELECT kpi, valor, objetivo, unidad, descripcion,
  CASE WHEN estado = 'malo' THEN 'alta' ELSE 'media' END AS severidad,
  CASE WHEN estado = 'malo' THEN 'Revisar procesos relacionados con ' || replace(kpi, '_', ' ')
       ELSE 'Monitorear ' || replace(kpi, '_', ' ') || ' de cerca' END AS recomendacion
FROM ({base}) WHERE estado <> 'bueno'""")


BY_CLIENT = f"""SELECT CodigoClienteReal,
  round_even({_emean(COMPLIANCE_IND)}, 2) AS cumplimiento_presupuesto,
  round_even({_emean(DEVIATION_PCT)}, 2) AS desviacion_presupuestal,
  round_even({_share('RetrasoFinalDias <= 0')}, 2) AS proyectos_a_tiempo,
  COUNT(ID_Hecho) AS total_proyectos,
  round_even({_esum('Presupuesto')}, 2) AS presupuesto_total
FROM olap WHERE CodigoClienteReal IS NOT NULL GROUP BY CodigoClienteReal"""

WH_TABLES = {"dim_clientes": 2, "dim_empleados": 4, "dim_gastos": 4, "dim_proyectos": 7, "dim_tiempo": 5,
             "dim_hitos": 7, "dim_pruebas": 5, "dim_tareas": 4, "hechos_asignaciones": 8, "hechos_proyectos": 17}
FKS = [("dim_proyectos", "ID_Cliente", "dim_clientes", "ID_Cliente"),
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
       ("hechos_proyectos", "ID_FechaFin", "dim_tiempo", "ID_Tiempo")]
PKS = {"dim_clientes": "ID_Cliente", "dim_empleados": "ID_Empleado", "dim_gastos": "ID_Finanza",
       "dim_proyectos": "ID_Proyecto", "dim_tiempo": "ID_Tiempo", "dim_hitos": "ID_Hito", "dim_pruebas": "ID_Prueba",
       "dim_tareas": "ID_Tarea", "hechos_asignaciones": "ID_HechoAsignacion", "hechos_proyectos": "ID_Hecho"}
NOT_NULL = {"dim_clientes": ["CodigoClienteReal"], "dim_empleados": ["CodigoEmpleado"],
            "dim_gastos": ["TipoGasto", "Monto"], "dim_proyectos": ["CodigoProyecto"], "dim_hitos": ["CodigoHito"],
            "dim_pruebas": ["CodigoPrueba", "ID_Hito", "TipoPrueba"], "dim_tareas": ["CodigoTarea", "ID_Hito"],
            "hechos_asignaciones": ["ID_HechoAsignacion", "ID_Empleado", "ID_Proyecto"],
            "hechos_proyectos": ["ID_Proyecto", "Presupuesto"]}

ORACLE: dict[str, str] = {
    "extract_clients_semi": q("SELECT ID_Cliente, NombreCliente FROM x_clientes"),
    "extract_employees_semi": q("SELECT ID_Empleado, NombreCompleto, Rol, Seniority, CostoPorHora FROM x_empleados"),
    "extract_contracts": q("SELECT ID_Contrato, ID_Cliente, ID_Proyecto, ValorTotalContrato, Estado FROM x_contratos"),
    "extract_projects_left": q("SELECT * FROM x_proyectos"),
    "extract_milestones_delay": q("SELECT * FROM x_hitos"),
    "extract_tasks": q("SELECT * FROM x_tareas"),
    "extract_assignments_cost": q("SELECT * FROM x_asignaciones"),
    "extract_tests": q("SELECT * FROM x_pruebas"),
    "extract_errors": q("SELECT * FROM x_errores"),
    "extract_expenses": q("SELECT * FROM x_gastos"),
    "extract_penalties": q("SELECT * FROM x_penalizaciones"),
    # an incremental load equals a full one of the same sources
    "incremental_merge": q("SELECT * EXCLUDE (ID_Hecho) FROM hechos_proyectos"),
    "incremental_tasks": q("SELECT * FROM dim_tareas"),
    "incremental_assignments": q("SELECT * EXCLUDE (ID_HechoAsignacion) FROM hechos_asignaciones"),
    # keys of the first load in their order, then those that are new since
    "stable_ids": _with("""
ids_rows AS (
  SELECT 'dim_gastos' AS "table", (CASE WHEN src = 0 THEN 'g:' ELSE 'p:' END) || COALESCE(k3, '?') AS natural_key,
         k1 % 227 <> 3 AND NOT (src = 0 AND k1 % 229 = 4) AND NOT (src = 1 AND k1 % 223 = 2) AS was,
         row_number() OVER (ORDER BY src, k1, k2, k3, TipoGasto, Categoria, Monto) AS place
  FROM dg_u
  UNION ALL
  SELECT 'hechos_asignaciones', ID_Asignacion, ID_Proyecto % 227 <> 3,
         row_number() OVER (ORDER BY ID_Proyecto, FechaAsignacion, ID_Asignacion, ID_Empleado, HorasPlanificadas, HorasReales)
  FROM ha_base
  UNION ALL
  SELECT 'hechos_proyectos', CAST(ID_Proyecto AS VARCHAR), ID_Proyecto % 227 <> 3, row_number() OVER (ORDER BY ID_Proyecto)
  FROM hp_m)""", """SELECT "table", natural_key,
       row_number() OVER (PARTITION BY "table", natural_key ORDER BY place) - 1 AS occurrence,
       row_number() OVER (PARTITION BY "table" ORDER BY NOT was, place) AS id
FROM ids_rows"""),
    "incremental_filter": q("SELECT * FROM x_proyectos WHERE FechaInicio > DATE '1998-01-01'"),
    "table_profile": q(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, {n} AS n_cols FROM {t}" for t, n in WH_TABLES.items())),
    "profile_headlines": q(f"SELECT {_esum('Presupuesto')} AS presupuesto_total, {_esum('CosteReal')} AS costo_total, "
                           f"{_emean('DesviacionPresupuestal')} AS desviacion_promedio, "
                           f"{_emean('ProductividadPromedio')} AS productividad_promedio, "
                           f"{_emean('TasaDeExitoEnPruebas')} AS exito_promedio FROM olap"),
    "fk_filter": q("SELECT ID_Asignacion, ID_Proyecto, ID_Empleado FROM x_asignaciones "
                   "WHERE ID_Proyecto IN (SELECT ID_Proyecto FROM dim_proyectos)"),
    "orphan_count": q("SELECT COUNT(*) AS orphans FROM s_asignaciones WHERE ID_Proyecto IS NOT NULL AND "
                      "ID_Proyecto NOT IN (SELECT ID_Proyecto FROM dim_proyectos)"),
    "keep_first": q("SELECT ID_Empleado, FechaAsignacion, ID_Proyecto, ID_Asignacion, HorasPlanificadas, HorasReales FROM ("
                    "SELECT *, row_number() OVER (PARTITION BY ID_Empleado ORDER BY FechaAsignacion NULLS FIRST, "
                    "ID_Proyecto NULLS FIRST, ID_Asignacion NULLS FIRST, HorasPlanificadas NULLS FIRST, "
                    "HorasReales NULLS FIRST) AS rn FROM x_asignaciones) WHERE rn = 1"),
    "lookup_last": q("SELECT a.ID_Asignacion, a.ID_Proyecto, a.ID_Empleado, c.CostoPorHora FROM s_asignaciones a "
                     "LEFT JOIN (SELECT ID_Empleado, MAX(CostoPorHora) AS CostoPorHora FROM x_empleados "
                     "GROUP BY ID_Empleado) c ON a.ID_Empleado = c.ID_Empleado"),
    "dense_id": q("SELECT CAST(row_number() OVER (ORDER BY ID_Proyecto NULLS FIRST, Fecha NULLS FIRST, "
                  "ID_Gasto NULLS FIRST) AS BIGINT) AS row_id, ID_Gasto, ID_Proyecto, Fecha FROM x_gastos"),
    "date_key_clamped": q(
        "SELECT ID_Hito, CAST(CASE WHEN FechaInicio IS NULL THEN NULL ELSE greatest(datediff('day', DATE '1996-06-01', "
        "FechaInicio) + 1, 1) END AS INTEGER) AS key_start, CAST(CASE WHEN FechaFinReal IS NULL THEN 0 ELSE "
        "least(greatest(datediff('day', DATE '1996-06-01', FechaFinReal) + 1, 1), 1500) END AS INTEGER) AS key_end "
        "FROM x_hitos"),
    "date_key_ranged": q(
        "SELECT ID_Proyecto, CAST(CASE WHEN FechaInicio IS NULL THEN 0 WHEN datediff('day', DATE '1996-01-01', "
        "FechaInicio) + 1 BETWEEN 1 AND 1500 THEN datediff('day', DATE '1996-01-01', FechaInicio) + 1 ELSE 1 END "
        "AS INTEGER) AS key_start, CAST(CASE WHEN COALESCE(FechaFinReal, FechaFin) IS NULL THEN 0 "
        "WHEN datediff('day', DATE '1996-01-01', COALESCE(FechaFinReal, FechaFin)) + 1 BETWEEN 1 AND 1500 "
        "THEN datediff('day', DATE '1996-01-01', COALESCE(FechaFinReal, FechaFin)) + 1 ELSE 1 END AS INTEGER) "
        "AS key_end FROM x_proyectos"),
    "delay_days": q(
        "SELECT ID_Tarea, CAST(COALESCE(greatest(datediff('day', FechaFinPlanificada, FechaFinReal), 0), 0) AS INTEGER) "
        "AS end_delay, CAST(COALESCE(greatest(datediff('day', FechaInicioPlanificada, FechaInicioReal), 0), 0) "
        "AS INTEGER) AS start_delay FROM x_tareas"),
    "changed_flag": q(
        "SELECT ID_Tarea, CAST(FechaInicioReal IS NOT NULL AND NOT (FechaInicioPlanificada IS NOT DISTINCT FROM "
        "FechaInicioReal) AS INTEGER) AS start_changed, CAST(FechaFinReal IS NOT NULL AND NOT (FechaFinPlanificada "
        "IS NOT DISTINCT FROM FechaFinReal) AS INTEGER) AS end_changed FROM x_tareas"),
    "bin_right_closed": q("SELECT ID_Proyecto, Estado, CategoriaPresupuesto, TipoDesviacion, CategoriaProductividad, "
                          "CategoriaCalidad FROM olap"),
    "quarter_label": q("SELECT ID_Proyecto, AnioInicio, MesInicio, PeriodoInicio FROM olap"),
    "calendar_days": q("SELECT * FROM dim_tiempo"),
    "union_tagged": q("SELECT ID_Gasto AS line_id, TipoGasto, Categoria, Monto, 'gastos' AS fuente FROM x_gastos "
                      "UNION ALL SELECT ID_Penalizacion, 'Penalizaciones', 'OPEX', Monto, 'penalizaciones' "
                      "FROM x_penalizaciones"),
    "dim_clients": q("SELECT * FROM dim_clientes"),
    "dim_employees": q("SELECT * FROM dim_empleados"),
    "dim_projects": q("SELECT * FROM dim_proyectos"),
    "dim_expenses": q("SELECT * FROM dim_gastos"),
    "dim_milestones": q("SELECT * FROM dim_hitos"),
    "dim_tasks": q("SELECT * FROM dim_tareas"),
    "dim_tests": q("SELECT * FROM dim_pruebas"),
    "fact_assignments": q("SELECT * FROM hechos_asignaciones"),
    "fact_projects": q("SELECT * FROM hechos_proyectos"),
    "view_projects": q("SELECT * FROM v_proyectos"),
    "view_assignments": q("SELECT * FROM v_asignaciones"),
    "view_milestone_tasks": q("SELECT * FROM v_hitos_tareas"),
    "olap_dataset": q("SELECT * FROM olap"),
    "cube_base": _group("olap", KPI_DIMS),
    "cube_slice": _group("(SELECT * FROM olap WHERE Estado = 'Cerrado')", [d for d in KPI_DIMS if d != "Estado"]),
    "cube_slice_total": _group("(SELECT * FROM olap WHERE Estado = 'Cerrado')", [],
                               ["Presupuesto", "ProductividadPromedio"]),
    "cube_dice": _group("(SELECT * FROM olap WHERE Estado = 'Cerrado' AND CategoriaPresupuesto IN ('Grande', 'Mega'))",
                        [d for d in KPI_DIMS if d not in ("Estado", "CategoriaPresupuesto")]),
    "cube_rollup": _group(
        "(SELECT *, 'Nivel_1_PeriodoInicio' AS nivel, CAST(PeriodoInicio AS VARCHAR) AS PeriodoInicio_nivel FROM olap "
        "UNION ALL SELECT *, 'Nivel_2_AnioInicio', CAST(AnioInicio AS VARCHAR) FROM olap "
        "UNION ALL SELECT *, 'Nivel_3_TOTAL', 'TOTAL' FROM olap)",
        ["nivel", "Estado", "CategoriaPresupuesto", "CategoriaProductividad", "CategoriaCalidad", "AnioInicio",
         "PeriodoInicio_nivel"]),
    "cube_drilldown": _group("(SELECT * FROM olap WHERE Estado = 'Cerrado')",
                             [d for d in KPI_DIMS if d != "Estado"] + ["MesInicio"]),
    "cube_pivot": _crosstab("SELECT * FROM olap", ["Estado"], ["CategoriaPresupuesto"], {"Presupuesto": "mean"},
                            fill=0, label="TOTAL"),
    "cube_info": q("SELECT COUNT(*) AS num_registros, " + ", ".join(
        f"COUNT(DISTINCT {d}) AS distintos_{d}" for d in KPI_DIMS) + " FROM olap"),
    "crosstab_margins": _crosstab("SELECT * FROM olap", ["Estado", "TipoDesviacion"], ["CategoriaCalidad"],
                                  {"Presupuesto": "sum", "ProductividadPromedio": "mean", "ID_Proyecto": "count"}),
    "crosstab_dense": _with(
        "__src AS (SELECT * FROM olap), __ct AS (" + crosstab_sql("__src", ["CategoriaPresupuesto"],
                                                                 ["CategoriaProductividad"],
                                                                 {"ID_Proyecto": "count", "Presupuesto": "sum"},
                                                                 0, "TOTAL") + ")",
        "SELECT s.CategoriaPresupuesto, s.CategoriaProductividad, 0 AS grouping_id, "
        "CAST(COALESCE(c.ID_Proyecto, 0) AS BIGINT) AS ID_Proyecto, CAST(COALESCE(c.Presupuesto, 0) AS DOUBLE) AS Presupuesto "
        "FROM (SELECT * FROM (VALUES ('Pequeño'), ('Mediano'), ('Grande'), ('Mega')) a(CategoriaPresupuesto) "
        "CROSS JOIN (VALUES ('Baja'), ('Media'), ('Alta'), ('Muy Alta')) b(CategoriaProductividad)) s "
        "LEFT JOIN (SELECT * FROM __ct WHERE grouping_id = 0) c ON s.CategoriaPresupuesto = c.CategoriaPresupuesto "
        "AND s.CategoriaProductividad = c.CategoriaProductividad "
        "UNION ALL SELECT * FROM __ct WHERE grouping_id <> 0"),
    "cube_preview": q("SELECT * FROM (" + _group_select("olap", KPI_DIMS) + ") ORDER BY "
                      + ", ".join(f"{d} NULLS FIRST" for d in KPI_DIMS) + " LIMIT 20"),
    "cubes_p1": _crosstab("SELECT * FROM olap", ["CodigoClienteReal", "Estado"], ["PeriodoInicio"],
                          {"Presupuesto": "sum", "CosteReal": "sum", "ProductividadPromedio": "mean"}, label="TOTAL"),
    "cubes_p2": _crosstab("SELECT * FROM olap", ["CategoriaProductividad", "CategoriaCalidad"], ["Estado"],
                          {"ID_Proyecto": "count", "Presupuesto": "mean", "DesviacionPresupuestal": "mean"}, fill=0),
    "cubes_p3": _crosstab("SELECT * FROM olap", ["CategoriaPresupuesto", "TipoDesviacion"], ["CodigoClienteReal"],
                          {"ID_Proyecto": "count", "Presupuesto": "sum", "CosteReal": "sum",
                           "DesviacionPresupuestal": "sum"}, fill=0),
    "cubes_p4": _crosstab("SELECT * FROM olap", ["AnioInicio", "Estado"], ["CategoriaCalidad"],
                          {"ID_Proyecto": "count", "TasaDeExitoEnPruebas": "mean", "ProductividadPromedio": "mean"},
                          fill=0),
    "cubes_p5": _crosstab("SELECT * FROM olap", ["CodigoClienteReal"], ["Estado"],
                          {"Presupuesto": "sum", "CosteReal": "sum", "DesviacionPresupuestal": "sum",
                           "ProductividadPromedio": "mean", "TasaDeExitoEnPruebas": "mean",
                           "PorcentajeTareasRetrasadas": "mean", "PorcentajeHitosRetrasados": "mean"}),
    "cubes_p6": _crosstab(
        "SELECT *, " + _safe("Presupuesto - CosteReal", "Presupuesto") + " * 100 AS ROI, "
        + _safe("Presupuesto", "CosteReal") + " AS EficienciaPresupuestal, "
        "TasaDeExitoEnPruebas * CAST(0.4 AS DOUBLE) + (100.0 - PorcentajeTareasRetrasadas) / 100 * CAST(0.6 AS DOUBLE) "
        "AS IndicadorCalidad FROM olap", ["CodigoClienteReal"], ["PeriodoInicio"],
        {"ID_Proyecto": "count", "Presupuesto": "sum", "CosteReal": "sum", "ROI": "mean",
         "EficienciaPresupuestal": "mean", "IndicadorCalidad": "mean", "ProductividadPromedio": "mean"}),
    "cubes_p7": _crosstab("SELECT * FROM olap", ["Estado"], ["CategoriaPresupuesto"],
                          {"Presupuesto": "sum", "TasaDeExitoEnPruebas": "mean", "ID_Proyecto": "count",
                           "NumTrabajadores": "sum"}, fill=0),
    "cubes_p8": _crosstab(KPI_MEASURES_SRC, ["CodigoClienteReal", "AnioInicio"], ["Estado"],
                          {"cumplimiento_presupuesto": "mean", "desviacion_presupuestal": "mean",
                           "penalizaciones_pct": "mean", "proyecto_a_tiempo": "mean", "proyecto_cancelado": "mean",
                           "PorcentajeTareasRetrasadas": "mean", "PorcentajeHitosRetrasados": "mean",
                           "TasaDeErroresEncontrados": "mean", "ProductividadPromedio": "mean",
                           "TasaDeExitoEnPruebas": "mean100"}, label="PROMEDIO"),
    "cubes_p9": _crosstab(KPI_MEASURES_SRC, ["AnioInicio"], ["MesInicio"],
                          {"cumplimiento_presupuesto": "mean", "proyecto_a_tiempo": "mean",
                           "proyecto_cancelado": "mean", "TasaDeExitoEnPruebas": "mean100",
                           "ProductividadPromedio": "mean", "ID_Proyecto": "count"}, label="PROMEDIO"),
    "cubes_p10": _crosstab(KPI_MEASURES_SRC, ["CategoriaPresupuesto"], ["CategoriaProductividad"],
                           {"cumplimiento_presupuesto": "mean", "proyecto_exitoso": "mean",
                            "TasaDeExitoEnPruebas": "mean100", "ProductividadPromedio": "mean",
                            "PorcentajeTareasRetrasadas": "mean", "ID_Proyecto": "count"}, label="TOTAL"),
    "kpi_table_a": _kpi_table(KPI_A, True),
    "kpi_table_b": _kpi_table(KPI_B, False),
    "kpi_alerts": _alerts(),
    "kpi_by_client": q(BY_CLIENT),
    "kpi_client_badge": q(f"SELECT *, CASE WHEN cumplimiento_presupuesto >= 90.0 THEN 'good' "
                          f"WHEN cumplimiento_presupuesto >= 85.0 THEN 'warning' ELSE 'bad' END AS badge "
                          f"FROM ({BY_CLIENT})"),
    "kpi_stats": q(f"""SELECT COUNT(*) AS proyectos_analizados, COALESCE({_esum('Presupuesto')}, 0.0) AS presupuesto_total,
  COALESCE({_esum('CosteReal')}, 0.0) AS costo_total, COUNT(DISTINCT CodigoClienteReal) AS clientes_activos,
  36 AS dataset_dimensiones, COALESCE({_emean('DesviacionPresupuestal')}, 0.0) AS desviacion_promedio,
  COALESCE({_emean('ProductividadPromedio')}, 0.0) AS productividad_promedio,
  COALESCE({_emean('TasaDeExitoEnPruebas')} * 100, 0.0) AS tasa_exito_pruebas FROM olap"""),
    "kpi_trend_year": q(f"SELECT AnioInicio, round_even({_emean(COMPLIANCE_IND)}, 2) AS cumplimiento_presupuesto, "
                        f"COUNT(*) AS proyectos FROM olap WHERE AnioInicio IS NOT NULL GROUP BY AnioInicio"),
    "hours_ratio": q(HOURS),
    "quality_fk": q(" UNION ALL ".join(
        f"SELECT '{c}' AS child, '{col}' AS \"column\", '{p}' AS parent, CAST(COUNT(*) AS BIGINT) AS orphans "
        f"FROM {c} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)"
        for c, col, p, pk in FKS)),
    "quality_pk": q(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{pk}' AS \"key\", CAST(COUNT(*) AS BIGINT) AS duplicated_keys, "
        f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT {pk}, COUNT(*) AS n FROM {t} "
        f"GROUP BY {pk} HAVING COUNT(*) > 1)" for t, pk in PKS.items())),
    "quality_nulls": q(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", CAST(COALESCE(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) "
        f"AS BIGINT) AS nulls FROM {t}" for t, cols in NOT_NULL.items() for c in cols)),
}

PROJECT_DIMS = ["CodigoClienteReal", "Estado", "AnioInicio", "MesInicio", "CategoriaPresupuesto", "TipoDesviacion",
                "CategoriaProductividad", "CategoriaCalidad", "PeriodoInicio"]
PROJECT_MEAS = ["Presupuesto", "CosteReal", "DesviacionPresupuestal", "ProductividadPromedio", "TasaDeExitoEnPruebas",
                "PorcentajeTareasRetrasadas", "PorcentajeHitosRetrasados"]
ORACLE.update({
    "cube_shape": q(f"SELECT '{', '.join(KPI_DIMS)}' AS dimensiones, '{', '.join(KPI_MEAS)}' AS medidas, "
                    f"(SELECT COUNT(*) FROM ({_group_select('olap', KPI_DIMS)})) AS filas, "
                    f"{len(KPI_DIMS) + 3 * len(KPI_MEAS)} AS columnas"),
    "cube_slice_empty": q("SELECT * FROM (" + _group_select("(SELECT * FROM olap WHERE Estado = 'no such state')", [],
                                                            ["Presupuesto", "ProductividadPromedio"])
                          + ") WHERE Presupuesto_count > 0"),
    "project_cube_base": _group("olap", PROJECT_DIMS, PROJECT_MEAS),
    "alert_total": ORACLE["kpi_alerts"].replace(ALL_CTES + "\n", ALL_CTES
                                                + "\nSELECT COUNT(*) AS total_alertas FROM (") + ")",
})
LABELS = {"CategoriaPresupuesto": ["Pequeño", "Mediano", "Grande", "Mega"],
          "CategoriaProductividad": ["Baja", "Media", "Alta", "Muy Alta"],
          "CategoriaCalidad": ["Baja", "Media", "Alta", "Excelente"],
          "TipoDesviacion": ["Sobre Presupuesto", "Bajo Presupuesto", "En Presupuesto"]}


def _dense(name: str, keys, measures: dict, fill) -> str:
    """The crosstab query ``name`` with every combination of the category labels (and observed other keys)."""
    lists = [f"(SELECT unnest({LABELS[k]!r}) AS {k})" if k in LABELS
             else f"(SELECT DISTINCT {k} FROM __ct WHERE grouping_id = 0)" for k in keys]
    out = []
    for m, kind in measures.items():
        value = fill if fill is not None else (0 if kind in ("sum", "count") else None)
        out.append(f"c.{m} AS {m}" if value is None else f"COALESCE(c.{m}, {value}) AS {m}")
    on = " AND ".join(f"s.{k} = c.{k}" for k in keys)
    return (f"WITH __ct AS ({ORACLE[name]})\nSELECT {', '.join('s.' + k for k in keys)}, 0 AS grouping_id, "
            f"{', '.join(out)} FROM (SELECT * FROM {' CROSS JOIN '.join(lists)}) s LEFT JOIN "
            f"(SELECT * FROM __ct WHERE grouping_id = 0) c ON {on} "
            f"UNION ALL SELECT {', '.join(keys)}, grouping_id, {', '.join(measures)} FROM __ct WHERE grouping_id <> 0")


BUILT = {"dim_clientes": "x_clientes", "dim_empleados": "x_empleados", "dim_proyectos": "x_proyectos",
         "dim_hitos": "x_hitos", "dim_tareas": "x_tareas", "dim_pruebas": "x_pruebas",
         "hechos_asignaciones": "x_asignaciones", "hechos_proyectos": "x_proyectos"}
ORACLE.update({
    "lookup_last_duplicates": q("""SELECT e.ID_Empleado, e.NombreCompleto, a.HorasReales FROM s_empleados e LEFT JOIN (
  SELECT * FROM s_asignaciones QUALIFY row_number() OVER (
    PARTITION BY ID_Empleado ORDER BY FechaAsignacion DESC, ID_Asignacion DESC) = 1) a USING (ID_Empleado)"""),
    "coerce_dates": q("""SELECT ID_Proyecto, CASE WHEN ID_Proyecto % 7 <> 0 AND ID_Proyecto % 11 <> 0
  THEN FechaInicio END AS fecha FROM s_proyectos"""),
    "conform_rules": q("""SELECT ID_Proyecto, CodigoProyecto, CAST(NULL AS VARCHAR) AS Version,
  CAST(CASE WHEN ID_Proyecto % 2 = 0 THEN coalesce(Cancelado, 0) ELSE 0 END AS INTEGER) AS Cancelado, ID_Cliente,
  TotalErrores, NumTrabajadores FROM dim_proyectos"""),
    "cube_pivot_dense": _dense("cube_pivot", ["Estado", "CategoriaPresupuesto"], {"Presupuesto": "mean"}, 0),
    "cubes_p2_dense": _dense("cubes_p2", ["CategoriaProductividad", "CategoriaCalidad", "Estado"], {
        "ID_Proyecto": "count", "Presupuesto": "mean", "DesviacionPresupuestal": "mean"}, 0),
    "cubes_p3_dense": _dense("cubes_p3", ["CategoriaPresupuesto", "TipoDesviacion", "CodigoClienteReal"], {
        "ID_Proyecto": "count", "Presupuesto": "sum", "CosteReal": "sum", "DesviacionPresupuestal": "sum"}, 0),
    "cubes_p10_dense": _dense("cubes_p10", ["CategoriaPresupuesto", "CategoriaProductividad"], {
        "cumplimiento_presupuesto": "mean", "proyecto_exitoso": "mean", "TasaDeExitoEnPruebas": "mean100",
        "ProductividadPromedio": "mean", "PorcentajeTareasRetrasadas": "mean", "ID_Proyecto": "count"}, None),
    "build_audit": q(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", (SELECT COUNT(*) FROM {x}) AS rows_in, (SELECT COUNT(*) FROM {t}) AS rows_out"
        for t, x in BUILT.items())),
})
# Every extract carries its time
for _name in [n for n in ORACLE if n.startswith("extract_") or n == "incremental_filter"]:
    ORACLE[_name] = ORACLE[_name].replace(
        ALL_CTES + "\n", ALL_CTES + "\nSELECT *, '2024-01-01 00:00:00' AS fecha_extraccion FROM (") + ")"

# a session's answers are those from the dataset
for _name in ("slice", "dice", "rollup", "drilldown", "pivot", "info", "shape"):
    ORACLE[f"cube_session_{_name}"] = ORACLE[f"cube_{_name}"]
ORACLE["cube_session_projects"] = ORACLE["project_cube_base"]
ORACLE["cube_sizes"] = q(" UNION ALL ".join(
    f"SELECT '{name}' AS cubo, COUNT(*) AS registros, {len(dims) + len(meas)} AS columnas, COUNT(*) > 0 AS activo FROM olap"
    for name, dims, meas in (("cubo_proyectos", PROJECT_DIMS, PROJECT_MEAS), ("cubo_kpis", KPI_DIMS, KPI_MEAS))))
ORACLE["distinct_sketch"] = q("SELECT Estado, AnioInicio, COUNT(DISTINCT CodigoClienteReal) AS distintos, TRUE AS en_margen "
                              "FROM olap WHERE Estado IS NOT NULL AND AnioInicio IS NOT NULL GROUP BY Estado, AnioInicio")

# constraints at load time: what is planted, and what falls with it
_CHECKED = """
c_cl AS (SELECT COUNT(*) AS n FROM dim_clientes WHERE ID_Cliente % 53 = 1),
c_hit AS (SELECT *, ID_proyectos % 307 = 1 AS bad FROM dim_hitos),
c_tar AS (SELECT t.*, h.bad AS orphan, ends_with(CodigoTarea, '77') AS nameless FROM dim_tareas t JOIN c_hit h USING (ID_Hito)),
c_pru AS (SELECT p.*, h.bad AS orphan FROM dim_pruebas p JOIN c_hit h USING (ID_Hito)),
c_asg AS (SELECT *, ID_Empleado % 41 = 2 AS bad FROM hechos_asignaciones),
c_all AS (
  SELECT 'dim_clientes' AS "table", 'duplicate ID_Cliente' AS reason, n AS "rows" FROM c_cl
  UNION ALL SELECT 'dim_hitos', 'orphan ID_proyectos -> dim_proyectos', COUNT(*) FROM c_hit WHERE bad
  UNION ALL SELECT 'dim_tareas', 'null CodigoTarea', COUNT(*) FROM c_tar WHERE nameless
  UNION ALL SELECT 'dim_tareas', 'orphan ID_Hito -> dim_hitos', COUNT(*) FROM c_tar WHERE orphan
  UNION ALL SELECT 'dim_pruebas', 'orphan ID_Hito -> dim_hitos', COUNT(*) FROM c_pru WHERE orphan
  UNION ALL SELECT 'hechos_asignaciones', 'orphan ID_Proyecto -> dim_proyectos', COUNT(*) FROM c_asg WHERE bad),
c_rej AS (
  SELECT "table", "rows" AS n FROM c_all WHERE "table" <> 'dim_tareas'
  UNION ALL SELECT 'dim_tareas', COUNT(*) FROM c_tar WHERE nameless OR orphan),
c_tot AS (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*){' + (SELECT n FROM c_cl)' if t == 'dim_clientes' else ''} AS n FROM {t}" for t in (
        "dim_clientes", "dim_empleados", "dim_proyectos", "dim_tiempo", "dim_gastos", "dim_hitos", "dim_tareas",
        "dim_pruebas", "hechos_asignaciones", "hechos_proyectos")) + ")"
ORACLE["checked_load"] = _with(_CHECKED, """
SELECT "table", CAST(c_tot.n - COALESCE(c_rej.n, 0) AS BIGINT) AS rows_loaded, CAST(COALESCE(c_rej.n, 0) AS BIGINT) AS rows_rejected
FROM c_tot LEFT JOIN c_rej USING ("table")""")
ORACLE["checked_quarantine"] = _with(_CHECKED, 'SELECT * FROM c_all WHERE "rows" > 0')
ORACLE["checked_audit"] = "SELECT unnest(['orphans', 'duplicates', 'nulls']) AS fault, 0::BIGINT AS n"

# sources, sinks and the watermark
ORACLE["load_counts"] = q(" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows_loaded, COUNT(*) AS rows_stored, '2024-01-01 00:00:00' AS watermark, "
    f"{f'(SELECT COUNT(*) FROM {x})' if x else 'NULL::BIGINT'} AS rows_in FROM {'x_gastos' if t == 'dim_gastos' else t}"
    for t, x in (("dim_clientes", "x_clientes"), ("dim_empleados", "x_empleados"), ("dim_proyectos", "x_proyectos"),
                 ("dim_tiempo", None), ("dim_gastos", "x_gastos"), ("dim_hitos", "x_hitos"), ("dim_tareas", "x_tareas"),
                 ("dim_pruebas", "x_pruebas"), ("hechos_asignaciones", "x_asignaciones"), ("hechos_proyectos", "x_proyectos"))))
ORACLE["append_load"] = q('SELECT ID_Cliente, CAST(1 + (ID_Cliente % 2 = 0)::INT AS BIGINT) AS "rows" FROM dim_clientes')
ORACLE["watermark_moves"] = _with("""
m_months AS (SELECT DISTINCT date_trunc('month', FechaAsignacion) AS m FROM s_asignaciones WHERE FechaAsignacion IS NOT NULL),
m_moves AS (SELECT strftime(m, '%Y-%m-%d 00:00:00') AS new_date, row_number() OVER (ORDER BY m) AS seq FROM m_months
            UNION ALL SELECT '1900-01-01 00:00:00', COUNT(*) + 1 FROM m_months)""", """
SELECT seq, COALESCE(lag(new_date) OVER (ORDER BY seq), '1900-01-01 00:00:00') AS previous_date, new_date
FROM m_moves QUALIFY seq > MAX(seq) OVER () - 10""")
ORACLE["ordered_files"] = q("SELECT * FROM x_asignaciones WHERE ID_Proyecto = "
                            "(SELECT quantile_disc(ID_Proyecto, 0.5) FROM x_asignaciones)")
