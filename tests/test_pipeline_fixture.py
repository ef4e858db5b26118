"""Golden micro-fixture: every builder rule checked against hand-computed values."""

import pytest
from fixtures import sources

from portacube.plans.extract import extract_all
from portacube.plans.pipeline import build_warehouse
from portacube.plans.views import olap_dataset, vista_hitos_tareas, vista_proyectos_completa


@pytest.fixture(scope="module")
def wh(spark):
    ext = extract_all(sources(spark), as_of="2021-01-01", extracted_at="2021-01-01 00:00:00")
    return ext, build_warehouse(ext, extend_calendar=False)


def _rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_cascade_drops_open_projects(wh):
    ext, _ = wh
    assert sorted(r.ID_Proyecto for r in ext["proyectos"].collect()) == [100, 100, 200, 400]
    assert sorted(r.ID_Cliente for r in ext["clientes"].collect()) == [1, 2]
    assert sorted(r.ID_Hito for r in ext["hitos"].collect()) == ["500", "501", "504"]
    assert sorted(r.ID_Asignacion for r in ext["asignaciones"].collect()) == ["1", "2", "4"]
    assert sorted(r.ID_Penalizacion for r in ext["penalizaciones"].collect()) == ["950", "951"]
    h = _rows(ext["hitos"], "ID_Hito")
    assert h["501"]["dias_retraso"] == (366 - 31 - 29) + 0  # 2021-01-01 minus 2020-03-01 (leap year)


def test_dim_projects(wh):
    _, w = wh
    p = _rows(w["dim_proyectos"], "ID_Proyecto")
    assert set(p) == {100, 200}  # 400 has no contract/client -> dropped
    assert p[100] == {"ID_Proyecto": 100, "CodigoProyecto": 100, "Version": "1.0", "Cancelado": 0,
                      "ID_Cliente": 1, "TotalErrores": 3, "NumTrabajadores": 2}
    assert p[200]["Cancelado"] == 1 and p[200]["Version"] == "2" and p[200]["TotalErrores"] == 0


def test_dim_employees_defaults(wh):
    _, w = wh
    e = _rows(w["dim_empleados"], "ID_Empleado")
    assert e[1000]["Rol"] == "Dev" and e[1000]["Seniority"] == "No especificado"


def test_milestones_tasks_tests(wh):
    _, w = wh
    h = _rows(w["dim_hitos"], "ID_Hito")
    assert set(h) == {"500", "501"}  # 504 belongs to a project outside the dimension
    assert h["500"]["RetrasoFinDias"] == 4 and h["501"]["RetrasoFinDias"] == 0 and h["501"]["ID_FechaFin"] is None
    assert h["500"]["RetrasoInicioDias"] == 0
    t = _rows(w["dim_tareas"], "ID_Tarea")
    assert t == {k: {"ID_Tarea": k, "CodigoTarea": k, "ID_Hito": h, "SeRetraso": late}
                 for k, h, late in (("600", "500", 1), ("601", "500", 1), ("602", "501", 0))}
    p = _rows(w["dim_pruebas"], "ID_Prueba")
    assert p["700"]["TipoPrueba"] == "Unit" and p["701"]["PruebaExitosa"] == 0


def test_calendar_dense(wh):
    _, w = wh
    cal = sorted((r.ID_Tiempo, r.Fecha) for r in w["dim_tiempo"].collect())
    assert [i for i, _ in cal] == list(range(1, len(cal) + 1))
    assert all((b[1] - a[1]).days == 1 for a, b in zip(cal, cal[1:]))


def test_expense_dimension(wh):
    _, w = wh
    g = sorted((r.ID_Finanza, r.TipoGasto, r.Categoria, float(r.Monto)) for r in w["dim_gastos"].collect())
    assert g == [(1, "Mat", "capex", 100.0), (2, "Srv", "OPEX", 50.0), (3, "Srv", "CAPEX", 30.0),
                 (4, "Penalizaciones", "OPEX", 20.0), (5, "Penalizaciones", "OPEX", 7.0)]


def test_fact_assignments(wh):
    _, w = wh
    a = sorted((r.ID_HechoAsignacion, r.ID_Proyecto, r.HorasReales, float(r.ValorHoras), r.RetrasoHoras)
               for r in w["hechos_asignaciones"].collect())
    assert a == [(1, 100, 12, 600.0, 2), (2, 100, 5, 200.0, 0), (3, 200, 0, 0.0, -4)]


def test_fact_projects(wh):
    _, w = wh
    f = _rows(w["hechos_proyectos"], "ID_Proyecto")
    p = f[100]
    assert p["ID_Hecho"] == 1 and f[200]["ID_Hecho"] == 2
    assert (p["RetrasoInicioDias"], p["RetrasoFinalDias"]) == (4, 10)
    assert p["Presupuesto"] == 1000.0 and p["CosteReal"] == 950.0 and p["DesviacionPresupuestal"] == 50.0
    assert p["PenalizacionesMonto"] == 20.0  # only the first contract's penalties
    assert p["ProporcionCAPEX_OPEX"] == 2.0  # lower-case capex counted
    assert p["TasaDeErroresEncontrados"] == 1.0
    assert p["TasaDeExitoEnPruebas"] == pytest.approx(1 / 3)
    assert p["ProductividadPromedio"] == 8.5
    assert p["PorcentajeTareasRetrasadas"] == pytest.approx(200 / 3)
    assert p["PorcentajeHitosRetrasados"] == 50.0
    assert p["ID_Gasto"] == 1
    q = f[200]
    assert q["Presupuesto"] == 0.0 and q["CosteReal"] == 30.0 and q["DesviacionPresupuestal"] == -30.0
    assert q["ProporcionCAPEX_OPEX"] == 0.0 and q["TasaDeExitoEnPruebas"] == 0.0
    assert q["ProductividadPromedio"] == 0.0 and (q["RetrasoInicioDias"], q["RetrasoFinalDias"]) == (0, 0)
    cal = {r.Fecha: r.ID_Tiempo for r in w["dim_tiempo"].collect()}
    from datetime import date
    assert q["ID_FechaFin"] == cal[date(2020, 4, 1)]  # planned end used when the real end is missing


def test_views_and_dataset(wh):
    _, w = wh
    v = _rows(olap_dataset(vista_proyectos_completa(w)), "ID_Proyecto")
    assert v[100]["Estado"] == "Cerrado" and v[200]["Estado"] == "Cancelado"
    assert v[100]["CategoriaPresupuesto"] == "Pequeño" and v[200]["CategoriaPresupuesto"] is None  # 0 -> no bin
    assert v[100]["TipoDesviacion"] == "Bajo Presupuesto" and v[200]["TipoDesviacion"] == "Sobre Presupuesto"
    assert v[100]["CategoriaCalidad"] == "Baja" and v[200]["CategoriaCalidad"] is None
    assert v[100]["PeriodoInicio"] == "2020-Q1" and v[100]["CodigoClienteReal"] == 1
    m = vista_hitos_tareas(w).collect()
    by = {(r.ID_Hito, r.ID_Tarea): (r.TotalPruebas, r.PruebasExitosas) for r in m}
    assert by == {("500", "600"): (2, 1), ("500", "601"): (2, 1), ("501", "602"): (1, 0)}


def test_audits_zero_on_clean_input_and_catch_violations(wh, spark):
    from portacube.plans import quality as Q
    _, w = wh
    assert all(r.orphans == 0 for r in Q.fk_audit(w).collect())
    assert all(r.duplicated_keys == 0 for r in Q.pk_audit(w).collect())
    assert all(r.nulls == 0 for r in Q.null_audit(w).collect())
    bad = dict(w)
    bad["dim_tareas"] = w["dim_tareas"].unionByName(
        spark.createDataFrame([("600", "600", "999", 0)], w["dim_tareas"].schema))
    fk = {(r.child, r.column): r.orphans for r in Q.fk_audit(bad).collect()}
    pk = {r.table: r.duplicated_keys for r in Q.pk_audit(bad).collect()}
    assert fk[("dim_tareas", "ID_Hito")] == 1 and pk["dim_tareas"] == 1


def test_stored_warehouse_reads_stored_extracts(spark, wh, scratch):
    """All tables as built lazily, from stored extracts and dimensions only."""
    from portacube.plans.pipeline import stored_warehouse
    ext, lazy = wh
    stored = stored_warehouse(spark, ext, scratch, extend_calendar=False)
    for name in lazy:
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, lazy[name].collect())), name
    # no local rows of the sources, no second join of milestones and projects
    plan = stored["dim_pruebas"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and plan.count("Relation [") == 2
