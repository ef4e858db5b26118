"""A project holding most of the rows: results stay exact (map-side combined aggregates)."""

from datetime import date, timedelta

from fixtures import sources

from portacube.plans.extract import extract_all
from portacube.plans.pipeline import build_warehouse
from portacube.schemas import SOURCE_SCHEMAS


def test_hot_project(spark):
    src = sources(spark)
    n = 3000
    extra_assign = [(10_000 + i, 100, 1000 + i % 2, 8, 9, date(2020, 1, 1) + timedelta(days=i % 40)) for i in range(n)]
    extra_tasks = [(20_000 + i, 500, "T", None, "x", date(2020, 1, 1), date(2020, 1, 1), date(2020, 1, 15),
                    date(2020, 1, 15) if i % 3 else date(2020, 1, 20)) for i in range(n)]
    src["asignaciones"] = src["asignaciones"].unionByName(
        spark.createDataFrame(extra_assign, SOURCE_SCHEMAS["asignaciones"])).repartition(8)
    src["tareas"] = src["tareas"].unionByName(
        spark.createDataFrame(extra_tasks, SOURCE_SCHEMAS["tareas"])).repartition(8)
    w = build_warehouse(extract_all(src, as_of="2021-01-01", extracted_at="2021-01-01 00:00:00"),
                        extend_calendar=False)
    f = {r.ID_Proyecto: r for r in w["hechos_proyectos"].collect()}[100]
    # base fixture: hours 12 + 5, labour 600 + 200; extra: 3000 x 9 hours at 50/40 per hour
    hours = 17 + n * 9
    labour = 800 + sum(9 * (50 if i % 2 == 0 else 40) for i in range(n))
    assert f.ProductividadPromedio == hours / 2
    assert f.CosteReal == 150 + labour
    # tasks: 3 base (2 late) + 3000 extra, late when the real end differs (i % 3 == 0)
    late = 2 + sum(1 for i in range(n) if i % 3 == 0)
    assert f.PorcentajeTareasRetrasadas == late / (3 + n) * 100
    assert f.TasaDeErroresEncontrados == 3 / (3 + n)
    ids = sorted(r.ID_HechoAsignacion for r in w["hechos_asignaciones"].collect())
    assert ids == list(range(1, n + 4))
