"""Hand-made operational tables covering the edge cases of the transform rules."""

from datetime import date as d
from decimal import Decimal as D

from portacube.schemas import SOURCE_SCHEMAS


def sources(spark):
    rows = {
        "clientes": [(1, "C1"), (2, "C2"), (3, "C3")],
        "contratos": [(10, 1, 100, D("1000.00"), "Activo"), (11, 1, 100, D("500.00"), "Activo"),
                      (12, 2, 200, D("0.00"), "Activo"), (13, 3, 300, D("800.00"), "Activo")],
        "proyectos": [
            (100, "P100", None, d(2020, 1, 1), d(2020, 3, 1), d(2020, 1, 5), d(2020, 3, 11), "Cerrado", "A"),
            (200, "P200", " 2 ", d(2020, 2, 1), d(2020, 4, 1), None, None, "Cancelado", "B"),
            (300, "P300", "1", d(2020, 1, 1), d(2020, 2, 1), None, None, "En Curso", "A"),
            (400, "P400", "1", d(2020, 1, 1), d(2020, 2, 1), None, None, "Cerrado", "A")],
        "empleados": [(1000, "E1", " Dev ", None, D("50.00")), (1001, "E2", "QA", "Senior", D("40.00"))],
        "asignaciones": [(1, 100, 1000, 10, 12, d(2020, 1, 10)), (2, 100, 1001, 5, 5, d(2020, 1, 11)),
                         (3, 300, 1000, 8, 8, d(2020, 1, 12)), (4, 200, 1001, 4, None, d(2020, 2, 2))],
        "hitos": [(500, 100, "H1", "x", d(2020, 1, 1), d(2020, 2, 1), d(2020, 2, 5)),
                  (501, 100, "H2", "x", d(2020, 2, 1), d(2020, 3, 1), None),
                  (502, 300, "H3", "x", d(2020, 1, 1), d(2020, 2, 1), d(2020, 2, 9)),
                  (504, 400, "H4", "x", d(2020, 1, 1), d(2020, 2, 1), d(2020, 2, 1))],
        "tareas": [(600, 500, "T", None, "x", d(2020, 1, 1), d(2020, 1, 1), d(2020, 1, 15), d(2020, 1, 10)),
                   (601, 500, "T", None, "x", None, d(2020, 1, 2), d(2020, 1, 20), d(2020, 1, 20)),
                   (602, 501, "T", None, "x", d(2020, 2, 1), d(2020, 2, 1), d(2020, 2, 20), None),
                   (603, 504, "T", None, "x", d(2020, 1, 1), d(2020, 1, 1), d(2020, 1, 5), d(2020, 1, 5))],
        "pruebas": [(700, 500, " Unit ", d(2020, 1, 3), 1), (701, 500, "Int", d(2020, 1, 4), None),
                    (702, 501, "Sys", d(2020, 2, 3), 0)],
        "errores": [(800, 600, "e", None, "f", d(2020, 1, 5), None), (801, 600, "e", None, "f", d(2020, 1, 6), None),
                    (802, 602, "e", None, "f", d(2020, 2, 6), None)],
        "gastos": [(900, 100, "Mat", "capex", D("100.00"), d(2020, 1, 2)),
                   (901, 100, "Srv", "OPEX", D("50.00"), d(2020, 1, 3)),
                   (902, 200, "Srv", "CAPEX", D("30.00"), d(2020, 2, 3))],
        "penalizaciones_contrato": [(950, 10, D("20.00"), "m", d(2020, 3, 1)), (951, 11, D("7.00"), "m", d(2020, 3, 2))],
    }
    def typed(row, schema):
        # keys that the schema declares as text
        return tuple(str(x) if isinstance(x, int) and f.dataType.typeName() == "string" else x
                     for x, f in zip(row, schema.fields))
    return {k: spark.createDataFrame([typed(r, SOURCE_SCHEMAS[k]) for r in v], SOURCE_SCHEMAS[k])
            for k, v in rows.items()}
