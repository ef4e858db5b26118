"""Registered queries vs their DuckDB oracles on sf0.001 (all of the library's own; those of the training-data subpackage are tested there)."""

import os

import pytest

SF = "/root/testdata/sf0.001"


def _names():
    import __spark_entry__ as E
    return list(E._own_queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    import oracle_check
    res = oracle_check.check(spark, SF, [name], verbose=False)[name]
    assert res[0] == "ok", res


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["CodigoClienteReal", "cumplimiento_presupuesto", "desviacion_presupuestal",
                          "proyectos_a_tiempo", "total_proyectos", "presupuesto_total"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
