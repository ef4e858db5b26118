"""Cube operations against pandas group-by on a small frame."""

import pandas as pd
import pytest

from portacube.operators.cube import Cube


@pytest.fixture(scope="module")
def cube(spark):
    rows = [("A", "x", 2020, 10.0, 1.0), ("A", "y", 2020, 20.0, None), ("B", "x", 2021, 30.0, 3.0),
            ("B", "x", 2021, None, 4.0), (None, "y", 2021, 50.0, 5.0), ("A", "x", 2021, 60.0, 6.0)]
    df = spark.createDataFrame(rows, "d1 string, d2 string, yr int, m double, n double")
    return Cube(df, ["d1", "d2"], ["m", "n"]), pd.DataFrame(rows, columns=["d1", "d2", "yr", "m", "n"])


def _expected(pdf, dims):
    g = pdf.dropna(subset=dims).groupby(dims)[["m", "n"]].agg(["sum", "mean", "count"]).fillna(0)
    return {k if isinstance(k, tuple) else (k,): {f"{m}_{f}": float(v) for (m, f), v in row.items()}
            for k, row in g.iterrows()}


def _got(df, dims):
    return {tuple(r[d] for d in dims): {k: float(v) for k, v in r.asDict().items() if k not in dims}
            for r in df.collect()}


def test_base(cube):
    c, pdf = cube
    assert _got(c.base(), ["d1", "d2"]) == _expected(pdf, ["d1", "d2"])


def test_slice_and_dice(cube):
    c, pdf = cube
    assert _got(c.slice("d1", "A"), ["d2"]) == _expected(pdf[pdf.d1 == "A"], ["d2"])
    assert _got(c.dice({"d1": ["A", "B"], "d2": "x"}), []) != {}
    one = c.dice({"d1": "A", "d2": "x"}).collect()[0]
    assert (one.m_sum, one.m_min, one.m_max, one.n_count) == (70.0, 10.0, 60.0, 2)
    with pytest.raises(ValueError):
        c.slice("nope", 1)


def test_roll_up_levels(cube):
    c, pdf = cube
    levels = c.roll_up_levels("d2", ["d2", "yr", "TOTAL"])
    total = _got(levels["Nivel_3_TOTAL"], ["d1", "d2_nivel"])
    assert total == {(k[0], "TOTAL"): v for k, v in _expected(pdf, ["d1"]).items()}
    by_year = _got(levels["Nivel_2_yr"], ["d1", "d2_nivel"])
    assert by_year == {(k[0], str(k[1])): v for k, v in _expected(pdf, ["d1", "yr"]).items()}


def test_drill_down_and_info(cube):
    c, pdf = cube
    got = _got(c.drill_down("d1", "B", "yr"), ["d2", "yr"])
    assert got == _expected(pdf[pdf.d1 == "B"], ["d2", "yr"])
    info = c.info().collect()[0]
    assert (info.num_registros, info.distintos_d1, info.distintos_d2) == (6, 2, 2)


def test_slice_and_dice_without_a_match_are_empty(spark):
    from portacube.operators.cube import Cube
    c = Cube(spark.createDataFrame([("a", 1.0)], "d string, m double"), ["d"], ["m"])
    assert c.slice("d", "none").count() == 0 and c.dice({"d": ["x", "y"]}).count() == 0
    assert c.slice("d", "a").first()["m_count"] == 1
    shape = c.shape().first()
    assert (shape["dimensiones"], shape["medidas"], shape["filas"], shape["columnas"]) == ("d", "m", 1, 4)
