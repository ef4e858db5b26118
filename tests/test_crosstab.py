"""Differential test of the long-form pivot with margins against pandas.pivot_table."""

import math

import numpy as np
import pandas as pd
import pytest

from portacube.operators.crosstab import crosstab, to_wide


def _random_frame(seed, n=300):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({
        "r1": rng.choice(["a", "b", "c", None], n, p=[.4, .3, .25, .05]),
        "r2": rng.choice(["u", "v"], n),
        "c": rng.choice(["x", "y", "z", None], n, p=[.4, .3, .25, .05]),
        "m": rng.normal(100, 30, n).round(2),
        "k": rng.integers(0, 50, n).astype(float),
    })
    df.loc[rng.random(n) < .15, "m"] = np.nan
    df.loc[rng.random(n) < .1, "k"] = np.nan
    # a whole cell without values of m
    df.loc[(df.r1 == "c") & (df.r2 == "v") & (df.c == "z"), "m"] = np.nan
    return df


def _pandas_long(pdf, rows, cols, aggs, label):
    t = pd.pivot_table(pdf, values=list(aggs), index=rows, columns=cols, aggfunc=aggs, margins=True,
                       margins_name=label)
    out = {}
    for idx, row in t.iterrows():
        idx = idx if isinstance(idx, tuple) else (idx,)
        if idx[0] == label:  # pandas labels a multi-level margin row (label, '', ...)
            idx = tuple(label for _ in idx)
        for (measure, colv), v in row.items():
            if not (isinstance(v, float) and math.isnan(v)):
                out[(tuple(str(i) for i in idx), str(colv), measure)] = float(v)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_crosstab_matches_pandas(spark, seed):
    pdf = _random_frame(seed)
    aggs = {"m": "sum", "k": "mean"}
    expected = _pandas_long(pdf, ["r1", "r2"], ["c"], aggs, "All")
    sdf = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                "r1 string, r2 string, c string, m double, k double")
    got = {}
    for r in crosstab(sdf, ["r1", "r2"], ["c"], aggs, margins_name="All").collect():
        for meas in aggs:
            if r[meas] is not None:
                got[((r.r1, r.r2), r.c, meas)] = r[meas]
    assert set(got) == set(expected)
    for key, v in expected.items():
        assert got[key] == pytest.approx(v, rel=1e-9, abs=1e-9), key


def test_margin_grand_total_equals_cells_without_missing(spark):
    pdf = _random_frame(7).dropna()
    sdf = spark.createDataFrame(pdf, "r1 string, r2 string, c string, m double, k double")
    rows = crosstab(sdf, ["r1"], ["c"], {"m": "sum"}).collect()
    cells = sum(r.m for r in rows if r.grouping_id == 0)
    grand = [r.m for r in rows if r.grouping_id == 3][0]
    assert grand == pytest.approx(cells)


def test_fill_and_wide(spark):
    sdf = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "x", 3.0)], "r string, c string, m double")
    long = crosstab(sdf, ["r"], ["c"], {"m": "mean"}, fill_value=0, margins_name="TOTAL")
    got = {(r.r, r.c): r.m for r in long.collect()}
    # the (a, y) cell has no value at all: dropped in long form (the wide view shows it empty)
    assert ("a", "y") not in got and got[("TOTAL", "TOTAL")] == 2.0 and got[("a", "TOTAL")] == 1.0
    wide = {r.r: r.asDict() for r in to_wide(long, ["r"], "c", ["m"], values=["x", "y", "TOTAL"]).collect()}
    assert wide["b"]["m__x"] == 3.0 and wide["b"]["m__y"] is None


def test_wide_with_several_measures_and_underscored_values(spark):
    sdf = spark.createDataFrame([("a", "x_1", 1.0, 5.0), ("a", "y", 2.0, 6.0), ("b", "x_1", 3.0, 7.0)],
                                "r string, c string, m double, k_n double")
    long = crosstab(sdf, ["r"], ["c"], {"m": "sum", "k_n": "mean"}, margins_name="All")
    wide = {r.r: r.asDict() for r in to_wide(long, ["r"], "c", ["m", "k_n"], values=["x_1", "y", "All"]).collect()}
    assert wide["a"]["m__x_1"] == 1.0 and wide["a"]["k_n__y"] == 6.0 and wide["All"]["m__All"] == 6.0


def test_densify_with_one_observed_key(spark):
    from portacube.operators.crosstab import densify
    sdf = spark.createDataFrame([("Cerrado", "Baja", 1.0), ("Cancelado", "Alta", 2.0)], "e string, q string, m double")
    meas = {"m": "sum"}
    long = crosstab(sdf, ["e"], ["q"], meas, fill_value=0)
    dense = densify(long, ["e"], ["q"], {"q": ["Baja", "Media", "Alta"]}, meas)
    cells = {(r.e, r.q): r.m for r in dense.collect() if r.grouping_id == 0}
    assert len(cells) == 6 and cells[("Cerrado", "Media")] == 0.0 and cells[("Cancelado", "Alta")] == 2.0
    assert dense.where("grouping_id = 3").collect()[0].m == 3.0
