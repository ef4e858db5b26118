"""Cube sessions over stored cuboids: equal to the cube on the dataset, and answered without it."""

import random

import pytest

from portacube.operators.cube import Cube
from portacube.operators.cuboids import SKETCH_ERROR, open_session


def rows(n, seed=3):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.choice(["x", "y"]), rng.randrange(12),
             rng.choice([None, rng.uniform(-5, 5), 0.1]), rng.choice([None, float(rng.randrange(100))]),
             rng.randrange(4000)) for _ in range(n)]


SCHEMA = "d string, e int, f string, month int, m double, k double, who long"


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("cuboids"))
    spark.createDataFrame(rows(3000), SCHEMA).write.mode("overwrite").parquet(f"{root}/data")
    cube = Cube(spark.read.parquet(f"{root}/data"), ["d", "e", "f"], ["m", "k"])
    return open_session(spark, cube, f"{root}/cuboid", ["month"], ["who"])


def same(a, b):
    assert a.columns == b.columns and a.schema.simpleString() == b.schema.simpleString()
    got = sorted(map(str, a.collect()))
    assert got == sorted(map(str, b.collect()))
    return got


def scanned(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {x for x in ("/data", "/cuboid") if f"{x}]" in plan or f"{x}," in plan or f"{x}\n" in plan}


OPERATIONS = {
    "base": lambda c: c.base(),
    "slice": lambda c: c.slice("d", "a"),
    "slice_int": lambda c: c.slice("e", 2),
    "no_match": lambda c: c.slice("d", "none"),
    "dice": lambda c: c.dice({"d": ["a", "b"], "e": 1}),
    "dice_all": lambda c: c.dice({"d": "a", "e": 1, "f": "x"}),
    "dice_nothing": lambda c: c.dice({"d": "q", "e": 1, "f": "x"}),
    "rollup": lambda c: c.roll_up("e", ["e", "month", "TOTAL"]),
    "rollup_unknown": lambda c: c.roll_up("e", ["no such level", "TOTAL"]),
    "drill": lambda c: c.drill_down("d", "b", "month"),
    "info": lambda c: c.info(),
    "shape": lambda c: c.shape(),
    **{f"pivot_{kind}": (lambda c, kind=kind: c.pivot(["d"], ["e", "f"], "m", kind))
       for kind in ("sum", "mean", "count", "min", "max", "mean100")},
    "pivot_rows": lambda c: c.pivot(["d", "f"], [], "k", "sum"),
    "pivot_dense": lambda c: c.pivot(["d"], ["f"], "k", "mean", domains={"f": ["x", "y", "z"]}),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_equal_to_the_dataset_and_read_from_the_cuboid(session, name):
    answer = OPERATIONS[name](session)
    same(answer, OPERATIONS[name](session.cube))
    assert scanned(answer) == {"/cuboid"}


def test_columns_outside_the_cuboid_fall_back(session):
    answer = session.drill_down("d", "a", "who")
    same(answer, session.cube.drill_down("d", "a", "who"))
    assert scanned(answer) == {"/data"}
    with pytest.raises(ValueError):
        session.drill_down("d", "a", "nothing")
    with pytest.raises(ValueError):
        session.slice("month", 3)  # a level is no dimension
    with pytest.raises(ValueError):
        session.pivot(["d"], ["f"], "who")


def test_distinct_counts_unite(session):
    for dims in ([], ["d"], ["d", "month"]):
        rough = {tuple(r[d] for d in dims): r["distintos"] for r in session.distinct("who", dims).collect()}
        exact = {tuple(r[d] for d in dims): r["distintos"] for r in session.distinct("who", dims, approximate=False).collect()}
        assert rough.keys() == exact.keys()
        assert all(abs(rough[k] - exact[k]) <= exact[k] * SKETCH_ERROR for k in exact)
    plan = session.distinct("who", ["d"])
    assert scanned(plan) == {"/cuboid"} and "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
    assert scanned(session.distinct("e", ["d"])) == {"/data"}  # not sketched


def test_empty_dataset(spark, scratch):
    empty = Cube(spark.createDataFrame([], SCHEMA), ["d", "e", "f"], ["m", "k"])
    session = open_session(spark, empty, f"{scratch}/c", ["month"], ["who"])
    for name, run in OPERATIONS.items():
        if name != "pivot_dense":
            same(run(session), run(empty))
    assert session.distinct("who").first()["distintos"] == 0


def test_hot_combination(spark, scratch):
    """Nearly all rows in one cell: the sums stay exact whatever the partitioning."""
    data = spark.range(0, 60_000, 1, 7).selectExpr("'a' as d", "1 as e", "if(id % 1000 = 0, 'y', 'x') as f",
                                                   "cast(id % 12 as int) as month", "0.1D as m", "double(id) as k", "id as who")
    cube = Cube(data, ["d", "e", "f"], ["m", "k"])
    session = open_session(spark, cube, f"{scratch}/c")
    got = {r["f"]: (r["m_sum"], r["k_count"]) for r in session.base().collect()}
    assert got == {"x": (5994.0, 59940), "y": (6.0, 60)}
    same(session.base(), cube.base())
