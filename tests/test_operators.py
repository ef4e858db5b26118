"""Table operators and column rules on tiny inputs (B-rows, N-rules)."""

from datetime import date

from pyspark.sql import functions as F

from portacube.functions import exprs as X
from portacube.operators import tables as TB
from portacube.schemas import BUDGET_BINS, QUALITY_BINS


def test_dense_id_is_1_to_n_in_order(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit("v").alias("v"))
    out = TB.dense_id(df, ["k"], name="sid").collect()
    assert sorted(r.sid for r in out) == list(range(1, 5001))
    assert all(r.sid == r.k + 1 for r in out)


def test_keep_first_and_lookup_last(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c")], "k int, o int, v string")
    assert {r.k: r.v for r in TB.keep_first(df, "k", "o").collect()} == {1: "a", 2: "c"}
    lk = spark.createDataFrame([(1, 10.0, 1), (1, 20.0, 2), (3, 5.0, 1)], "id int, cost double, seq int")
    base = spark.createDataFrame([(1,), (2,)], "id int")
    got = {r.id: r.cost for r in TB.lookup_last(base, "id", lk, "id", ["cost"], order_by="seq").collect()}
    assert got == {1: 20.0, 2: None}


def test_fk_filter_and_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert [r.p for r in TB.fk_filter(child, "p", parent).collect()] == [1]
    assert TB.orphan_count(child, "p", parent).collect()[0].orphans == 1


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, -5.0, 50000.0, 50000.01, 250000.0, None]], "x double")
    got = [r.b for r in df.select(X.bin_right_closed("x", *BUDGET_BINS).alias("b")).collect()]
    assert got == [None, None, "Pequeño", "Mediano", "Mega", None]
    q = spark.createDataFrame([(1.0,), (1.2,), (0.7,)], "x double")
    assert [r.b for r in q.select(X.bin_right_closed("x", *QUALITY_BINS).alias("b")).collect()] == \
        ["Excelente", None, "Baja"]


def test_date_keys_with_reference_bases(spark):
    df = spark.createDataFrame([(date(2018, 6, 1),), (date(2019, 1, 1),), (date(2019, 1, 10),), (None,),
                                (date(2030, 1, 1),)], "d date")
    out = df.select(X.date_key_clamped("d", "2019-01-01").alias("b7"),
                    X.date_key_clamped("d", "2019-01-01", null_value=0, upper=100).alias("b8"),
                    X.date_key_ranged("d", "2018-01-01", 3375).alias("b9")).collect()
    assert [tuple(r) for r in out] == [(1, 1, 152), (1, 1, 366), (10, 10, 375), (None, 0, 0), (4019, 100, 1)]


def test_delay_changed_quarter_status(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), date(2020, 1, 5), 2020, 4),
                                (date(2020, 1, 5), date(2020, 1, 1), None, 12),
                                (None, date(2020, 1, 1), 2021, 12)], "p date, r date, y int, m int")
    out = df.select(X.delay_days("r", "p").alias("dl"), X.changed_flag("p", "r").cast("int").alias("ch"),
                    X.quarter_label("y", "m").alias("q")).collect()
    assert [tuple(r) for r in out] == [(4, 1, "2020-Q2"), (0, 1, None), (0, 1, "2021-Q4")]
    v = spark.createDataFrame([(95.0,), (87.0,), (80.0,), (None,)], "v double")
    assert [r.s for r in v.select(X.status_class("v", "higher", 90, 85).alias("s")).collect()] == \
        ["bueno", "regular", "malo", "regular"]


def test_safe_div_and_cap(spark):
    r = spark.range(1).select(X.safe_div(F.lit(1.0), F.lit(0.0)).alias("a"),
                              X.capped(F.lit(None).cast("double"), 100).alias("b"),
                              X.capped(F.lit(250.0), 100).alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == (None, None, 100.0)


def test_calendar_default_range(spark):
    empty = spark.createDataFrame([(None, None)], "lo date, hi date")
    cal = TB.calendar(empty, default=("2019-01-01", "2019-01-31"))
    ids = sorted(r.ID_Tiempo for r in cal.collect())
    assert ids == list(range(1, 32))


def test_missing_flag_and_deviation_labels(spark):
    from portacube.schemas import DEVIATION_LABELS, STATE_BY_FLAG
    df = spark.createDataFrame([(0, -1.0), (1, 2.0), (None, None), (3, 0.0)], "c int, d double")
    out = df.select(X.code_label("c", STATE_BY_FLAG).alias("e"), X.sign_label("d", *DEVIATION_LABELS).alias("t"))
    assert [tuple(r) for r in out.collect()] == [
        ("Cerrado", "Sobre Presupuesto"), ("Cancelado", "Bajo Presupuesto"), (None, "En Presupuesto"),
        (None, "En Presupuesto")]


def test_dense_id_stores_the_kept_columns_only(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (2, "b")], "k int, v string")
    out = TB.dense_id(df, ["k"], name="sid", stored=True, keep=["v"])
    assert out.columns == ["sid", "v"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "b"), (3, "b"), (4, "c")]
    folder = out.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.parquet(folder).columns == ["v", "__mid"]
