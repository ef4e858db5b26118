"""Physical-plan shape checks: the scale properties stay in place."""

import tempfile

import pytest
from fixtures import sources

from portacube.operators import tables as TB
from portacube.operators.crosstab import crosstab
from portacube.plans import facts as FT
from portacube.plans.extract import extract_all
from portacube.plans.pipeline import build_and_load, build_warehouse, stage_extracts
from portacube.sources.readers import read_warehouse


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ctx(spark):
    ext = extract_all(sources(spark), as_of="2021-01-01", extracted_at="2021-01-01 00:00:00")
    return ext, build_warehouse(ext, extend_calendar=False)


def test_project_measures_single_aggregate_no_sort_aggregate(spark):
    # as the batch job runs it: on staged extracts and written dimensions
    root = tempfile.mkdtemp(prefix="portacube-plan-")
    build_and_load(spark, sources(spark), root, as_of="2021-01-01", extracted_at="2021-01-01 00:00:00",
                   extend_calendar=False)
    st = stage_extracts(spark, extract_all(sources(spark), as_of="2021-01-01"), f"{root}/again")
    wh = read_warehouse(spark, root)
    m = FT.project_measures(st, wh["dim_proyectos"], wh["dim_tareas"], TB.calendar_summary(wh["dim_tiempo"]))
    phys = _plan(m)
    # all child tables meet in ONE aggregate by project: a single shuffle keyed by
    # the project id carries their partial aggregates
    assert phys.count("Exchange hashpartitioning(ID_Proyecto") <= 2  # aggregate (+ spine join)
    assert "SortAggregate" not in phys
    assert "CartesianProduct" not in phys and "BroadcastNestedLoopJoin" not in phys


def test_crosstab_is_one_expand_one_aggregate_per_measure(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 2.0)], "r string, c string, m double, n double")
    phys = _plan(crosstab(df, ["r"], ["c"], {"m": "sum", "n": "mean"}))
    assert phys.count("Expand") == 1
    assert "SortAggregate" not in phys


def test_keep_first_single_order_is_hash_aggregate(spark):
    # fixed-width values: hash aggregate (string values fall back to a sort-based
    # aggregate, still combined map-side)
    df = spark.createDataFrame([(1, 5, 2.0), (1, 3, 1.0)], "k int, o int, v double")
    phys = _plan(TB.keep_first(df, "k", "o"))
    assert "SortAggregate" not in phys and "Window" not in phys


def test_extract_scan_prunes_columns(spark, scratch):
    src = {}
    for name, df in sources(spark).items():
        df.write.mode("overwrite").parquet(f"{scratch}/{name}")
        src[name] = spark.read.parquet(f"{scratch}/{name}")
    phys = extract_all(src, as_of="2021-01-01")["clientes"]
    phys = _plan(phys)
    scans = [x.split("ReadSchema: ")[1] for x in phys.split("\n") if "ReadSchema: " in x]
    contracts = [x for x in scans if "ID_Contrato" in x or "ID_Cliente" in x]
    assert contracts and not any("ValorTotalContrato" in x or "NombreProyecto" in x for x in scans)
    assert "PushedFilters: [In(Estado" in phys and "CartesianProduct" not in phys


def test_project_view_joins(spark, scratch):
    """Unused joins are dropped, the expense dimension is cut to two keys, clients join projects first."""
    from portacube.plans import kpis as K
    from portacube.plans.views import olap_dataset, vista_asignaciones_completa, vista_proyectos_completa
    build_and_load(spark, sources(spark), scratch, as_of="2021-01-01", extend_calendar=False)
    w = read_warehouse(spark, scratch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_client = _plan(K.kpis_by_client(olap_dataset(vista_proyectos_completa(w))))
        assert "dim_gastos" not in by_client and "dim_tiempo" not in by_client
        whole = _plan(vista_proyectos_completa(w))
        assert "PushedFilters: [In(ID_Finanza, [0,1])" in whole
        # fact: project, calendar and employee key; client is joined on the project side
        assert _plan(vista_asignaciones_completa(w)).count("SortMergeJoin") == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_composite_keys_never_collide(spark, scratch):
    """Large key values neither overflow nor meet: order 10^12, line 10 and 100, part above 10^5, supplier above 10^4."""
    from portacube.sources.binding import _milestone_id, _task_id
    rows = [(1, 1, 100001, 5), (1, 2, 1, 5), (10**12, 10, 1, 1), (10**12, 1, 1, 1), (1, 11, 1, 10001), (1, 1, 1, 110001),
            (11, 1, 1, 10001), (1, 110, 1, 1), (11, 10, 1, 1)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    got = df.select(_task_id().alias("t"), _milestone_id().alias("m")).collect()
    assert len({r.t for r in got}) == len(rows)
    assert len({r.m for r in got}) == len({r[:2] for r in rows})


def test_shared_extracts_are_stored_once(spark):
    """Tasks, tests, errors and the tables above read stored milestones, errors and projects; rows as without; keys
    repeat or are missing."""
    from portacube.plans.dims import dim_proyectos
    from portacube.plans.pipeline import shared_extracts
    src = sources(spark)
    for name in ("hitos", "tareas", "errores", "pruebas"):
        first = src[name].limit(3)
        src[name] = src[name].union(first).union(first.withColumn("ID_Hito" if name != "errores" else "ID_Tarea",
                                                                  first["ID_Hito" if name != "errores" else "ID_Tarea"].substr(1, 0)))
    at = {"as_of": "2021-01-01", "extracted_at": "2021-01-01 00:00:00"}
    plain, shared = extract_all(src, **at), shared_extracts(src, **at)
    a = build_warehouse(plain, extend_calendar=False)
    b = build_warehouse(shared, extend_calendar=False, project_keys=dim_proyectos(plain))
    for name in plain:
        assert shared[name].columns == plain[name].columns
        assert sorted(map(str, shared[name].collect())) == sorted(map(str, plain[name].collect())), name
    for name in a:
        assert b[name].columns == a[name].columns
        assert sorted(map(str, b[name].collect())) == sorted(map(str, a[name].collect())), name
    assert any("/milestones-" in f for f in shared["tareas"].inputFiles())
    assert any("/errors-" in f for f in shared["errores"].inputFiles())
    assert all("/projects-" in f for f in b["dim_proyectos"].inputFiles())


def test_calendar_is_stored_once(spark):
    """The calendar of callers that share tables is read back, not found anew from all dates by every use."""
    from portacube.plans.dims import dim_proyectos
    from portacube.plans.pipeline import shared_extracts
    at = {"as_of": "2021-01-01", "extracted_at": "2021-01-01 00:00:00"}
    plain, shared = extract_all(sources(spark), **at), shared_extracts(sources(spark), **at)
    for extend in (False, True):
        a = build_warehouse(plain, extend_calendar=extend)
        b = build_warehouse(shared, extend_calendar=extend, project_keys=dim_proyectos(plain))
        files = b["dim_tiempo"].inputFiles()
        assert files and all("/calendar-" in f for f in files)
        assert sorted(map(str, b["dim_tiempo"].collect())) == sorted(map(str, a["dim_tiempo"].collect()))


def test_counted_tables_carry_no_amounts(spark):
    """Tasks, tests, errors and milestones meet in an aggregate of their own, without the columns of amounts and dates."""
    ext = extract_all(sources(spark), as_of="2021-01-01", extracted_at="2021-01-01 00:00:00")
    w = build_warehouse(ext, extend_calendar=False)
    m = FT.project_measures(ext, w["dim_proyectos"], w["dim_tareas"], TB.calendar_summary(w["dim_tiempo"]))
    partial = [x for x in _plan(m).split("\n") if "partial_sum(k_n" in x]
    assert partial and all("e_amt" not in x and "min_by" not in x for x in partial)


def test_milestones_that_repeat_or_lack_an_id_are_all_counted(spark):
    """Each milestone row counts, with its id's delayed tasks where it has an id."""
    src = sources(spark)
    first = src["hitos"].limit(1)
    pid = first.first()["ID_Proyecto"]
    none = first.withColumn("ID_Hito", first["ID_Hito"].substr(1, 0)).selectExpr(
        *[f"nullif({c}, '') as {c}" if c == "ID_Hito" else c for c in first.columns])

    def late(src):
        ext = extract_all(src, as_of="2021-01-01", extracted_at="2021-01-01 00:00:00")
        w = build_warehouse(ext, extend_calendar=False)
        h = ext["hitos"].where(f"ID_Proyecto = {pid}")
        t = w["dim_tareas"].groupBy("ID_Hito").agg({"SeRetraso": "sum", "ID_Tarea": "count"}).toDF("ID_Hito", "a", "b")
        by_id = {r["ID_Hito"]: (r["a"], r["b"]) for r in t.collect()}
        rows = h.collect()
        # columns come in the order of the dict's keys or of their names: late ones are the fewer
        pairs = [sorted(by_id[r["ID_Hito"]]) for r in rows if r["ID_Hito"] in by_id]
        m = FT.project_measures(ext, w["dim_proyectos"], w["dim_tareas"], TB.calendar_summary(w["dim_tiempo"]))
        got = m.where(f"ID_Proyecto = {pid}").first()
        n = len(rows)
        n_late = sum(r["FechaFinReal"] is not None and r["FechaFinReal"] > r["FechaFinPlanificada"] for r in rows)
        total = sum(p[1] for p in pairs)
        assert got["PorcentajeHitosRetrasados"] == n_late / n * 100
        assert got["PorcentajeTareasRetrasadas"] == (sum(p[0] for p in pairs) / total * 100 if total else 0.0)
        return n

    assert late({**src, "hitos": src["hitos"].union(first).union(none)}) == late(src) + 2


def test_batch_load_stores_zstd(spark, scratch):
    build_and_load(spark, sources(spark), scratch, as_of="2021-01-01", extracted_at="2021-01-01 00:00:00",
                   extend_calendar=False)
    files = read_warehouse(spark, scratch)["dim_tareas"].inputFiles()
    assert files and all(".zstd." in f for f in files)


def test_staged_cascade_equals_the_extracts_and_reads_each_source_once(spark, scratch):
    """Repeated and missing keys on every level; tasks and milestones are not read again for what hangs on them."""
    from pyspark.sql import functions as F

    from portacube.plans.pipeline import stage_cascade
    at = {"as_of": "2021-01-01", "extracted_at": "2021-01-01 00:00:00"}
    src = sources(spark)
    for name in ("proyectos", "hitos", "tareas", "contratos", "empleados"):
        key = src[name].columns[0]
        src[name] = src[name].union(src[name].limit(2)).union(src[name].limit(1).withColumn(key, F.lit(None).cast(src[name].schema[key].dataType)))
    for name, key in (("errores", "ID_Tarea"), ("pruebas", "ID_Hito"), ("asignaciones", "ID_Empleado"), ("gastos", "ID_Proyecto")):
        src[name] = src[name].union(src[name].limit(1).withColumn(key, F.lit(None).cast(src[name].schema[key].dataType)))
    read = {name: spark.sparkContext.accumulator(0) for name in ("hitos", "tareas")}

    def counting(total):
        def run(batches):
            for b in batches:
                total.add(b.num_rows)
                yield b
        return run
    rows = {name: src[name].count() for name in read}
    counted = {**src, **{name: src[name].mapInArrow(counting(total), src[name].schema) for name, total in read.items()}}
    counts = {}
    staged = stage_cascade(spark, counted, scratch, 4, counts, **at)
    plain = extract_all(src, **at)
    assert list(staged) == list(plain)
    for name, df in plain.items():
        assert staged[name].schema.names == df.schema.names
        assert sorted(map(str, staged[name].collect())) == sorted(map(str, df.collect())), name
        assert counts[name] == df.count()
    assert {name: total.value for name, total in read.items()} == rows
