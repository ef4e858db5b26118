"""

Every query reads the test tables of ``sf_dir`` through the binding
(``portacube.sources.binding``), runs the full cascade (extracts ->
warehouse -> views -> cubes/KPIs) on Spark and returns a lazy DataFrame.
``oracle_sql()`` gives the same result as independent DuckDB SQL
(``oracle_sql.py``); column names match one to one.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from portacube.functions import exprs as X  # noqa: E402
from portacube.operators import tables as TB  # noqa: E402
from portacube.operators.crosstab import crosstab  # noqa: E402
from portacube.operators.cube import kpi_cube, project_cube  # noqa: E402
from portacube.operators.cuboids import SKETCH_ERROR  # noqa: E402
from portacube.plans import cubes as P  # noqa: E402
from portacube.plans import kpis as K  # noqa: E402
from portacube.plans import quality as Q  # noqa: E402
from portacube.plans.dims import dim_proyectos  # noqa: E402
from portacube.plans.extract import extract_all  # noqa: E402
from portacube.plans.incremental import STATE, load  # noqa: E402
from portacube.plans.pipeline import build_and_load, build_warehouse, shared_extracts, stage_cascade, stored_warehouse  # noqa: E402
from portacube.plans.views import (olap_dataset, vista_asignaciones_completa,  # noqa: E402
                                   vista_hitos_tareas, vista_proyectos_completa)
from portacube.schemas import WAREHOUSE_SCHEMAS  # noqa: E402
from portacube.session import ensure_checkpoint_dir, shuffles_removed, sizes_unpacked  # noqa: E402
from portacube.sources.binding import STAMP, bind_changed_sources, bind_sources  # noqa: E402
from portacube.sources.checked import load_all, read_rejected  # noqa: E402
from portacube.sources.readers import read_sources, read_warehouse  # noqa: E402
from portacube.sources.sinks import conform, create_tables, write_table  # noqa: E402
from portacube.sources.versions import Versions, read_published  # noqa: E402
from portacube.streaming import watermark as WM  # noqa: E402

AS_OF = "2024-01-01"
EXTRACTED_AT = "2024-01-01 00:00:00"


class _Ctx:
    """Plan objects for one (session, sf_dir), lazy but for dense ids and tables that others share, which are stored when first
    asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.src = bind_sources(spark, sf_dir)
        self.ext = extract_all(self.src, as_of=AS_OF, extracted_at=EXTRACTED_AT)
        self._w = None
        self.merged: str | None = None
        self.sessions = None
        self.checked: str | None = None

    @property
    def w(self) -> dict[str, DataFrame]:
        if self._w is None:
            ext = shared_extracts(self.src, as_of=AS_OF, extracted_at=EXTRACTED_AT)
            self._w = build_warehouse(ext, extend_calendar=False, project_keys=dim_proyectos(self.ext))
        return self._w

    def view(self) -> DataFrame:
        return vista_proyectos_completa(self.w)

    def olap(self) -> DataFrame:
        return olap_dataset(self.view())


_CTX_CACHE: dict[tuple[str, int, str], _Ctx] = {}


def _ctx(spark: SparkSession, sf_dir: str) -> _Ctx:
    """One plan context per (application, session, sf_dir): lazy plans are immutable and reusable."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _CTX_CACHE:
        _CTX_CACHE[key] = _Ctx(spark, sf_dir)
    return _CTX_CACHE[key]


def _stamped(df: DataFrame) -> DataFrame:
    """The extraction time as text, the same on every run."""
    return df.withColumn("fecha_extraccion", F.date_format("fecha_extraccion", "yyyy-MM-dd HH:mm:ss"))


# ---------------------------------------------------------------- Spark side
def _q_extract(name: str, cols: list[str] | None = None):
    def run(spark, sf_dir):
        df = _stamped(_ctx(spark, sf_dir).ext[name])
        return df.select(*cols) if cols else df
    return run


def _q_wh(name: str):
    return lambda spark, sf_dir: _ctx(spark, sf_dir).w[name]


def _incremental(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    ext = extract_all(ctx.src, as_of=AS_OF, extracted_at=EXTRACTED_AT, since="1998-01-01",
                      since_column="FechaInicio")
    return _stamped(ext["proyectos"])


def _merged(spark, sf_dir):
    """A warehouse loaded from older sources, then incrementally from the given ones; its root, one per context."""
    ctx = _ctx(spark, sf_dir)
    if ctx.merged is None:
        root = _scratch(spark, "incremental")
        then, now = bind_changed_sources(spark, sf_dir)
        changed = dict.fromkeys(now, STAMP)
        for src, at in ((then, EXTRACTED_AT), (now, "2024-03-01 00:00:00")):
            load(spark, src, root, changed, f"{root}/control", as_of=AS_OF, extracted_at=at, extend_calendar=False,
                 buckets=16)
        ctx.merged = root
    return ctx.merged


def _incremental_merge(table: str, *ids: str):
    """A table after the incremental load; without the ids, which a full load would number anew."""
    return lambda spark, sf_dir: read_published(spark, _merged(spark, sf_dir))[table].drop(*ids)


def _stable_ids(spark, sf_dir):
    """Natural keys and ids after the incremental load: those of the first load, and above them the new ones."""
    versions = Versions(spark, _merged(spark, sf_dir))
    keys = versions.read(versions.record(), "_keys", T.StructType.fromDDL(STATE["_keys"]))
    return keys.select("table", "natural_key", "occurrence", "id")


def _scratch(spark, tag: str) -> str:
    """A folder of its own in the shared checkpoint folder, removed with the session."""
    root = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


def _load_counts(spark, sf_dir):
    """The batch job from stored sources, of which one table is absent: rows it loaded and rows that are stored."""
    root = _scratch(spark, "batch")
    for name, df in _ctx(spark, sf_dir).src.items():
        if name != "penalizaciones_contrato":
            df.write.option("compression", "zstd").parquet(f"{root}/sources/{name}")
    src = read_sources(spark, f"{root}/sources", optional=["penalizaciones_contrato"])
    create_tables(spark, f"{root}/warehouse")
    counts = build_and_load(spark, src, f"{root}/warehouse", as_of=AS_OF, extracted_at=EXTRACTED_AT, extend_calendar=False,
                            control_path=f"{root}/control")
    stored = Q.table_profile(read_warehouse(spark, f"{root}/warehouse"))
    return counts.join(stored.withColumnsRenamed({"table_name": "table", "n_rows": "rows_stored"}), "table").select(
        "table", "rows_loaded", "rows_in", "rows_stored", F.lit(WM.last_extraction(spark, f"{root}/control")).alias("watermark"))


def _append_load(spark, sf_dir):
    """Overwrite, append and an empty overwrite, which leaves the table: its rows by client."""
    root, clients = _scratch(spark, "append"), _ctx(spark, sf_dir).w["dim_clientes"]
    for df, mode in ((clients, "overwrite"), (clients.where("ID_Cliente % 2 = 0"), "append"), (clients.limit(0), "overwrite")):
        write_table(df, f"{root}/dim_clientes", mode, "dim_clientes")
    stored = spark.read.schema(WAREHOUSE_SCHEMAS["dim_clientes"]).parquet(f"{root}/dim_clientes")
    return stored.groupBy("ID_Cliente").agg(F.count(F.lit(1)).alias("rows"))


def _watermark_moves(spark, sf_dir):
    """A watermark that follows the months of the assignments and is set back once: its last ten moves."""
    path, a = f"{_scratch(spark, 'moves')}/control", _ctx(spark, sf_dir).src["asignaciones"]
    months = a.select(F.date_format(F.trunc("FechaAsignacion", "month"), "yyyy-MM-dd 00:00:00").alias("m")).distinct()
    # one row a month of the data's range
    for r in months.where("m is not null").orderBy("m").collect():
        WM.advance(spark, path, r["m"])
    WM.reset(spark, path)
    return WM.history(spark, path).drop("updated_at")


def _ordered_files(spark, sf_dir):
    """The assignments of the middle project from files that hold ranges of projects, in their order."""
    root, a = _scratch(spark, "ordered"), _ctx(spark, sf_dir).ext["asignaciones"].drop("fecha_extraccion")
    write_table(a, root, order_by=["ID_Proyecto", "FechaAsignacion", "ID_Asignacion"])
    stored = spark.read.schema(a.schema).parquet(root)
    middle = stored.agg(F.expr("percentile_disc(0.5) within group (order by ID_Proyecto)")).first()[0]
    return stored.where(F.col("ID_Proyecto") == F.lit(middle))


def _planted(w: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The warehouse tables with broken constraints: repeated clients, milestones and assignments of no project, tasks
    without code."""
    clients, code = w["dim_clientes"], F.col("CodigoTarea")
    return {**{t: w[t] for t in WAREHOUSE_SCHEMAS},
            "dim_clientes": clients.union(clients.where("ID_Cliente % 53 = 1")),
            "dim_hitos": w["dim_hitos"].withColumn("ID_proyectos", F.expr("if(ID_proyectos % 307 = 1, -1, ID_proyectos)")),
            "dim_tareas": w["dim_tareas"].withColumn("CodigoTarea", F.when(~code.endswith("77"), code)),
            "hechos_asignaciones": w["hechos_asignaciones"].withColumn(
                "ID_Proyecto", F.expr("if(ID_Empleado % 41 = 2, -ID_Proyecto, ID_Proyecto)"))}


def _checked(spark, sf_dir):
    """A load of tables with broken constraints; its root, and what it returned."""
    ctx = _ctx(spark, sf_dir)
    if ctx.checked is None:
        root, staging = _scratch(spark, "checked"), _scratch(spark, "checked-staging")
        with shuffles_removed(spark), sizes_unpacked(spark):
            ext = stage_cascade(spark, ctx.src, staging, as_of=AS_OF, extracted_at=EXTRACTED_AT)
        w = stored_warehouse(spark, ext, staging, extend_calendar=False, staged=True)
        ctx.checked = root, load_all(spark, _planted(w), root, max_rejected=0.2)
        path = spark._jvm.org.apache.hadoop.fs.Path(staging)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return ctx.checked


def _quarantine(spark, sf_dir):
    rejected = read_rejected(spark, _checked(spark, sf_dir)[0])
    return (rejected.select("table", F.explode("reasons").alias("reason")).groupBy("table", "reason")
            .agg(F.count(F.lit(1)).alias("rows")))


def _checked_audit(spark, sf_dir):
    """Orphans, repeated keys and missing values left in the loaded tables."""
    w = read_published(spark, _checked(spark, sf_dir)[0])
    return (Q.fk_audit(w).where("parent not in ('dim_tiempo', 'dim_gastos')").agg(F.sum("orphans").alias("n"))
            .select(F.lit("orphans").alias("fault"), "n")
            .union(Q.pk_audit(w).select(F.lit("duplicates"), F.sum("extra_rows")))
            .union(Q.null_audit(w).select(F.lit("nulls"), F.sum("nulls"))))


def _table_profile(spark, sf_dir):
    w = _ctx(spark, sf_dir).w
    return Q.table_profile({t: w[t] for t in WAREHOUSE_SCHEMAS})


def _profile_headlines(spark, sf_dir):
    return Q.profile_headlines(_ctx(spark, sf_dir).olap())


def _crosstab_dense(spark, sf_dir):
    from portacube.operators.crosstab import densify
    from portacube.schemas import BUDGET_BINS, PRODUCTIVITY_BINS
    meas = {"ID_Proyecto": "count", "Presupuesto": "sum"}
    long = crosstab(_ctx(spark, sf_dir).olap(), ["CategoriaPresupuesto"], ["CategoriaProductividad"], meas,
                    fill_value=0, margins_name="TOTAL")
    return densify(long, ["CategoriaPresupuesto"], ["CategoriaProductividad"],
                   {"CategoriaPresupuesto": BUDGET_BINS[1], "CategoriaProductividad": PRODUCTIVITY_BINS[1]}, meas)


def _fk_filter(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return TB.fk_filter(ctx.ext["asignaciones"], "ID_Proyecto", ctx.w["dim_proyectos"]).select(
        "ID_Asignacion", "ID_Proyecto", "ID_Empleado")


def _orphan_count(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return TB.orphan_count(ctx.src["asignaciones"], "ID_Proyecto", ctx.w["dim_proyectos"])


def _keep_first(spark, sf_dir):
    a = _ctx(spark, sf_dir).ext["asignaciones"].select(
        "ID_Empleado", "FechaAsignacion", "ID_Proyecto", "ID_Asignacion", "HorasPlanificadas", "HorasReales")
    return TB.keep_first(a, "ID_Empleado", ["FechaAsignacion", "ID_Proyecto", "ID_Asignacion",
                                            "HorasPlanificadas", "HorasReales"])


def _lookup_last(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    a = ctx.src["asignaciones"].select("ID_Asignacion", "ID_Proyecto", "ID_Empleado")
    return TB.lookup_last(a, "ID_Empleado", ctx.ext["empleados"], "ID_Empleado", ["CostoPorHora"])


def _lookup_last_duplicates(spark, sf_dir):
    """The hours of each employee's latest assignment: many lookup rows per key, the last by (date, id) wins."""
    ctx = _ctx(spark, sf_dir)
    return TB.lookup_last(ctx.src["empleados"].select("ID_Empleado", "NombreCompleto"), "ID_Empleado",
                          ctx.src["asignaciones"], "ID_Empleado", ["HorasReales"],
                          order_by=["FechaAsignacion", "ID_Asignacion"])


def _coerce_dates(spark, sf_dir):
    """Text dates, some unparsable or empty."""
    p = _ctx(spark, sf_dir).src["proyectos"]
    text = (F.when(F.col("ID_Proyecto") % 7 == 0, "no date").when(F.col("ID_Proyecto") % 11 == 0, "")
            .otherwise(F.col("FechaInicio").cast("string")))
    return p.select("ID_Proyecto", X.as_date(text).alias("fecha"))


def _conform_rules(spark, sf_dir):
    """A frame with a missing column, a missing default, NaN and a column too many, conformed to its table."""
    p = _ctx(spark, sf_dir).w["dim_proyectos"]
    df = p.select("NumTrabajadores", "ID_Proyecto", "CodigoProyecto", "ID_Cliente", F.lit("x").alias("junk"),
                  F.when(F.col("ID_Proyecto") % 2 == 0, F.col("Cancelado")).alias("Cancelado"), "TotalErrores")
    return conform(df, "dim_proyectos")


def _build_audit(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return Q.build_audit(ctx.ext, ctx.w)


def _dense_id(spark, sf_dir):
    g = _ctx(spark, sf_dir).ext["gastos"].select("ID_Gasto", "ID_Proyecto", "Fecha")
    return TB.dense_id(g, ["ID_Proyecto", "Fecha", "ID_Gasto"], name="row_id")


def _date_key_clamped(spark, sf_dir):
    h = _ctx(spark, sf_dir).ext["hitos"]
    return h.select("ID_Hito",
                    X.date_key_clamped("FechaInicio", "1996-06-01").alias("key_start"),
                    X.date_key_clamped("FechaFinReal", "1996-06-01", null_value=0, upper=1500).alias("key_end"))


def _date_key_ranged(spark, sf_dir):
    p = _ctx(spark, sf_dir).ext["proyectos"]
    return p.select("ID_Proyecto",
                    X.date_key_ranged("FechaInicio", "1996-01-01", 1500).alias("key_start"),
                    X.date_key_ranged(F.coalesce(F.col("FechaFinReal"), F.col("FechaFin")), "1996-01-01", 1500)
                    .alias("key_end"))


def _delay_days(spark, sf_dir):
    t = _ctx(spark, sf_dir).ext["tareas"]
    return t.select("ID_Tarea", X.delay_days("FechaFinReal", "FechaFinPlanificada").alias("end_delay"),
                    X.delay_days("FechaInicioReal", "FechaInicioPlanificada").alias("start_delay"))


def _changed_flag(spark, sf_dir):
    t = _ctx(spark, sf_dir).ext["tareas"]
    return t.select("ID_Tarea",
                    X.changed_flag("FechaInicioPlanificada", "FechaInicioReal").cast("int").alias("start_changed"),
                    X.changed_flag("FechaFinPlanificada", "FechaFinReal").cast("int").alias("end_changed"))


def _bins(spark, sf_dir):
    return _ctx(spark, sf_dir).olap().select("ID_Proyecto", "Estado", "CategoriaPresupuesto", "TipoDesviacion",
                                             "CategoriaProductividad", "CategoriaCalidad")


def _quarter(spark, sf_dir):
    return _ctx(spark, sf_dir).olap().select("ID_Proyecto", "AnioInicio", "MesInicio", "PeriodoInicio")


def _union_tagged(spark, sf_dir):
    ext = _ctx(spark, sf_dir).ext
    g = ext["gastos"].select(F.col("ID_Gasto").alias("line_id"), "TipoGasto", "Categoria", "Monto")
    p = ext["penalizaciones"].select(F.col("ID_Penalizacion").alias("line_id"), "Monto")
    return TB.union_tagged([(g, {"fuente": "gastos"}),
                            (p, {"fuente": "penalizaciones", "TipoGasto": "Penalizaciones", "Categoria": "OPEX"})])


def _views(which: str):
    def run(spark, sf_dir):
        ctx = _ctx(spark, sf_dir)
        if which == "projects":
            return ctx.view()
        if which == "assignments":
            return vista_asignaciones_completa(ctx.w)
        if which == "milestones":
            return vista_hitos_tareas(ctx.w)
        return ctx.olap()
    return run


def _cube(op: str):
    def run(spark, sf_dir):
        c = kpi_cube(_ctx(spark, sf_dir).olap())
        if op == "base":
            return c.base()
        if op == "slice":
            return c.slice("Estado", "Cerrado")
        if op == "slice_all":
            return kpi_cube_single(c).slice("Estado", "Cerrado")
        if op == "dice":
            return c.dice({"Estado": "Cerrado", "CategoriaPresupuesto": ["Grande", "Mega"]})
        if op == "rollup":
            return c.roll_up("PeriodoInicio", ["PeriodoInicio", "AnioInicio", "TOTAL"])
        if op == "drilldown":
            return c.drill_down("Estado", "Cerrado", "MesInicio")
        if op == "pivot":
            return c.pivot(["Estado"], ["CategoriaPresupuesto"], "Presupuesto", "mean")
        if op == "info":
            return c.info()
        if op == "preview":
            return c.preview(20)
        if op == "shape":
            return c.shape()
        if op == "slice_empty":
            return kpi_cube_single(c).slice("Estado", "no such state")
        if op == "pivot_dense":
            return c.pivot(["Estado"], ["CategoriaPresupuesto"], "Presupuesto", "mean",
                           domains=P.category_domains(["CategoriaPresupuesto"]))
        if op == "project_base":
            return project_cube(_ctx(spark, sf_dir).olap()).base()
        raise ValueError(op)
    return run


def _session(op: str):
    """Operations of a cube session: two stored cuboids, opened once per context."""
    def run(spark, sf_dir):
        ctx = _ctx(spark, sf_dir)
        if ctx.sessions is None:
            ctx.sessions = P.open_cubes(ctx.olap(), _scratch(spark, "cuboids"))
        c = ctx.sessions["cubo_kpis"]
        if op == "slice":
            return c.slice("Estado", "Cerrado")
        if op == "dice":
            return c.dice({"Estado": "Cerrado", "CategoriaPresupuesto": ["Grande", "Mega"]})
        if op == "rollup":
            return c.roll_up("PeriodoInicio", ["PeriodoInicio", "AnioInicio", "TOTAL"])
        if op == "drilldown":
            return c.drill_down("Estado", "Cerrado", "MesInicio")
        if op == "pivot":
            return c.pivot(["Estado"], ["CategoriaPresupuesto"], "Presupuesto", "mean")
        if op == "info":
            return c.info()
        if op == "shape":
            return c.shape()
        if op == "projects":
            return ctx.sessions["cubo_proyectos"].base()
        if op == "sizes":
            return P.cube_sizes(ctx.sessions)
        if op == "distinct":
            exact = c.distinct("CodigoClienteReal", ["Estado", "AnioInicio"], approximate=False)
            rough = c.distinct("CodigoClienteReal", ["Estado", "AnioInicio"]).withColumnRenamed("distintos", "estimado")
            return exact.join(rough, ["Estado", "AnioInicio"]).select(
                "Estado", "AnioInicio", "distintos",
                (F.abs(F.col("estimado") - F.col("distintos")) <= F.col("distintos") * SKETCH_ERROR).alias("en_margen"))
        raise ValueError(op)
    return run


def kpi_cube_single(c):
    from portacube.operators.cube import Cube
    return Cube(c.data, ["Estado"], ["Presupuesto", "ProductividadPromedio"])


def _crosstab_margins(spark, sf_dir):
    return crosstab(_ctx(spark, sf_dir).olap(), ["Estado", "TipoDesviacion"], ["CategoriaCalidad"],
                    {"Presupuesto": "sum", "ProductividadPromedio": "mean", "ID_Proyecto": "count"},
                    margins_name="All")


def _p(fn, **kw):
    return lambda spark, sf_dir: fn(_ctx(spark, sf_dir).olap(), **kw)


def _p7(spark, sf_dir):
    return P.cube_custom(_ctx(spark, sf_dir).olap(), ["Estado"], ["Presupuesto", "TasaDeExitoEnPruebas",
                                                                   "ID_Proyecto", "NumTrabajadores"],
                         columns=["CategoriaPresupuesto"])


def _kpi(kind: str):
    def run(spark, sf_dir):
        ctx = _ctx(spark, sf_dir)
        o = ctx.olap()
        if kind == "a":
            return K.kpi_table(o, ctx.w["hechos_asignaciones"], "A")
        if kind == "b":
            return K.kpi_table(o, ctx.w["hechos_asignaciones"], "B")
        if kind == "alerts":
            return K.alerts(K.kpi_table(o, ctx.w["hechos_asignaciones"], "A"))
        if kind == "alert_total":
            return K.alert_count(K.kpi_table(o, ctx.w["hechos_asignaciones"], "A"))
        if kind == "client":
            return K.kpis_by_client(o)
        if kind == "badge":
            return K.client_badge(K.kpis_by_client(o))
        if kind == "stats":
            return K.stats(o)
        if kind == "trend":
            return K.trend_by_year(o)
        if kind == "hours":
            return K.hours_ratio(ctx.w["hechos_asignaciones"])
        raise ValueError(kind)
    return run


def _quality(kind: str):
    def run(spark, sf_dir):
        w = _ctx(spark, sf_dir).w
        return {"fk": Q.fk_audit, "pk": Q.pk_audit, "nulls": Q.null_audit}[kind](w)
    return run


def _flagship(spark, sf_dir):
    """KPIs per client over the whole cascade (the minimum end-to-end slice)."""
    return K.kpis_by_client(_ctx(spark, sf_dir).olap())


def _llm():
    """The training-data subpackage's registry, or None where the subpackage is not installed."""
    if importlib.util.find_spec("portacube.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    from portacube.llm import entry as registry
    return registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = _own_queries()
    registry = _llm()
    if registry:
        import corpus_pipeline
        out.update(registry.queries())
        out["pipeline"] = corpus_pipeline.run
    return out


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "extract_clients_semi": _q_extract("clientes"),
        "extract_employees_semi": _q_extract("empleados"),
        "extract_contracts": _q_extract("contratos"),
        "extract_projects_left": _q_extract("proyectos"),
        "extract_milestones_delay": _q_extract("hitos"),
        "extract_tasks": _q_extract("tareas"),
        "extract_assignments_cost": _q_extract("asignaciones"),
        "extract_tests": _q_extract("pruebas"),
        "extract_errors": _q_extract("errores"),
        "extract_expenses": _q_extract("gastos"),
        "extract_penalties": _q_extract("penalizaciones"),
        "incremental_filter": _incremental,
        "incremental_merge": _incremental_merge("hechos_proyectos", "ID_Hecho"),
        "incremental_tasks": _incremental_merge("dim_tareas"),
        "incremental_assignments": _incremental_merge("hechos_asignaciones", "ID_HechoAsignacion"),
        "stable_ids": _stable_ids,
        "load_counts": _load_counts,
        "append_load": _append_load,
        "watermark_moves": _watermark_moves,
        "ordered_files": _ordered_files,
        "checked_load": lambda spark, sf_dir: _checked(spark, sf_dir)[1],
        "checked_quarantine": _quarantine,
        "checked_audit": _checked_audit,
        "table_profile": _table_profile,
        "profile_headlines": _profile_headlines,
        "fk_filter": _fk_filter,
        "orphan_count": _orphan_count,
        "keep_first": _keep_first,
        "lookup_last": _lookup_last,
        "lookup_last_duplicates": _lookup_last_duplicates,
        "coerce_dates": _coerce_dates,
        "conform_rules": _conform_rules,
        "build_audit": _build_audit,
        "dense_id": _dense_id,
        "date_key_clamped": _date_key_clamped,
        "date_key_ranged": _date_key_ranged,
        "delay_days": _delay_days,
        "changed_flag": _changed_flag,
        "bin_right_closed": _bins,
        "quarter_label": _quarter,
        "calendar_days": _q_wh("dim_tiempo"),
        "union_tagged": _union_tagged,
        "dim_clients": _q_wh("dim_clientes"),
        "dim_employees": _q_wh("dim_empleados"),
        "dim_projects": _q_wh("dim_proyectos"),
        "dim_expenses": _q_wh("dim_gastos"),
        "dim_milestones": _q_wh("dim_hitos"),
        "dim_tasks": _q_wh("dim_tareas"),
        "dim_tests": _q_wh("dim_pruebas"),
        "fact_assignments": _q_wh("hechos_asignaciones"),
        "fact_projects": _q_wh("hechos_proyectos"),
        "view_projects": _views("projects"),
        "view_assignments": _views("assignments"),
        "view_milestone_tasks": _views("milestones"),
        "olap_dataset": _views("olap"),
        "cube_base": _cube("base"),
        "cube_slice": _cube("slice"),
        "cube_slice_total": _cube("slice_all"),
        "cube_dice": _cube("dice"),
        "cube_rollup": _cube("rollup"),
        "cube_drilldown": _cube("drilldown"),
        "cube_pivot": _cube("pivot"),
        "cube_info": _cube("info"),
        "cube_shape": _cube("shape"),
        "cube_pivot_dense": _cube("pivot_dense"),
        "cube_slice_empty": _cube("slice_empty"),
        "project_cube_base": _cube("project_base"),
        "cube_session_slice": _session("slice"),
        "cube_session_dice": _session("dice"),
        "cube_session_rollup": _session("rollup"),
        "cube_session_drilldown": _session("drilldown"),
        "cube_session_pivot": _session("pivot"),
        "cube_session_info": _session("info"),
        "cube_session_shape": _session("shape"),
        "cube_session_projects": _session("projects"),
        "cube_sizes": _session("sizes"),
        "distinct_sketch": _session("distinct"),
        "crosstab_margins": _crosstab_margins,
        "crosstab_dense": _crosstab_dense,
        "cube_preview": _cube("preview"),
        "cubes_p1": _p(P.cube_base),
        "cubes_p2": _p(P.cube_productivity_quality),
        "cubes_p3": _p(P.cube_financial),
        "cubes_p4": _p(P.cube_time_state),
        "cubes_p5": _p(P.cube_multi_measure),
        "cubes_p6": _p(P.cube_executive),
        "cubes_p7": _p7,
        "cubes_p8": _p(P.cube_kpis_main),
        "cubes_p9": _p(P.cube_kpis_time),
        "cubes_p10": _p(P.cube_kpis_category),
        "cubes_p2_dense": _p(P.cube_productivity_quality, dense=True),
        "cubes_p3_dense": _p(P.cube_financial, dense=True),
        "cubes_p10_dense": _p(P.cube_kpis_category, dense=True),
        "kpi_table_a": _kpi("a"),
        "kpi_table_b": _kpi("b"),
        "kpi_alerts": _kpi("alerts"),
        "alert_total": _kpi("alert_total"),
        "kpi_by_client": _kpi("client"),
        "kpi_client_badge": _kpi("badge"),
        "kpi_stats": _kpi("stats"),
        "kpi_trend_year": _kpi("trend"),
        "hours_ratio": _kpi("hours"),
        "quality_fk": _quality("fk"),
        "quality_pk": _quality("pk"),
        "quality_nulls": _quality("nulls"),
    }


def entry(spark: SparkSession) -> DataFrame:
    return _flagship(spark, "/root/testdata/sf0.001")


def oracle_sql() -> dict[str, str]:
    from oracle_queries import ORACLE
    out = dict(ORACLE)
    registry = _llm()
    if registry:
        import corpus_pipeline
        out.update(registry.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
