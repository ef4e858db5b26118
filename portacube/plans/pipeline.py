"""Dependency-ordered warehouse build (D9) and the end-to-end batch job."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from portacube.operators import tables as TB
from portacube.plans import dims as D
from portacube.plans import facts as FT
from portacube.plans.extract import EXTRACT_LEVELS, extract_all
from portacube.schemas import CALENDAR_DEFAULT_END, CALENDAR_DEFAULT_START, LOAD_ORDER, WAREHOUSE_SCHEMAS
from portacube.session import shuffles_removed, sizes_unpacked
from portacube.sources.sinks import write_table


class LazyTables(Mapping):
    """Read-only mapping that builds each table on first access (memoised).

    Building a plan is free except for dense ids, whose one checkpoint runs
    when the table is built; a caller asking for one table therefore only
    pays for that table and its dependencies.
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def materialize(self, name: str, df: DataFrame) -> None:
        """Replace a table by its written copy, so dependents read it instead of recomputing it."""
        self._built[name] = df


def shared_extracts(src: dict[str, DataFrame], as_of=None, extracted_at=None) -> LazyTables:
    """The extracts for lazy callers; those that several tables are built from are stored when first asked for.

    Milestones lead tasks, tests and errors to their projects, and errors are
    counted by the project dimension and the project fact.
    """
    plain = extract_all(src, as_of=as_of, extracted_at=extracted_at)
    x: LazyTables

    def through(name: str) -> Callable[[], DataFrame]:
        return lambda: extract_all(src, as_of=as_of, extracted_at=extracted_at, hitos=x["hitos"])[name]

    x = LazyTables({**{n: (lambda df=df: df) for n, df in plain.items()},
                    "hitos": lambda: TB.stored_once(plain["hitos"], "milestones"),
                    "tareas": through("tareas"), "pruebas": through("pruebas"),
                    "errores": lambda: TB.stored_once(through("errores")(), "errors")})
    return x


def build_warehouse(ext: Mapping[str, DataFrame], extend_calendar: bool = True,
                    project_keys: DataFrame | None = None) -> LazyTables:
    """All ten warehouse tables from the extracts, as lazily built DataFrames.

    Dependencies: clients, employees, projects, calendar, expenses ->
    milestones -> tasks, tests -> facts.  ``extend_calendar`` widens the
    calendar to the default reporting range; date keys always use the
    calendar's own first day as base, so they join to it.  With
    ``project_keys``, a lazy project dimension for tables that read its keys
    only (its counts are then pruned), the dimension itself and the calendar
    are computed and stored when they are first asked for: every use of a
    lazy calendar would read all dates of the sources again.
    """
    def projects() -> DataFrame:
        df = D.dim_proyectos(ext, ext["clientes"])
        return TB.stored_once(df, "projects") if project_keys is not None else df

    def keys() -> DataFrame:
        return w["dim_proyectos"] if project_keys is None else project_keys

    def calendar() -> DataFrame:
        if extend_calendar:
            days = D.dim_tiempo(ext, CALENDAR_DEFAULT_START, CALENDAR_DEFAULT_END,
                                default=(CALENDAR_DEFAULT_START, CALENDAR_DEFAULT_END))
        else:
            days = D.dim_tiempo(ext)
        return TB.stored_once(days, "calendar") if project_keys is not None else days

    w: LazyTables
    cal = lambda: TB.calendar_summary(w["dim_tiempo"])
    w = LazyTables({
        "dim_clientes": lambda: D.dim_clientes(ext),
        "dim_empleados": lambda: D.dim_empleados(ext),
        "dim_proyectos": projects,
        "dim_tiempo": calendar,
        "dim_gastos": lambda: D.dim_gastos(ext),
        "dim_hitos": lambda: D.dim_hitos(ext, keys(), cal()),
        "dim_tareas": lambda: D.dim_tareas(ext, w["dim_hitos"]),
        "dim_pruebas": lambda: D.dim_pruebas(ext, w["dim_hitos"]),
        "hechos_asignaciones": lambda: FT.hechos_asignaciones(ext, keys(), cal()),
        "hechos_proyectos": lambda: FT.hechos_proyectos(ext, keys(), w["dim_tareas"], cal()),
    })
    return w


def run_etl(src: dict[str, DataFrame], as_of=None, extracted_at=None, extend_calendar: bool = True,
            since=None, since_column: str | None = None) -> LazyTables:
    """Extract + transform: source tables -> warehouse tables (lazy)."""
    ext = extract_all(src, as_of=as_of, extracted_at=extracted_at, since=since, since_column=since_column)
    return build_warehouse(ext, extend_calendar=extend_calendar)


# Parent-before-child load levels; tables inside one level do not depend on each other.
LOAD_LEVELS = [
    ["dim_clientes", "dim_empleados", "dim_proyectos", "dim_tiempo", "dim_gastos"],
    ["dim_hitos", "hechos_asignaciones"],
    ["dim_tareas", "dim_pruebas"],
    ["hechos_proyectos"],
]


def _run_all(fns: list[Callable[[], object]], parallel_jobs: int) -> list:
    """Run independent Spark actions from a small thread pool (concurrent jobs)."""
    if parallel_jobs <= 1 or len(fns) <= 1:
        return [f() for f in fns]
    with ThreadPoolExecutor(max_workers=min(parallel_jobs, len(fns))) as pool:
        return [f.result() for f in [pool.submit(fn) for fn in fns]]


#: the extracts that feed each table
FED_BY = {"dim_clientes": ["clientes"], "dim_empleados": ["empleados"], "dim_proyectos": ["proyectos"],
          "dim_gastos": ["gastos", "penalizaciones"], "dim_hitos": ["hitos"], "dim_tareas": ["tareas"],
          "dim_pruebas": ["pruebas"], "hechos_asignaciones": ["asignaciones"], "hechos_proyectos": ["proyectos"]}


def stage_extracts(spark: SparkSession, ext: dict[str, DataFrame], root: str, parallel_jobs: int = 8,
                   counts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Write every extract once to ``<root>/<name>`` and return the read-back tables.

    The staging area cuts the lineage of the source joins: every builder
    reads the materialised extracts instead of recomputing the cascade, and
    a lost executor only re-reads files.  The writes are independent jobs and
    are submitted concurrently.  ``counts`` receives the rows of each extract,
    observed by its write.
    """
    def write(name: str, df: DataFrame) -> Callable[[], None]:
        def run() -> None:
            obs = Observation(f"staged:{name}")
            df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
                "compression", "zstd").parquet(f"{root}/{name}")
            if counts is not None:
                counts[name] = int(obs.get["rows"])
        return run

    _run_all([write(n, df) for n, df in ext.items()], parallel_jobs)
    return {name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in ext.items()}


def stage_cascade(spark: SparkSession, src: Mapping[str, DataFrame], root: str, parallel_jobs: int = 8,
                  counts: dict[str, int] | None = None, **at) -> dict[str, DataFrame]:
    """All extracts of ``src`` stored as by ``stage_extracts``, level by level (``at``: further arguments of ``extract_all``).

    Every level follows from the stored one before, so that projects,
    milestones and tasks are found once and not again for each extract below them.
    """
    staged: dict[str, DataFrame] = {}
    for level in EXTRACT_LEVELS:
        ext = extract_all(src, stored=staged, **at)
        staged.update(stage_extracts(spark, {n: ext[n] for n in level}, root, parallel_jobs, counts))
    return {n: staged[n] for n in ext}


def stored_warehouse(spark: SparkSession, ext: dict[str, DataFrame], root: str, extend_calendar: bool = True,
                     staged: bool = False) -> LazyTables:
    """The warehouse over extracts, and over tables that others are built from, each computed once and stored below ``root``.

    For callers that ask for all tables: the cascade is not run again for every table.  Extracts that are
    ``staged`` already are not stored again.
    """
    with shuffles_removed(spark), sizes_unpacked(spark):
        w = build_warehouse(ext if staged else stage_extracts(spark, ext, root), extend_calendar=extend_calendar)
        for name in ("dim_proyectos", "dim_hitos", "dim_tareas"):
            w.materialize(name, stage_extracts(spark, {name: w[name]}, root)[name])
    return w


def build_and_load(spark: SparkSession, src: dict[str, DataFrame], root: str, as_of=None, extracted_at=None,
                   extend_calendar: bool = True, parallel_jobs: int = 8,
                   control_path: str | None = None) -> DataFrame:
    """The batch job: extract -> stage -> build -> load, returns ``(table, rows_loaded, rows_in)``.

    ``rows_in`` are the rows of the extracts that feed a table (B30; NULL for
    the calendar); both counts are observed by the writes themselves.

    Every load is a full load: surrogate keys are numbered over all rows, so
    a part of the rows can never replace the warehouse.  Tables are written
    parent-before-child; each written table replaces its plan for the tables
    built after it (lineage cut at every table).  With ``control_path`` the
    watermark is advanced after the load succeeded and only if projects were
    extracted (S14), to ``extracted_at`` or the time before the first read.
    The staging folder is removed after a successful load.
    """
    from portacube.streaming.watermark import advance, utc_now
    started = str(extracted_at) if extracted_at else utc_now()
    extracted: dict[str, int] = {}
    with shuffles_removed(spark), sizes_unpacked(spark):
        staged = stage_cascade(spark, src, f"{root}/_staging", parallel_jobs, extracted, as_of=as_of, extracted_at=started)
    previous = spark.conf.get(TB.MATERIALIZE_CONF, None)
    spark.conf.set(TB.MATERIALIZE_CONF, f"{root}/_staging/_materialized")
    try:
        with shuffles_removed(spark), sizes_unpacked(spark):
            counts = _load(spark, staged, root, extend_calendar, parallel_jobs, extracted)
        if control_path is not None and not staged["proyectos"].isEmpty():
            advance(spark, control_path, started)
        staging = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_staging")
        staging.getFileSystem(spark._jsc.hadoopConfiguration()).delete(staging, True)
        return counts
    finally:
        if previous:
            spark.conf.set(TB.MATERIALIZE_CONF, previous)
        else:
            spark.conf.unset(TB.MATERIALIZE_CONF)


def _load(spark: SparkSession, staged: dict[str, DataFrame], root: str, extend_calendar: bool,
          parallel_jobs: int, extracted: dict[str, int]) -> DataFrame:
    w = build_warehouse(staged, extend_calendar=extend_calendar)
    assert sorted(t for level in LOAD_LEVELS for t in level) == sorted(LOAD_ORDER)
    counts: dict[str, int] = {}
    for level in LOAD_LEVELS:
        # Tables of one level depend only on earlier, already materialised levels, so
        # their plans (including dense-id jobs) are built and written concurrently.

        def write(name: str) -> Callable[[], tuple[str, int]]:
            def run() -> tuple[str, int]:
                obs = write_table(w[name], f"{root}/{name}", table=name, compression="zstd")
                return name, int(obs.get.get("rows", 0))
            return run

        counts.update(dict(_run_all([write(n) for n in level], parallel_jobs)))
        for name in level:
            w.materialize(name, spark.read.schema(WAREHOUSE_SCHEMAS[name]).parquet(f"{root}/{name}"))
    rows = [(n, counts[n], sum(extracted[x] for x in FED_BY[n]) if n in FED_BY else None) for n in LOAD_ORDER]
    return spark.createDataFrame(rows, "table string, rows_loaded long, rows_in long")
