"""Benchmark: the warehouse build and the analytic queries at one scale factor.

Workload (the original system's shape): extract + transform the operational
tables and write the ten warehouse tables (Parquet), then run the views,
OLAP dataset, cubes, KPIs and audits against the *written* warehouse.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Prints one JSON line; per-query values are medians in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    from pyspark.sql import DataFrame

    from portacube.operators.cube import kpi_cube
    from portacube.plans import cubes as P
    from portacube.plans import kpis as K
    from portacube.plans import quality as Q
    from portacube.plans.pipeline import build_and_load
    from portacube.plans.views import (olap_dataset, vista_asignaciones_completa, vista_hitos_tareas,
                                       vista_proyectos_completa)
    from portacube.session import build_session
    from portacube.sources.binding import bind_sources
    from portacube.sources.readers import read_warehouse

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    scratch = tempfile.mkdtemp(prefix="portacube-bench-")

    def drain(df: DataFrame) -> None:
        # full evaluation without collecting: a no-op sink
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        fn()  # warm-up
        vals = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            vals.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(vals), 3)

    counter = {"i": 0}

    def etl() -> None:
        counter["i"] += 1
        src = bind_sources(spark, sf_dir)
        build_and_load(spark, src, f"{scratch}/wh{counter['i']}", as_of="2024-01-01",
                       extracted_at="2024-01-01 00:00:00", extend_calendar=False)

    timed("etl_build_warehouse", etl)
    wh = read_warehouse(spark, f"{scratch}/wh{counter['i']}")
    olap = olap_dataset(vista_proyectos_completa(wh)).cache()
    drain(olap)
    cube = kpi_cube(olap)

    queries = {
        "view_projects": lambda: drain(vista_proyectos_completa(wh)),
        "view_assignments": lambda: drain(vista_asignaciones_completa(wh)),
        "view_milestone_tasks": lambda: drain(vista_hitos_tareas(wh)),
        "olap_dataset": lambda: drain(olap_dataset(vista_proyectos_completa(wh))),
        "cube_base": lambda: drain(cube.base()),
        "cube_rollup": lambda: drain(cube.roll_up("PeriodoInicio", ["PeriodoInicio", "AnioInicio", "TOTAL"])),
        "cube_pivot": lambda: drain(cube.pivot(["Estado"], ["CategoriaPresupuesto"], "Presupuesto", "mean")),
        "cubes_p1": lambda: drain(P.cube_base(olap)),
        "cubes_p3": lambda: drain(P.cube_financial(olap)),
        "cubes_p6": lambda: drain(P.cube_executive(olap)),
        "cubes_p8": lambda: drain(P.cube_kpis_main(olap)),
        "kpi_table_a": lambda: drain(K.kpi_table(olap, wh["hechos_asignaciones"], "A")),
        "kpi_by_client": lambda: drain(K.kpis_by_client(olap)),
        # without the cached dataset: the view joins are part of the time
        "kpi_by_client_uncached": lambda: drain(K.kpis_by_client(olap_dataset(vista_proyectos_completa(wh)))),
        "cubes_p1_uncached": lambda: drain(P.cube_base(olap_dataset(vista_proyectos_completa(wh)))),
        "quality_fk": lambda: drain(Q.fk_audit(wh)),
        "quality_pk": lambda: drain(Q.pk_audit(wh)),
    }
    for name, fn in queries.items():
        timed(name, fn)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec", "queries": timings,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus, "runs": runs,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
