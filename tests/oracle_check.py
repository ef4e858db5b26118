"""Run registered queries on Spark and their SQL oracles on DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows (spark/oracle), column match, exact and
rounded (1e-9 relative) value-multiset match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v, rounded: bool):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if rounded:
            return float(f"{v:.9g}")
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), rounded)
    return v


def _bag(rows, cols, order, rounded):
    idx = [cols.index(c) for c in order]
    out = [tuple(_norm(r[i], rounded) for i in idx) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck_conn(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def check(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_conn(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            ts = time.time() - t0
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e)[:300])
            if verbose:
                print(f"{name:28s} SPARK ERROR {str(e)[:300]}", flush=True)
            continue
        if name not in sqls:
            results[name] = ("no-oracle", len(srows))
            if verbose:
                print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(sqls[name])
            ocols = [d[0] for d in rel.description]
            orows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("oracle-error", str(e)[:300])
            if verbose:
                print(f"{name:28s} ORACLE ERROR {str(e)[:300]}", flush=True)
            continue
        same_cols = sorted(scols) == sorted(ocols)
        order = sorted(scols)
        exact = rnd = False
        if same_cols and len(srows) == len(orows):
            exact = _bag(srows, scols, order, False) == _bag(orows, ocols, order, False)
            rnd = exact or _bag(srows, scols, order, True) == _bag(orows, ocols, order, True)
        results[name] = ("ok" if exact else ("rounded" if rnd else "MISMATCH"), len(srows), len(orows), same_cols)
        if verbose:
            print(f"{name:28s} rows={len(srows)}/{len(orows)} cols={'ok' if same_cols else 'DIFF'} "
                  f"exact={exact} rounded={rnd} {ts:.1f}s", flush=True)
            if not same_cols:
                print("   spark :", sorted(scols), "\n   oracle:", sorted(ocols))
    return results


if __name__ == "__main__":
    from portacube.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    check(spark, sf, sys.argv[2:] or None)
