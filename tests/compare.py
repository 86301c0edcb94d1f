"""Run a registered plan on Spark and its oracle SQL on DuckDB over the same parquet files, and compare.

Usage: python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype) -> str:
    s = str(dtype)
    if s.startswith(("int", "Int", "uint")):
        return "int"
    if s.startswith(("float", "Float")):
        return "float"
    if s.startswith("bool"):
        return "bool"
    if s.startswith("datetime"):
        return "datetime"
    return "object"


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (np.floating, float)):
        f = round(float(v), 6)
        return int(f) if f.is_integer() and abs(f) < 2**53 else f
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def frame_rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> list[str]:
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return [f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"]
    for c in spark_pdf.columns:
        a, b = _kind(spark_pdf[c].dtype), _kind(duck_pdf[c].dtype)
        # Spark turns a nullable integer column into float64 in pandas; DuckDB keeps a nullable integer
        nullable_int = {a, b} == {"int", "float"} and spark_pdf[c].isna().any()
        if a != b and not nullable_int and not (spark_pdf[c].isna().all() or duck_pdf[c].isna().all()):
            problems.append(f"dtype {c}: spark {spark_pdf[c].dtype} duck {duck_pdf[c].dtype}")
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"rows: spark {len(spark_pdf)} duck {len(duck_pdf)}")
        return problems
    ra, rb = frame_rows(spark_pdf), frame_rows(duck_pdf)
    bad = [(x, y) for x, y in zip(ra, rb) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. spark {bad[0][0]} duck {bad[0][1]}")
    return problems


def run(names=None, sf_dir="/root/testdata/sf0.01", verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from tablesmith import get_spark
    spark = get_spark()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = [f"spark error: {type(e).__name__}: {str(e)[:400]}"]
            print(name, results[name]) if verbose else None
            continue
        t1 = time.time()
        if name not in sqls:
            results[name] = []
            if verbose:
                print(f"{name}: rows-only ({len(sp)} rows) spark {t1 - t0:.1f}s")
            continue
        try:
            dk = con.execute(sqls[name]).fetchdf()
        except Exception as e:  # noqa: BLE001
            results[name] = [f"duckdb error: {str(e)[:400]}"]
            print(name, results[name]) if verbose else None
            continue
        results[name] = compare(sp, dk)
        if verbose:
            status = "OK" if not results[name] else "FAIL " + "; ".join(results[name])
            print(f"{name}: {status} ({len(sp)} rows) spark {t1 - t0:.1f}s")
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    res = run(args or None, sf)
    bad = {k: v for k, v in res.items() if v}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
