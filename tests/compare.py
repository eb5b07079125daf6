"""Spark-vs-DuckDB result comparison (row count, column names, values).

Usable from tests and as a script:
    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pitwall.sources.derived import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None) if v.tzinfo else v
    return v


def frame(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(x) for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, tol: float = 1e-4) -> str | None:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"row count differs: spark {len(spark_pdf)} vs duckdb {len(duck_pdf)}"
    a, b = frame(spark_pdf), frame(duck_pdf)
    for i, (ra, rb) in enumerate(zip(a, b)):
        for x, y in zip(ra, rb):
            if x is None or y is None:
                if x is not y and not (x is None and y is None):
                    return f"row {i}: {ra} vs {rb}"
                continue
            if isinstance(x, float) or isinstance(y, float):
                if abs(float(x) - float(y)) > tol:
                    return f"row {i}: {ra} vs {rb}"
            elif x != y:
                return f"row {i}: {ra} vs {rb}"
    return None


def run(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            spdf = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # report and go on with the next query
            out[name] = (f"FAIL spark error: {str(e).splitlines()[0][:300]}", 0, time.time() - t0)
            if verbose:
                print(f"{name:32s} {out[name][0]}", flush=True)
            continue
        t1 = time.time()
        if name not in sql:
            out[name] = ("rows-only", len(spdf), t1 - t0)
        else:
            try:
                dpdf = con.sql(sql[name]).df()
                err = compare(spdf, dpdf)
            except Exception as e:
                err = f"duckdb error: {str(e).splitlines()[0][:300]}"
            out[name] = ("OK" if err is None else f"FAIL {err}", len(spdf), t1 - t0)
        if verbose:
            print(f"{name:32s} {out[name][0][:300]}  rows={out[name][1]}  {out[name][2]:.1f}s", flush=True)
    return out


if __name__ == "__main__":
    from pitwall.config import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session("compare", checkpoint_dir="/tmp/checkpoints")
    res = run(spark, sf, names)
    bad = [k for k, v in res.items() if v[0].startswith("FAIL")]
    print("FAILED:", bad if bad else "none")
