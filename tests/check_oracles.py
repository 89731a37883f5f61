"""Run registered queries next to their DuckDB oracles and compare whole results.

Usage: python tests/check_oracles.py [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as contract
from ementario.plans.bindings import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as comparable text, rows sorted."""

    def text(v: object) -> str:
        if isinstance(v, (list, tuple, np.ndarray)):
            return "[" + ",".join(map(text, v)) + "]"
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return "\0null"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)):
            return f"{float(v):.6f}"
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return str(v)

    out = pd.DataFrame({c: pdf[c].astype(object).map(text) for c in sorted(pdf.columns)})
    return out.sort_values(list(out.columns), ignore_index=True)


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else what differs first."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        bad = np.nonzero((a[c] != b[c]).to_numpy())[0]
        if len(bad):
            i = bad[0]
            return f"{len(bad)} rows differ, first in {c}: {a.iloc[i].to_dict()} vs {b.iloc[i].to_dict()}"[:1500]
    return None


def main() -> int:
    from ementario.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, fn in contract.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            sql = contract.oracle_sql().get(name)
            problem = compare(got, con.execute(sql).df()) if sql else None
            status = "FAIL " + problem if problem else ("ok" if sql else "ok (rows only)")
        except Exception as err:  # noqa: BLE001
            took = time.time() - start
            status = "ERROR " + str(err)[:1500]
            traceback.print_exc(limit=-3)
            got = []
        failed += not status.startswith("ok")
        print(f"{name:28s} {took:6.2f}s {len(got):7d} rows  {status}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
