"""Run registered queries beside their SQL and compare the rows.

    python tests/oracle_check.py [folder] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return float(v)
    if isinstance(v, (float, np.floating)):
        return float(v)
    return v


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in r) for r in frame.astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty if equal, else what differs."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    a, b = rows_of(mine), rows_of(theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if not bad:
        return ""
    near = all(
        u == v or (isinstance(u, float) and isinstance(v, float) and abs(u - v) <= 1e-4 * max(1, abs(u))) for x, y in bad for u, v in zip(x, y))
    return f"{len(bad)} of {len(a)} rows differ{' (only in the last digits)' if near else ''}; first {bad[0]}"


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    from __spark_entry__ import oracle_sql, queries

    qs, os_ = queries(), oracle_sql()
    spark, con = session(), connect(folder)
    failed = 0
    for key in args or qs:
        start = time.time()
        try:
            mine = qs[key](spark, folder).toPandas()
            took = time.time() - start
            start = time.time()
            if key in os_:
                theirs = con.execute(os_[key]).df()
                sqltime = time.time() - start
                verdict = compare(mine, theirs)
            else:
                verdict, sqltime = "", 0.0
        except Exception as e:  # noqa: BLE001
            verdict, took, sqltime = f"ERROR {type(e).__name__} {str(e)[:600]}", time.time() - start, 0.0
            mine = []
        failed += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok  '} {key:28s} {len(mine):8d} rows {took:6.1f}s sql {sqltime:5.1f}s {'' if key in os_ else 'rows only '}{verdict}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
