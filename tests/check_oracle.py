"""Run named queries against their SQL: python -m tests.check_oracle SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries
from tilecast.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs first, or None: columns, row count, types, then values, all exact."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    got, want = sorted_rows(got), sorted_rows(want)
    for c in got.columns:
        a, b = got[c], want[c]
        if a.dtype != b.dtype:
            return f"{c}: type {a.dtype} vs {b.dtype}"
        unequal = ~((a == b) | (a.isna() & b.isna()))
        if unequal.any():
            i = unequal.idxmax()
            return f"{c}: {unequal.sum()} differ, first {a[i]!r} vs {b[i]!r}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        got = query(spark, sf_dir).toPandas()
        spent = time.time() - start
        if name in sql:
            found = difference(got, con.execute(sql[name]).df())
            bad += found is not None
            print(f"{name}: {len(got)} rows, {spent:.1f}s, {found or 'equal'}", flush=True)
        else:
            print(f"{name}: {len(got)} rows, {spent:.1f}s, no SQL", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
