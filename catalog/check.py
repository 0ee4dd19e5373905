"""Compare registered queries with their SQL: python -m catalog.check [folder] [name part ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

from catalog import CHECKS, QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(os.path.join(folder, "*.parquet"))):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.apply(lambda c: c.map(lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v)).astype(object)


def _sorted_rows(df: pd.DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.itertuples(index=False)), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, sql_df: pd.DataFrame, kinds: dict[str, str]) -> str | None:
    """None when rows and columns agree, else what differs first."""
    got = spark_df.toPandas()
    if sorted(got.columns) != sorted(sql_df.columns):
        return f"columns {sorted(got.columns)} / {sorted(sql_df.columns)}"
    have = dict(spark_df.dtypes)
    pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
             "timestamp_ntz": "TIMESTAMP"}
    wrong = {c: (have[c], kinds[c]) for c in have if pairs.get(have[c], "") != kinds[c] and not kinds[c].startswith("TIMESTAMP")}
    if wrong:
        return f"types {wrong}"
    a, b = _sorted_rows(_canonical(got)), _sorted_rows(_canonical(sql_df))
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if tuple(map(str, x)) != tuple(map(str, y)):
            return f"{sum(tuple(map(str, x)) != tuple(map(str, y)) for x, y in zip(a, b))} rows, e.g.\n   {x}\n   {y}"
    return None


def check(spark, con, folder: str, name: str) -> str | None:
    df = QUERIES[name](spark, folder)
    if name not in CHECKS:
        return None if df.toPandas() is not None else "no rows"
    relation = con.sql(CHECKS[name])
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    return differences(df, relation.df(), kinds)


def main() -> int:
    from plumbline.session import local_session
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(folder)
    bad = 0
    for name in QUERIES:
        if len(sys.argv) > 2 and not any(name.startswith(part) for part in sys.argv[2:]):
            continue
        started = time.time()
        try:
            found = check(spark, con, folder, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        kind = "sql " if name in CHECKS else "rows"
        print(f"{'ok ' if found is None else 'BAD'} {kind} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
