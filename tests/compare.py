"""Run queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def kind(dtype) -> str:
    text = str(dtype).lower()
    for k in ("bool", "datetime"):
        if k in text:
            return k
    return "int" if "int" in text else "float" if "float" in text else "object"


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].dt.tz_localize(None).astype("datetime64[us]")
    return df


def rows(df: pd.DataFrame) -> list[tuple]:
    out = []
    for r in df.itertuples(index=False):
        out.append(tuple("∅" if v is None or v is pd.NaT or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r))
    return sorted(out)


def differences(spark_df, con, sql: str) -> list[str]:
    got, want = normal(spark_df.toPandas()), normal(con.execute(sql).df())
    if list(got.columns) != list(want.columns):
        return [f"columns {list(got.columns)} vs {list(want.columns)}"]
    problems = []
    for c in got.columns:
        a, b = kind(got[c].dtype), kind(want[c].dtype)
        if a != b:
            problems.append(f"type of {c}: {got[c].dtype} vs {want[c].dtype}")
            if {a, b} == {"int", "float"}:
                got[c], want[c] = got[c].astype("float64"), want[c].astype("float64")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} vs {len(want)}")
        return problems
    a, b = rows(got), rows(want)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}")
    return problems


if __name__ == "__main__":
    from churnwright.plans import ORACLE, QUERIES
    from churnwright.session import local_session

    folder = sys.argv[1]
    only = sys.argv[2].split(",") if len(sys.argv) > 2 and sys.argv[2] else []
    spark = local_session("8")
    if len(sys.argv) > 3:
        spark.conf.set("churnwright.rowsPerChunk", sys.argv[3])
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for key, fn in QUERIES.items():
        if only and not any(key.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if key in ORACLE:
                problems = differences(df, con, ORACLE[key])
                n = ""
            else:
                n, problems = f"rows-only {len(df.toPandas())}", []
        except Exception as e:  # noqa: BLE001
            n, problems = "", [f"{type(e).__name__}: {str(e)[:700]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {time.time() - start:6.1f}s {key} {n} {'; '.join(problems)}", flush=True)
    print("failed:", failed)
