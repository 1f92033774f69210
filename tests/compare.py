"""Run a registered query on Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

from ledgerguard.plans import queries  # noqa: F401
from ledgerguard.plans.registry import ORACLE, QUERIES


def connect(sf: str):
    con = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    return str(v)


def spark_rows(spark, name, sf, plans=None):
    df = QUERIES[name](spark, sf)
    if plans is not None:
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in df.collect()]
    return sorted(df.columns), rows


def oracle_rows(con, name):
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), [tuple(_cell(r[i]) for i in order) for r in cur.fetchall()]


def differences(spark, con, name, sf, plans=None):
    """None if both give the same rows, else a short description."""
    columns, got = spark_rows(spark, name, sf, plans)
    wanted_columns, wanted = oracle_rows(con, name)
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    extra, missing = Counter(got) - Counter(wanted), Counter(wanted) - Counter(got)
    if extra or missing:
        return (f"{len(got)} rows against {len(wanted)}; only Spark {list(extra)[:3]}; "
                f"only SQL {list(missing)[:3]}; columns {columns}")
    return None
