"""Compare a Spark DataFrame with DuckDB SQL over the same Parquet tables (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_CONS: dict[str, duckdb.DuckDBPyConnection] = {}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    if sf_dir not in _CONS:
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
        _CONS[sf_dir] = con
    return _CONS[sf_dir]


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, float):
        if v != v:
            return "NaN"
        return f"{round(v, 9):.9f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 9):.9f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _kind(t: str) -> str:
    t = t.lower()
    if t.startswith("decimal"):
        return "decimal"
    if t in ("double", "float", "real"):
        return "float"
    if t in ("int", "integer", "bigint", "smallint", "tinyint", "hugeint", "long", "ubigint"):
        return "int"
    if t in ("string", "varchar"):
        return "string"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_canon(r[c]) for c in cols) for r in df.collect()]


def compare(df, sql: str, sf_dir: str, check_types: bool = True):
    """Return (ok, message)."""
    con = duck(sf_dir)
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    dtypes = {c: _kind(str(t)) for c, t in zip(dcols, rel.types)}
    scols, srows = rows_of_spark(df)
    stypes = {c: _kind(t) for c, t in df.dtypes}
    if sorted(dcols) != scols:
        return False, f"columns differ: spark-only {set(scols) - set(dcols)}, duck-only {set(dcols) - set(scols)}"
    if check_types:
        bad = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
        if bad:
            return False, f"types differ: {bad}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(_canon(r[i]) for i in order) for r in drows]
    if len(drows) != len(srows):
        return False, f"row counts differ: spark {len(srows)} duck {len(drows)}"
    cs, cd = Counter(srows), Counter(drows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ ({sum((cs - cd).values())} rows); cols={scols}\n spark: {only_s}\n duck: {only_d}"
    return True, f"{len(srows)} rows equal"
