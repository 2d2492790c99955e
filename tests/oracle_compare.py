"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    import os

    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"
        elif not os.path.exists(path):
            continue
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.6g}" if abs(v) >= 1e6 else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return _canon(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_canon(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sn, sh, sl = digest(s_cols, s_rows)
    dc, dn, dh, dl = digest(d_cols, d_rows)
    return {"cols_ok": sc == dc, "rows_ok": sn == dn, "hash_ok": sh == dh,
            "spark": (sc, sn), "duck": (dc, dn),
            "diff": (sorted(set(sl) - set(dl))[:5], sorted(set(dl) - set(sl))[:5])}
