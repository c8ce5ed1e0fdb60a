"""Run a Spark result and a DuckDB oracle SQL side by side and diff them.

Mirrors the driver's gate: row count, column names, order-insensitive values.
Values are compared exactly (Decimal by value, floats bit-for-bit unless a
tolerance is given) so that a pass here means the hashes will agree.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os

import duckdb

from ledgerlake.sources.adapters import DRIVER_TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v, float_digits=None):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        if math.isnan(v):
            return "<nan>"
        if float_digits is not None:
            return repr(round(v, float_digits))
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return "D" + format(v.normalize(), "f") if v == v else "<nan>"
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x, float_digits) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def compare(spark_df, con, sql: str, float_digits=None, show=5):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    msgs = []
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted(tuple(_canon(r[i], float_digits) for i in order) for r in s_rows)
    d_norm = sorted(tuple(_canon(r[d_index[s_cols[i]]], float_digits) for i in order) for r in d_rows)
    if len(s_norm) != len(d_norm):
        msgs.append(f"row count spark={len(s_norm)} duck={len(d_norm)}")
    if s_norm != d_norm:
        s_set, d_set = set(s_norm), set(d_norm)
        only_s = [r for r in s_norm if r not in d_set][:show]
        only_d = [r for r in d_norm if r not in s_set][:show]
        cols = [s_cols[i] for i in order]
        msgs.append(f"values differ; cols={cols}\n  spark-only: {only_s}\n  duck-only: {only_d}")
        return False, "; ".join(msgs)
    return True, f"ok rows={len(s_norm)}"
