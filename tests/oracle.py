"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver check:
column names sorted, row count, order-insensitive value hash)."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("|".join(r).encode())
    return h.hexdigest()


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    srows, scols = rows_of(s_cols, s_rows)
    drows, dcols = rows_of(d_cols, d_rows)
    return {
        "columns": scols == dcols, "spark_cols": scols, "duck_cols": dcols,
        "rows": (len(srows), len(drows)),
        "hash": digest(srows) == digest(drows),
        "first_diff": next(((a, b) for a, b in zip(srows, drows) if a != b), None),
    }
