"""Registry of the named queries exposed through ``__spark_entry__``.

A query is ``fn(spark, sf_dir) -> DataFrame`` plus, when the operator is
SQL-expressible, an equivalent DuckDB SQL string over the driver's views.
Outputs are canonicalised (doubles rounded to 6 decimals, time keys as
``yyyy-MM-dd HH:mm:ss`` text) on both sides so the engines' last-digit
differences do not count as mismatches.
"""

from __future__ import annotations

from collections import OrderedDict
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: "OrderedDict[str, Callable]" = OrderedDict()
SQL: dict[str, str] = {}
DIGITS = 6
# Rounding keeps about ten significant digits: 6 decimals below 1e3, one
# fewer per decade above. Values are nudged by a relative 1e-12 first so an
# exact decimal tie (common with 2-decimal prices) rounds the same way in
# both engines whatever their last-bit summation differences.
NUDGE = 1.0 + 1e-12
LEVELS = [(1e3, 6), (1e4, 5), (1e5, 4), (1e6, 3), (1e7, 2), (1e8, 1), (1e9, 0),
          (1e10, -1), (1e11, -2)]
# beyond 1e11: ten significant digits via '%.9e' text, parsed back to DOUBLE


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def canon(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round DOUBLE columns and render timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.expr(sig_round_sql(f"CAST(`{f.name}` AS DOUBLE)"))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


def sig_round_sql(v: str) -> str:
    """Spark SQL text of the canonical rounding of double expression ``v``
    (one expression per column keeps plan construction cheap)."""
    x = f"({v} * {NUDGE!r}D)"
    cases = " ".join(f"WHEN abs({v}) < {b:.0e} THEN round({x}, {s})" for b, s in LEVELS)
    # "+ 0.0" turns a rounded -0.0 into 0.0 (DuckDB keeps the sign, Spark not)
    return (f"(CASE WHEN {v} IS NULL THEN CAST(NULL AS DOUBLE) {cases} "
            f"WHEN isnan({v}) OR abs({v}) = double('Infinity') THEN {v} "
            f"ELSE CAST(format_string('%.9e', {x}) AS DOUBLE) END) + 0.0D")


def sig_round(c):
    """Column form for a named column (see :func:`sig_round_sql`)."""
    return F.expr(sig_round_sql(c)) if isinstance(c, str) else c


def r6(expr: str) -> str:
    """SQL-side twin of :func:`sig_round` (a lambda binds the value once)."""
    x = f"v * {NUDGE!r}"
    cases = " ".join(f"WHEN abs(v) < {b:.0e} THEN round({x}, {s})" for b, s in LEVELS)
    body = (f"CASE {cases} WHEN isnan(v) OR isinf(v) THEN v "
            f"ELSE CAST(printf('%.9e', {x}) AS DOUBLE) END")
    return f"list_transform([CAST({expr} AS DOUBLE)], lambda v: ({body}) + 0.0::DOUBLE)[1]"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
