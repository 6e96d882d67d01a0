"""Null / NaN / division policy shared by every operator.

* Missing values are SQL ``NULL``; NaN and +-inf in value columns are turned
  into ``NULL`` at ingest (:func:`nan_to_null`) because Spark aggregates
  propagate NaN while the verification semantics skip missing values.
* ANSI mode is on, so ``x / 0`` raises: every ratio goes through
  :func:`safe_div`, which yields ``NULL`` for a zero or missing denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(is_finite(c), c)


def nan_to_null_all(df: DataFrame, columns) -> DataFrame:
    """Replace NaN/inf with NULL in the named value columns (one projection)."""
    return df.withColumns({c: nan_to_null(c).cast("double") for c in columns})


def safe_div(num, den) -> Column:
    """``num / den`` or NULL when ``den`` is zero or NULL (never raises)."""
    num, den = col(num), col(den)
    return F.when(den != 0, num / den)


def clip(c, lo=None, hi=None) -> Column:
    c = col(c)
    if lo is not None:
        c = F.when(c < lo, F.lit(lo)).otherwise(c)
    if hi is not None:
        c = F.when(c > hi, F.lit(hi)).otherwise(c)
    return c


def pairwise_valid(obs, mod, weight=None) -> Column:
    """both members of the pair (and the weight, if any) are finite."""
    cond = is_finite(obs) & is_finite(mod)
    if weight is not None:
        cond = cond & is_finite(weight)
    return cond
