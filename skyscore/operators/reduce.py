"""Reductions over dimensions.

``calculate_reduction`` reduces every value column over the named dims:
``groupBy(remaining dims).agg(...)`` -- partial aggregation map side, one
shuffle of per-group partials, whatever the skew of a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numerics import safe_div
from .conform import area_weight, discover_spatial_dims

KNOWN_DIMS = ("time", "lat", "lon", "level", "site_id", "model", "x", "y")

# --- fixed values: reduction names accepted (A2-A7) ---
REDUCERS = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_pop,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "median": None,  # exact, bucketed: see _medians
    "var": F.var_pop,
    "count": F.count,
    "prod": F.product,
    "product": F.product,
}


def value_columns(df: DataFrame, dims) -> list[str]:
    """A10: every numeric non-dimension column."""
    num = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)
    return [f.name for f in df.schema.fields if f.name not in dims and isinstance(f.dataType, num)]


def calculate_reduction(df: DataFrame, method: str = "mean", dim=None, dims=None, values=None,
                        force_weighted: bool = False) -> DataFrame:
    """A1: reduce ``values`` over ``dim`` (None = every dim -> one row).

    A8/A9: ``mean`` over a lat/lon pair (names containing 'lat'/'lon', or any
    two dims with ``force_weighted``: first = lat) is the cos(lat) weighted
    spatial mean, taken first; the remaining reduced dims are then averaged
    plainly (a second, much smaller groupBy)."""
    dims = list(dims) if dims is not None else [c for c in df.columns if c in KNOWN_DIMS]
    values = list(values) if values is not None else value_columns(df, dims)
    red = list(dims) if dim is None else ([dim] if isinstance(dim, str) else list(dim))
    unknown = [d for d in red if d not in dims]
    if unknown:
        raise ValueError(f"unknown dims {unknown}")
    if method not in REDUCERS:
        raise ValueError(f"Unsupported reduction method: {method}")
    keep = [d for d in dims if d not in red]

    spatial = False
    lat = lon = None
    if method == "mean" and dim is not None:
        if force_weighted:
            spatial = True
            lat, lon = discover_spatial_dims(red)
            lat = lat or red[0]
            lon = lon or (red[1] if len(red) > 1 else red[0])
        else:
            lat, lon = discover_spatial_dims(red)
            spatial = lat is not None and lon is not None

    if not spatial:
        if method == "median":
            return _medians(df, keep, values, {v: v for v in values})
        agg = REDUCERS[method]
        out = df.groupBy(*keep).agg(*[agg(F.col(v)).alias(v) for v in values])
        if method == "count":
            out = out.select(*keep, *[F.col(v).cast("long").alias(v) for v in values])
        return out

    # weighted spatial mean over (lat, lon): sum(w v) / sum(w where v valid)
    rest = [d for d in red if d not in (lat, lon)]
    first_keys = keep + rest
    w = area_weight(lat)
    aggs = []
    for v in values:
        aggs.append(safe_div(F.sum(w * F.col(v)), F.sum(F.when(F.col(v).isNotNull(), w))).alias(v))
    out = df.groupBy(*first_keys).agg(*aggs)
    if rest:
        out = out.groupBy(*keep).agg(*[F.avg(v).alias(v) for v in values])
    return out


def spatial_mean(df: DataFrame, lat: str = "lat", lon: str = "lon", dims=None, values=None) -> DataFrame:
    """Area-weighted spatial mean, keeping every other dim."""
    return calculate_reduction(df, "mean", dim=[lat, lon], dims=dims, values=values, force_weighted=True)


def constant_line(df: DataFrame, axis: DataFrame, var: str) -> DataFrame:
    """A13 without a time dim: the overall mean repeated along ``axis``
    (a scalar subquery, evaluated once)."""
    return axis.withColumn(var, df.agg(F.avg(var)).scalar())


def multi_reduction(df: DataFrame, methods, dim=None, dims=None, values=None) -> DataFrame:
    """Several plain reductions of every value in **one** aggregate; columns
    are named ``{value}_{method}``."""
    dims = list(dims) if dims is not None else [c for c in df.columns if c in KNOWN_DIMS]
    values = list(values) if values is not None else value_columns(df, dims)
    red = list(dims) if dim is None else ([dim] if isinstance(dim, str) else list(dim))
    bad = [m for m in methods if m not in REDUCERS]
    if bad:
        raise ValueError(f"Unsupported reduction method: {bad}")
    keep = [d for d in dims if d not in red]
    aggs = []
    for v in values:
        for m in methods:
            if m == "median":
                continue
            a = REDUCERS[m](F.col(v))
            aggs.append((a.cast("long") if m == "count" else a).alias(f"{v}_{m}"))
    if "median" not in methods:
        return df.groupBy(*keep).agg(*aggs)
    med = _medians(df, keep, values, {v: f"{v}_median" for v in values})
    if not aggs:
        return med
    out = _left_join_keys(df.groupBy(*keep).agg(*aggs), med, keep) if keep else \
        df.agg(*aggs).withColumns({c: med.select(c).scalar() for c in med.columns})
    names = [f"{v}_{m}" for v in values for m in methods]
    return out.select(*keep, *names)


def _medians(df: DataFrame, keep, values, names: dict) -> DataFrame:
    """Exact medians of all ``values`` per group in one pass: the variables
    become rows of one table, with the variable as a further group key of the
    bucketed order statistics (no group is held whole by one task). Groups whose
    values are all NULL keep a NULL median."""
    from .distribution import quantiles
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(v).cast("double").alias("x")) for i, v in enumerate(values)])
    long = df.select(*keep, F.explode(cells).alias("__c")).select(*keep, F.col("__c.i").alias("__i"), F.col("__c.x").alias("__x"))
    m = quantiles(long, "__x", [0.5], by=[*keep, "__i"], prefix="__m")
    found = m.groupBy(*keep).agg(*[F.max(F.when(F.col("__i") == i, F.col("__m50"))).alias(names[v])
                                   for i, v in enumerate(values)])
    return _left_join_keys(df.select(*keep).distinct(), found, keep) if keep else found


def _left_join_keys(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    ren = {k: f"__r_{i}" for i, k in enumerate(keys)}
    r = right.withColumnsRenamed(ren)
    cond = [left[k].eqNullSafe(r[ren[k]]) for k in keys]
    return left.join(r, cond, "left").drop(*ren.values())
