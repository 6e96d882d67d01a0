"""Statistics step (M24-M27): all requested metrics, all groups, one pass.

Plan shape for ``compute_statistics(df, metrics, o, m, by=keys)``::

    scan -> filter(pairwise valid) -> [centre pre-agg by keys -> join back]
         -> HashAggregate(partial) -> Exchange(keys) -> HashAggregate(final)
         -> Project(metric finals)

* Partial aggregation runs map side, so only one row per group and task is
  shuffled; a hot group (a third of all rows) costs no more than any other.
* Centred metrics (ioa_m, d1, e1, ac, IOA) need the group mean first. The
  means are a pre-aggregate with one row per group that is joined back: scalar
  subqueries for the global group, a broadcast for a counted small number of
  groups, otherwise a join on (keys, salt) with the one-row-per-group means
  replicated to every salt. Pairs never meet on the bare group key, so a group
  with a third of all rows is spread over the salts, and since the partial
  aggregates that follow are exchanged anyway AQE may split further.
  No window over an unbounded partition is used.
* Grouping sets (rollup, cube, or any list) repeat a pair once per set under a
  grouping id; the centres of coarse sets are merged from those of the finest.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import Ctx, resolve
from ..functions.numerics import col, pairwise_valid, safe_div
from ..session import materialise

log = logging.getLogger(__name__)


#: replicas of the one-row-per-group values in a salted join
SALTS = 16
#: up to so many groups the values are broadcast
FEW_GROUPS = 50_000
#: a group of more rows is dealt to the salts, where the numbers are known
HOT_ROWS = 1 << 16


def join_group_values(df: DataFrame, small: DataFrame, keys: list[str], salts: int = SALTS,
                      how: str = "inner", rows: str | None = None, few: int = FEW_GROUPS) -> DataFrame:
    """Attach per-group columns of ``small`` (one row per key) to ``df``.

    Null-safe on the keys (a NULL region is a group of its own). Without keys
    ``small`` has exactly one row: its columns become scalar subqueries
    (evaluated once, inlined as constants), no join at all. With keys it is
    written to the shared folder and counted: up to ``few`` groups are
    broadcast; beyond that the rows of a group are dealt to ``salts`` parts by
    their content and partition, and ``small`` is replicated to each, so that
    no group meets in one task (``salts=0``: a plain lazy join, for keys that
    have few rows each). ``rows`` names a column of ``small`` (not attached)
    with the number of a key's rows in ``df``: then only keys of more than
    ``HOT_ROWS`` are dealt and replicated."""
    if not keys:
        return df.withColumns({c: small.select(c).scalar() for c in small.columns})
    ren = {k: f"__key_{i}" for i, k in enumerate(keys)}
    small = small.withColumnsRenamed(ren)
    if not salts:
        return df.join(small, [df[k].eqNullSafe(small[ren[k]]) for k in keys], how).drop(*ren.values())
    small = materialise(small, "groups")
    if small.count() <= few:
        if rows:
            small = small.drop(rows)
        return df.join(F.broadcast(small), [df[k].eqNullSafe(small[ren[k]]) for k in keys], how).drop(*ren.values())
    return salted_join(df, small, keys, list(ren.values()), salts, how, rows)


def salted_join(df: DataFrame, small: DataFrame, keys: list[str], names: list[str], salts: int, how: str,
                rows: str | None = None) -> DataFrame:
    """``df`` joined null-safe to ``small`` (one row per key, its keys called
    ``names``) on (keys, salt). With ``rows`` (see :func:`join_group_values`) a
    key below ``HOT_ROWS`` has the one salt 0; the others are few, and their
    keys are broadcast to tell the rows that are dealt."""
    rest = [c for c, t in df.dtypes if "map<" not in t and t != "variant"]
    dealt = F.pmod(F.xxhash64(*rest) + F.spark_partition_id(), F.lit(salts)).cast("int")
    parts = F.sequence(F.lit(0), F.lit(salts - 1))
    if rows:
        marks = [f"__hot_{i}" for i in range(len(keys))]
        hot = small.where(F.col(rows) > HOT_ROWS).select(*[F.col(n).alias(m) for n, m in zip(names, marks)], F.lit(True).alias("__hot"))
        df = df.join(F.broadcast(hot), [F.col(f"`{k}`").eqNullSafe(F.col(m)) for k, m in zip(keys, marks)], "left").drop(*marks)
        df = df.withColumn("__salt", F.when(F.col("__hot"), dealt).otherwise(0)).drop("__hot")
        parts = F.when(F.col(rows) > HOT_ROWS, parts).otherwise(F.array(F.lit(0)))
    else:
        df = df.withColumn("__salt", dealt)
    small = small.withColumn("__part", F.explode(parts))
    if rows:  # a small file may hold many rows: sorted, never copied whole to a task
        small = small.drop(rows).hint("merge")
    cond = [df[k].eqNullSafe(small[n]) for k, n in zip(keys, names)] + [F.col("__salt") == F.col("__part")]
    return df.join(small, cond, how).drop("__salt", "__part", *names)


def grouping_sets(by: list[str], grouping) -> list[tuple[str, ...]]:
    """The sets of ``'rollup'``, ``'cube'`` or an explicit list."""
    if grouping == "rollup":
        return [tuple(by[:n]) for n in range(len(by), -1, -1)]
    if grouping == "cube":
        return [tuple(k for i, k in enumerate(by) if not mask >> (len(by) - 1 - i) & 1) for mask in range(1 << len(by))]
    unknown = [k for keys in grouping for k in keys if k not in by]
    if unknown:
        raise ValueError(f"not a group column: {unknown}")
    return list(dict.fromkeys(tuple(k for k in by if k in keys) for keys in grouping))


def _in_sets(df: DataFrame, by: list[str], sets: list[tuple[str, ...]]) -> DataFrame:
    """``df`` once per set, the columns that a set leaves out NULL, and
    ``grouping_id``: a bit (first column highest) for each of them."""
    rows = F.array(*[F.struct(F.lit(sum(1 << (len(by) - 1 - i) for i, k in enumerate(by) if k not in keys)).alias("g"),
                              *[(F.col(k) if k in keys else F.lit(None).cast(df.schema[k].dataType)).alias(f"k{i}")
                                for i, k in enumerate(by)]) for keys in sets])
    rest = [c for c in df.columns if c not in by]
    return df.select(F.explode(rows).alias("__set"), *rest).select(
        *[F.col(f"__set.k{i}").alias(k) for i, k in enumerate(by)], F.col("__set.g").alias("grouping_id"), *rest)


def _wasserstein_table(df, obs, mod, by, options):
    from .distribution import wasserstein
    return wasserstein(df, obs, mod, by).withColumnRenamed("wassersteindistance", "__v")


def _fss_table(df, obs, mod, by, options):
    from .distribution import fractions_skill_score
    if "threshold" not in options.get("fss", {}):
        raise ValueError("fss needs options={'fss': {'threshold': ...}}")
    opt = {"lat": "lat", "lon": "lon", "time": "time"} | options["fss"]
    where = [opt[c] for c in ("lat", "lon", "time") if opt[c]]
    v = df.where(pairwise_valid(obs, mod))
    v = v.groupBy(*by, *[c for c in where if c not in by]).agg(F.max(obs).alias("__o"), F.max(mod).alias("__m"))
    return fractions_skill_score(v, v, "__m", "__o", by=by, **opt).withColumnRenamed("fss", "__v")


#: metrics by name that are tables of their own: (pairs, obs, mod, keys, options) -> keys, ``__v``
TABLE_METRICS = {"wassersteindistance": _wasserstein_table, "wasserstein": _wasserstein_table, "fss": _fss_table}


def compute_statistics(df: DataFrame, metrics, obs: str, mod: str, by=(), weights=None,
                       clim=None, regions=None, region_col=None, skip_unknown: bool = False,
                       weighted_fallback_warn: bool = True, grouping=None, options: dict | None = None) -> DataFrame:
    """Return one row per group of ``by`` with one DOUBLE column per metric.

    ``grouping``: ``'rollup'``, ``'cube'`` or a list of column lists gives the
    groups of all those sets at once (per region and model, per region, over
    all, ...), told apart by the column ``grouping_id``.

    ``weights``: column name or Column; metrics without a weighted form fall
    back to the unweighted one with a warning (M8). ``clim``: climatology
    column for ``ac``. ``regions``/``region_col``: restrict to the listed
    labels and group by the label (M25: one groupBy instead of a loop).
    """
    by = list(by)
    if regions is not None:
        if not region_col:
            raise ValueError("regions given but no region column")
        df = df.where(F.col(region_col).isin(list(regions)))
        if region_col not in by:
            by = [region_col] + by
    asked = list(metrics)
    tables = [(m, TABLE_METRICS[m.lower()]) for m in asked if m.lower() in TABLE_METRICS]
    resolved = resolve([m for m in asked if m.lower() not in TABLE_METRICS], skip_unknown=skip_unknown)
    if not resolved and not tables:
        raise ValueError("no metric to compute")
    if tables:
        plain = compute_statistics(df, [raw for raw, _ in resolved] or ["n"], obs, mod, by, weights, clim,
                                   weighted_fallback_warn=weighted_fallback_warn, grouping=grouping)
        keys, data = list(by), df
        if grouping:
            data, keys = _in_sets(df, keys, grouping_sets(keys, grouping)), [*keys, "grouping_id"]
        for raw, fn in dict(tables).items():
            if weights is not None and weighted_fallback_warn:
                log.warning("metric %s has no weighted form; computing it unweighted", raw)
            plain = join_group_values(plain, fn(data, obs, mod, keys, options or {}).withColumnRenamed("__v", raw), keys,
                                      salts=0, how="left")
        return plain.select(*keys, *[m for m in asked if m in plain.columns])
    o, m = col(obs).cast("double"), col(mod).cast("double")
    w = col(weights).cast("double") if weights is not None else None
    c_in = col(clim).cast("double") if clim is not None else None

    base = df.select(*[F.col(k) for k in by],
                     o.alias("__o"), m.alias("__m"),
                     *([w.alias("__w")] if w is not None else []),
                     *([c_in.alias("__c")] if c_in is not None else []))
    base = base.where(pairwise_valid("__o", "__m", "__w" if w is not None else None))

    use_w = w is not None
    plans = []
    needs_centre = False
    for raw, met in resolved:
        if use_w and met.waggs is not None:
            plans.append((raw, met.waggs, met.wfinal, met.dtype))
            needs_centre |= met.wcentred
        else:
            if use_w and weighted_fallback_warn and met.name not in ("n",):
                log.warning("metric %s has no weighted form; computing it unweighted", raw)
            plans.append((raw, met.aggs, met.final, met.dtype))
            needs_centre |= met.centred

    sets = grouping_sets(by, grouping) if grouping else None
    if needs_centre:
        w_or_1 = F.col("__w") if use_w else F.lit(1.0)
        centres = base.groupBy(*by).agg(F.sum(w_or_1 * F.col("__o")).alias("__so"), F.sum(w_or_1 * F.col("__m")).alias("__sm"),
                                        F.sum(w_or_1).alias("__s1"))
    if sets:
        base = _in_sets(base, by, sets)
        if needs_centre:
            centres = _in_sets(centres, by, sets).groupBy(*by, "grouping_id").agg(
                *[F.sum(c).alias(c) for c in ("__so", "__sm", "__s1")])
        by = [*by, "grouping_id"]
    if needs_centre:
        centres = centres.select(*by, safe_div(F.col("__so"), F.col("__s1")).alias("__ob"),
                                 safe_div(F.col("__sm"), F.col("__s1")).alias("__mb"))
        base = join_group_values(base, centres, by)
    ctx = Ctx(o=F.col("__o"), m=F.col("__m"),
              w=F.col("__w") if use_w else None,
              ob=F.col("__ob") if needs_centre else None,
              mb=F.col("__mb") if needs_centre else None,
              c=(F.col("__c") if c_in is not None else (F.col("__ob") if needs_centre else None)))

    partials: dict = {}
    for _, aggs, _, _ in plans:
        for k, v in aggs(ctx).items():
            partials.setdefault(k, v)
    agged = base.groupBy(*by).agg(*[v.alias(k) for k, v in partials.items()])
    return agged.select(*[F.col(k) for k in by],
                        *[fin(F.col).cast(dt).alias(raw) for raw, _, fin, dt in plans])


def statistic_keys(columns, dims=None, dim=None, keep=("model",)) -> list[str]:
    """Group keys = dimension columns minus the reduced ones.

    ``dim`` given -> reduce exactly those; otherwise reduce the discovered
    lat/lon pair only (time is kept) or, without lat/lon, everything. The
    ``model`` key is kept unless ``dim`` names it."""
    from .conform import discover_spatial_dims
    dims = list(dims) if dims is not None else [c for c in columns if c in
                                                ("time", "lat", "lon", "site_id", "level", "model", "x", "y")]
    if dim is not None:
        red = [dim] if isinstance(dim, str) else list(dim)
    else:
        lat, lon = discover_spatial_dims(dims)
        red = [d for d in (lat, lon) if d] if (lat and lon) else [d for d in dims if d not in keep]
    return [d for d in dims if d not in red]


def stats_long(wide: DataFrame, keys, metric_cols) -> DataFrame:
    """Wide (keys + one column per metric) -> long (keys, metric, value)."""
    return wide.unpivot(list(keys), list(metric_cols), "metric", "value")
