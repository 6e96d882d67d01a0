"""Tables behind the diagnostic plots (V1-V12); no rendering.

Every function returns a small aggregated DataFrame whose size is bounded by
the number of sites / cells / bins, never by the number of pairs. Small
multiples (V12) are the ``by`` keys every function accepts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numerics import pairwise_valid, safe_div
from .stats import compute_statistics


def _long_models(df: DataFrame, obs: str, mods, by, model_col: str = "model") -> DataFrame:
    """Pairs of (obs, each model column) as rows keyed by ``model`` (Expand,
    no shuffle)."""
    mods = [mods] if isinstance(mods, str) else list(mods)
    keep = [*by, obs]
    return (df.select(*keep, *mods)
              .unpivot(keep, mods, model_col, "__mod"))


def radar_table(df: DataFrame, obs: str, mods, by=(), metrics=("ioa_radar", "kge", "ccc")) -> DataFrame:
    """V7: IOA / KGE / CCC per model column."""
    by = list(by)
    long = _long_models(df, obs, mods, by)
    return compute_statistics(long, list(metrics), obs, "__mod", by=[*by, "model"])


def spatial_bias(df: DataFrame, obs: str, mod: str, site=("lat", "lon"), by=()) -> DataFrame:
    """V1: time mean of each variable per site, then bias = mean(m) - mean(o)
    (mean of each, not mean of the pair differences)."""
    keys = [*by, *([site] if isinstance(site, str) else site)]
    return (df.groupBy(*keys)
              .agg(F.avg(obs).alias("obs_mean"), F.avg(mod).alias("mod_mean"))
              .withColumn("bias", F.col("mod_mean") - F.col("obs_mean")))


def spatial_mean(df: DataFrame, var, cell=("lat", "lon"), by=()) -> DataFrame:
    """Time mean per cell or station (NULLs skipped)."""
    var = [var] if isinstance(var, str) else list(var)
    return df.groupBy(*by, *cell).agg(*[F.avg(v).alias(v) for v in var])


def timeseries(df: DataFrame, columns, time: str = "time", spatial_mean: bool = True,
               by=()) -> DataFrame:
    """Long (time, label, value) series. ``columns`` is a list of
    names or a dict name -> label (or name -> {'label': ...})."""
    if isinstance(columns, dict):
        labels = {k: (v.get("label", k) if isinstance(v, dict) else v) for k, v in columns.items()}
    else:
        labels = {c: c for c in columns}
    names = list(labels)
    src = df.groupBy(*by, time).agg(*[F.avg(c).alias(c) for c in names]) if spatial_mean else \
        df.select(*by, time, *names)
    long = src.unpivot([*by, time], names, "variable", "value")
    lab = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return long.withColumn("label", lab[F.col("variable")])


def overlay_lines(df: DataFrame, x: str, var: str) -> DataFrame:
    """Mean over every non-``x`` dim per ``x`` value."""
    return df.groupBy(x).agg(F.avg(var).alias(var))


def scatter_density(df: DataFrame, obs: str, mod: str, bins: int = 50, lo=None, hi=None,
                    by=()) -> DataFrame:
    """V4 at scale: 2-D histogram of (obs, model) with ``bins`` x ``bins``
    equal-width cells between ``lo`` and ``hi`` (global min/max of both
    when omitted, taken from a one-row aggregate as scalar subqueries).
    With a given range, values below it are counted in bin -1 and values above
    it in bin ``bins``."""
    v = df.where(pairwise_valid(obs, mod))
    if lo is None or hi is None:
        rng = v.agg(F.least(F.min(obs), F.min(mod)).alias("__lo"),
                    F.greatest(F.max(obs), F.max(mod)).alias("__hi"))
        lo_c, hi_c = rng.select("__lo").scalar(), rng.select("__hi").scalar()
    else:
        lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
    width = (hi_c - lo_c) / bins

    def b(c):
        i = F.floor(safe_div(F.col(c) - lo_c, width))
        return (F.when(F.col(c) < lo_c, -1).when(F.col(c) > hi_c, bins)
                .otherwise(F.least(F.coalesce(i, F.lit(0)), F.lit(bins - 1))).cast("int"))
    return (v.select(*by, b(obs).alias("obs_bin"), b(mod).alias("mod_bin"))
              .groupBy(*by, "obs_bin", "mod_bin").agg(F.count(F.lit(1)).alias("n")))


def conditional_quantile(df: DataFrame, obs: str, mod: str, bins: int = 10, lo: float = 0.0,
                         hi: float = 1.0, quantiles=(0.1, 0.25, 0.5, 0.75, 0.9),
                         condition_on: str = "model", by=(), exact: bool = True) -> DataFrame:
    """V5: quantiles of the obs per model bin (or of the model per obs bin).

    Bins: 0 below ``lo``, 1..bins of equal width, bins+1 at or above ``hi``.
    ``exact=True`` uses :func:`distribution.quantiles` (exact, bucketed, no
    bin held in one task); ``exact=False`` uses ``percentile_approx``."""
    from .distribution import percent_name
    cond, target = (mod, obs) if condition_on == "model" else (obs, mod)
    v = df.where(pairwise_valid(obs, mod))
    width = (hi - lo) / bins
    c = F.col(cond)
    bin_ = (F.when(c < lo, F.lit(0)).when(c >= hi, F.lit(bins + 1))
             .otherwise(F.floor((c - lo) / width).cast("int") + 1))
    binned = v.select(*by, F.col(target).alias("__t"), bin_.alias("bin"))
    qs = list(quantiles)
    names = [f"q{percent_name(float(x))}" for x in qs]
    counts = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    if exact:
        from .distribution import quantiles as exact_quantiles
        from .stats import join_group_values
        q = exact_quantiles(binned, "__t", qs, by=[*by, "bin"])
        out = join_group_values(counts, q, [*by, "bin"], salts=0)
    else:
        agg = F.percentile_approx("__t", F.array(*[F.lit(x) for x in qs]), 10000)
        out = binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), agg.alias("__q"))
        out = out.select(*by, "bin", "n",
                         *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    out = out.withColumn("bin_lo", F.lit(lo) + (F.col("bin") - 1) * width)
    return out.select(*by, "bin", "bin_lo", "n", *names)


def taylor(df: DataFrame, obs: str, mod: str, by=()) -> DataFrame:
    """V6: population std of each series, Pearson r and the centred RMS
    difference (single aggregate)."""
    v = df.where(pairwise_valid(obs, mod))
    a = v.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                           F.stddev_pop(obs).alias("std_obs"), F.stddev_pop(mod).alias("std_mod"),
                           F.covar_pop(obs, mod).alias("__cov"))
    r = F.when((F.col("std_obs") > 0) & (F.col("std_mod") > 0),
               F.col("__cov") / (F.col("std_obs") * F.col("std_mod")))
    return (a.withColumn("corr", r)
             .withColumn("std_ratio", safe_div(F.col("std_mod"), F.col("std_obs")))
             .withColumn("crmsd", F.sqrt(F.greatest(F.lit(0.0),
                         F.col("std_obs") ** 2 + F.col("std_mod") ** 2
                         - 2 * F.col("std_obs") * F.col("std_mod") * F.coalesce(F.col("corr"), F.lit(0.0)))))
             .drop("__cov"))


def goal_criteria(df: DataFrame, obs: str, mod: str, label_col: str, bias_goal: float,
                  error_goal: float, bias_criteria: float, error_criteria: float) -> DataFrame:
    """Per label mean fractional bias / error against goal and criteria
    thresholds (booleans)."""
    v = df.where(pairwise_valid(obs, mod))
    s = F.col(mod) + F.col(obs)
    fb = safe_div(2 * (F.col(mod) - F.col(obs)), s)
    fe = safe_div(2 * F.abs(F.col(mod) - F.col(obs)), s)
    a = v.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"),
                                 (100 * F.avg(fb)).alias("mfb"), (100 * F.avg(fe)).alias("mfe"))
    return a.select(label_col, "n", "mfb", "mfe",
                    ((F.abs("mfb") <= bias_goal) & (F.col("mfe") <= error_goal)).alias("meets_goal"),
                    ((F.abs("mfb") <= bias_criteria) & (F.col("mfe") <= error_criteria)).alias("meets_criteria"))


def wind_rose(df: DataFrame, u: str, v: str, sectors: int = 16, speed_edges=(0.5, 2, 4, 6, 8, 10),
              by=()) -> DataFrame:
    """Counts by direction sector x speed class. Direction is where the
    wind comes from, degrees clockwise from north."""
    spd = F.sqrt(F.col(u) * F.col(u) + F.col(v) * F.col(v))
    direction = F.pmod(F.degrees(F.atan2(-F.col(u), -F.col(v))), F.lit(360.0))
    width = 360.0 / sectors
    sector = F.pmod(F.floor((direction + width / 2) / width), F.lit(sectors)).cast("int")
    cls = F.lit(0)
    for e in speed_edges:
        cls = cls + F.when(spd >= e, 1).otherwise(0)
    return (df.where(F.col(u).isNotNull() & F.col(v).isNotNull())
              .select(*by, sector.alias("sector"), cls.alias("speed_class"))
              .groupBy(*by, "sector", "speed_class").agg(F.count(F.lit(1)).alias("n")))
