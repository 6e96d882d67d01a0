"""Registered plot-table queries (V1-V11, P17-P18) and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairing as pr
from ..operators import plotdata as pdx
from ..operators.conform import align_pressure_units, summary_title, time_range_text
from ..operators.profile import interp_to_pressure, profile_mean
from . import testbed as tb
from .pairing_queries import NEAREST_SQL_CTES
from .registry import canon, query, r6, ts


def _nearest(spark, sf_dir):
    grid = tb.model_grid(spark, sf_dir)
    return pr.pair_nearest(grid, tb.station_obs(spark, sf_dir), "v", axes=tb.axes10(grid))


@query("plot_spatial_bias", f"""WITH {NEAREST_SQL_CTES}
SELECT site_id, {r6('lat')} AS lat, {r6('lon')} AS lon, {r6('avg(obs)')} AS obs_mean, {r6('avg(v)')} AS mod_mean,
       {r6('avg(v) - avg(obs)')} AS bias
FROM nearest GROUP BY site_id, lat, lon""")
def plot_spatial_bias(spark, sf_dir):
    """V1: per-site time means and their difference (spatial bias scatter)."""
    return canon(pdx.spatial_bias(_nearest(spark, sf_dir), "obs", "v", site=("site_id", "lat", "lon")))


@query("plot_spatial_mean", f"""WITH {tb.GRID_SQL}
SELECT {r6('lat')} AS lat, {r6('lon')} AS lon, {r6('avg(v)')} AS v FROM grid GROUP BY lat, lon""")
def plot_spatial_mean(spark, sf_dir):
    """Time mean per grid cell."""
    return canon(pdx.spatial_mean(tb.model_grid(spark, sf_dir), "v"))


@query("plot_timeseries", f"""WITH {NEAREST_SQL_CTES},
s AS (SELECT time, avg(obs) AS obs, avg(v) AS v FROM nearest GROUP BY time)
SELECT {ts('time')} AS time, 'obs' AS variable, {r6('obs')} AS value, 'Stations' AS label FROM s
UNION ALL
SELECT {ts('time')} AS time, 'v' AS variable, {r6('v')} AS value, 'Model' AS label FROM s""")
def plot_timeseries(spark, sf_dir):
    """Spatial-mean series per variable with display labels (long form)."""
    return canon(pdx.timeseries(_nearest(spark, sf_dir), {"obs": {"label": "Stations"}, "v": "Model"}))


@query("plot_scatter_density", f"""WITH {tb.PAIRS_SQL},
rg AS (SELECT least(min(o), min(m)) AS lo, greatest(max(o), max(m)) AS hi FROM pairs),
b AS (SELECT
  CAST(least(greatest(coalesce(floor((o - lo) / ((hi - lo) / 20)), 0), 0), 19) AS INTEGER) AS obs_bin,
  CAST(least(greatest(coalesce(floor((m - lo) / ((hi - lo) / 20)), 0), 0), 19) AS INTEGER) AS mod_bin
  FROM pairs, rg)
SELECT obs_bin, mod_bin, count(*) AS n FROM b GROUP BY 1, 2""")
def plot_scatter_density(spark, sf_dir):
    """V4 at scale: 20x20 density of (obs, model) instead of every point."""
    return canon(pdx.scatter_density(tb.pairs(spark, sf_dir), "o", "m", bins=20))


@query("plot_conditional_quantile", f"""WITH {tb.EVENTS_SQL},
b AS (SELECT o, CASE WHEN m < 0.0 THEN 0 WHEN m >= 100.0 THEN 11
                     ELSE CAST(floor((m - 0.0) / 10.0) AS INTEGER) + 1 END AS bin FROM ev)
SELECT bin, {r6('0.0 + (bin - 1) * 10.0')} AS bin_lo, count(*) AS n,
       {r6('quantile_cont(o, 0.1)')} AS q10, {r6('quantile_cont(o, 0.25)')} AS q25,
       {r6('quantile_cont(o, 0.5)')} AS q50, {r6('quantile_cont(o, 0.75)')} AS q75,
       {r6('quantile_cont(o, 0.9)')} AS q90
FROM b GROUP BY bin""")
def plot_conditional_quantile(spark, sf_dir):
    """V5: exact quantiles of the obs in each model-value bin."""
    return canon(pdx.conditional_quantile(tb.events(spark, sf_dir), "o", "m", bins=10, lo=0.0, hi=100.0))


@query("plot_taylor", f"""WITH {tb.PAIRS_SQL},
a AS (SELECT l_returnflag, count(*) AS n, stddev_pop(o) AS so, stddev_pop(m) AS sm, covar_pop(o, m) AS cov
      FROM pairs GROUP BY 1),
b AS (SELECT *, CASE WHEN so > 0 AND sm > 0 THEN cov / (so * sm) END AS r FROM a)
SELECT l_returnflag, n, {r6('so')} AS std_obs, {r6('sm')} AS std_mod, {r6('r')} AS corr,
       {r6('sm / nullif(so, 0)')} AS std_ratio,
       {r6('sqrt(greatest(0.0, so * so + sm * sm - 2 * so * sm * coalesce(r, 0.0)))')} AS crmsd
FROM b""")
def plot_taylor(spark, sf_dir):
    """V6: Taylor diagram coordinates per return flag."""
    return canon(pdx.taylor(tb.pairs(spark, sf_dir), "o", "m", by=["l_returnflag"]))


@query("plot_goal_criteria", f"""WITH {tb.REGION_PAIRS_SQL},
a AS (SELECT region, count(*) AS n,
             100 * avg(2 * (m - o) / nullif(m + o, 0)) AS mfb, 100 * avg(2 * abs(m - o) / nullif(m + o, 0)) AS mfe
      FROM rpairs GROUP BY region)
SELECT region, n, {r6('mfb')} AS mfb, {r6('mfe')} AS mfe,
       (abs(mfb) <= 3.0 AND mfe <= 5.0) AS meets_goal, (abs(mfb) <= 6.0 AND mfe <= 7.5) AS meets_criteria
FROM a""")
def plot_goal_criteria(spark, sf_dir):
    """Mean fractional bias / error per label against goal and criteria."""
    return canon(pdx.goal_criteria(tb.pairs(spark, sf_dir, with_region=True), "o", "m", "region",
                                   bias_goal=3.0, error_goal=5.0, bias_criteria=6.0, error_criteria=7.5))


@query("plot_wind_rose", f"""WITH w AS (
  SELECT event_type, value - 50.0 AS u, CAST((user_id % 21) - 10 AS DOUBLE) AS v FROM events),
d AS (SELECT event_type, sqrt(u * u + v * v) AS spd,
             ((degrees(atan2(-u, -v)) % 360.0) + 360.0) % 360.0 AS dir FROM w)
SELECT event_type,
       CAST((((floor((dir + 22.5 / 2) / 22.5)) % 16) + 16) % 16 AS INTEGER) AS sector,
       (CASE WHEN spd >= 5 THEN 1 ELSE 0 END + CASE WHEN spd >= 10 THEN 1 ELSE 0 END +
        CASE WHEN spd >= 20 THEN 1 ELSE 0 END + CASE WHEN spd >= 50 THEN 1 ELSE 0 END +
        CASE WHEN spd >= 100 THEN 1 ELSE 0 END) AS speed_class,
       count(*) AS n
FROM d GROUP BY 1, 2, 3""")
def plot_wind_rose(spark, sf_dir):
    """Counts by 16 direction sectors x speed class per event type."""
    e = tb.read(spark, sf_dir, "events").select(
        "event_type", (F.col("value") - 50.0).alias("u"), ((F.col("user_id") % 21) - 10).cast("double").alias("v"))
    return canon(pdx.wind_rose(e, "u", "v", sectors=16, speed_edges=(5, 10, 20, 50, 100), by=["event_type"]))


@query("plot_radar_by_region", f"""WITH {tb.REGION_PAIRS_SQL},
u AS (SELECT region, 'm' AS model, o, m FROM rpairs UNION ALL SELECT region, 'm2', o, m2 FROM rpairs),
c AS (SELECT region, model, avg(o) AS ob FROM u GROUP BY 1, 2),
x AS (SELECT u.*, c.ob FROM u JOIN c USING (region, model)),
a AS (SELECT region, model, count(*) AS n, avg(o) AS mo, avg(m) AS mm, stddev_samp(o) AS so, stddev_samp(m) AS sm,
             covar_samp(o, m) AS cov, sum((m - o) * (m - o)) AS sdd,
             sum((abs(m - ob) + abs(o - ob)) * (abs(m - ob) + abs(o - ob))) AS spe FROM x GROUP BY 1, 2),
f AS (SELECT *, (n < 2 OR so = 0 OR sm = 0 OR so IS NULL OR sm IS NULL) AS degen FROM a)
SELECT region, model,
  {r6("CASE WHEN degen OR spe = 0 THEN NULL ELSE greatest(0.0, least(1.0, 1 - sdd / spe)) END")} AS ioa_radar,
  {r6("CASE WHEN degen OR mo = 0 THEN NULL ELSE 1 - sqrt(power(cov / (so * sm) - 1, 2) + power(sm / so - 1, 2) + power(mm / mo - 1, 2)) END")} AS kge,
  {r6("CASE WHEN degen THEN NULL ELSE greatest(-1.0, least(1.0, 2 * cov / (so * so + sm * sm + (mo - mm) * (mo - mm)))) END")} AS ccc
FROM f""")
def plot_radar_by_region(spark, sf_dir):
    """V7 + V12: radar metrics per model column, one facet per region."""
    return canon(pdx.radar_table(tb.pairs(spark, sf_dir, with_region=True), "o", ["m", "m2"], by=["region"]))


@query("plot_title", f"""WITH {NEAREST_SQL_CTES},
x AS (SELECT * FROM nearest WHERE obs IS NOT NULL AND v IS NOT NULL AND NOT isnan(obs) AND NOT isnan(v)),
tr AS (SELECT CASE WHEN strftime(min(time), '%Y-%m-%d') = strftime(max(time), '%Y-%m-%d')
                   THEN strftime(min(time), '%Y-%m-%d')
                   ELSE strftime(min(time), '%Y-%m-%d') || ' to ' || strftime(max(time), '%Y-%m-%d') END AS time_range
       FROM nearest)
SELECT 'Stations vs model' || ' | ' || tr.time_range || ' | ' || 'MB=' || printf('%.3f', (SELECT avg(v - obs) FROM x)) AS title,
       tr.time_range
FROM tr""")
def plot_title(spark, sf_dir):
    """Time-range text and the summary title (default stat mb for a
    bias plot)."""
    paired = _nearest(spark, sf_dir)
    t = summary_title(paired, "obs", "v", "Stations vs model", plot_type="spatial_bias")
    return t.withColumn("time_range", time_range_text(paired).scalar())


# ------------------------------------------------------------------ profiles

def _soundings(spark, sf_dir):
    li = tb.read(spark, sf_dir, "lineitem")
    obs = (li.groupBy(tb.month("l_shipdate").alias("valid_time"), F.col("l_linenumber").alias("level"))
             .agg(F.avg((90 + 130 * F.col("l_linenumber") + F.col("l_discount") * 100) * 100).alias("press"),
                  F.avg("l_quantity").alias("temp")))
    part = tb.read(spark, sf_dir, "part").select("p_partkey", "p_size")
    model = (li.join(part, li.l_partkey == part.p_partkey)
               .groupBy(tb.month("l_shipdate").alias("valid_time"),
                        (F.col("p_size") * 20).cast("double").alias("isobaric_surface"))
               .agg(F.avg(F.col("l_extendedprice") / 1000.0).alias("temperature")))
    return obs, model


_PROFILE_CTES = """ob AS (
  SELECT date_trunc('month', l_shipdate) AS valid_time, l_linenumber AS level,
         avg((90 + 130 * l_linenumber + l_discount * 100) * 100) AS press, avg(l_quantity) AS temp
  FROM lineitem GROUP BY 1, 2),
md AS (
  SELECT date_trunc('month', l.l_shipdate) AS valid_time, CAST(p.p_size * 20 AS DOUBLE) AS isobaric_surface,
         avg(l.l_extendedprice / 1000.0) AS temperature
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
f AS (SELECT CASE WHEN mm < 2000 AND mo > 10000 THEN 0.01::DOUBLE
                  WHEN mo < 2000 AND mm > 10000 THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END AS k
      FROM (SELECT (SELECT max(isobaric_surface) FROM md) AS mm, (SELECT max(press) FROM ob) AS mo)),
oa AS (SELECT valid_time, level, press * f.k AS press, temp FROM ob, f),
iv AS (SELECT valid_time, isobaric_surface AS p0, temperature AS v0,
              lead(isobaric_surface) OVER w AS p1, lead(temperature) OVER w AS v1,
              lead(isobaric_surface, 2) OVER w IS NULL AS last
       FROM md WINDOW w AS (PARTITION BY valid_time ORDER BY isobaric_surface)),
mi AS (SELECT o.valid_time, o.press,
              iv.v0 + (iv.v1 - iv.v0) * (o.press - iv.p0) / (iv.p1 - iv.p0) AS temperature_model
       FROM (SELECT DISTINCT valid_time, press FROM oa) o JOIN iv ON o.valid_time = iv.valid_time
       WHERE iv.p1 IS NOT NULL AND iv.p0 <= o.press AND (o.press < iv.p1 OR (iv.last AND o.press = iv.p1))),
prof AS (SELECT oa.valid_time, oa.level, oa.press, oa.temp, mi.temperature_model
         FROM oa LEFT JOIN mi ON oa.valid_time = mi.valid_time AND oa.press = mi.press)"""


def _profile(spark, sf_dir):
    obs, model = _soundings(spark, sf_dir)
    obs = align_pressure_units(obs, model, "press", "isobaric_surface")
    return interp_to_pressure(obs, model, "temperature", time="valid_time", obs_p="press",
                              mod_p="isobaric_surface", out="temperature_model")


@query("profile_interp", f"""WITH {_PROFILE_CTES}
SELECT {ts('valid_time')} AS valid_time, level, {r6('press')} AS press, {r6('temp')} AS temp,
       {r6('temperature_model')} AS temperature_model FROM prof""")
def profile_interp(spark, sf_dir):
    """P14 + W6: observed soundings (Pa, converted to the model's hPa) with
    the model profile interpolated linearly in pressure to each level; NULL
    outside the model's pressure range."""
    return canon(_profile(spark, sf_dir).select("valid_time", "level", "press", "temp", "temperature_model"))


@query("profile_mean_table", f"""WITH {_PROFILE_CTES}
SELECT level, {r6('arg_min(press, valid_time)')} AS press, {r6('avg(temp)')} AS temp,
       {r6('avg(temperature_model)')} AS temperature_model
FROM prof GROUP BY level""")
def profile_mean_table(spark, sf_dir):
    """Mean profile over soundings per level with the first
    sounding's pressure."""
    return canon(profile_mean(_profile(spark, sf_dir), "level", ["temp", "temperature_model"]))
