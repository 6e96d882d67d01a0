"""Registered reduction queries (A1-A10) on a two-variable model grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.reduce import calculate_reduction, multi_reduction
from . import testbed as tb
from .registry import canon, query, r6, ts

GRID2_SQL = """grid2 AS (
  SELECT date_trunc('month', l_shipdate) AS time,
         (-85.0)::DOUBLE + 10.0::DOUBLE * (l_partkey % 18) AS lat,
         (-175.0)::DOUBLE + 10.0::DOUBLE * (l_suppkey % 36) AS lon,
         avg(l_quantity) AS v, max(l_discount) AS dmax
  FROM lineitem GROUP BY 1, 2, 3)"""


def grid2(spark, sf_dir):
    li = tb.read(spark, sf_dir, "lineitem")
    return (li.select(tb.month("l_shipdate").alias("time"),
                      (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % 18)).alias("lat"),
                      (F.lit(-175.0) + 10.0 * (F.col("l_suppkey") % 36)).alias("lon"),
                      "l_quantity", "l_discount")
              .groupBy("time", "lat", "lon")
              .agg(F.avg("l_quantity").alias("v"), F.max("l_discount").alias("dmax")))


DIMS = ["time", "lat", "lon"]
W = "cos(radians(lat))"


@query("reduce_mean_all", f"WITH {GRID2_SQL} SELECT {r6('avg(v)')} AS v, {r6('avg(dmax)')} AS dmax FROM grid2")
def reduce_mean_all(spark, sf_dir):
    """A1/A2/A10: dim=None reduces every dim, every variable."""
    return canon(calculate_reduction(grid2(spark, sf_dir), "mean", dims=DIMS))


@query("reduce_time_stats_per_cell", f"""WITH {GRID2_SQL}
SELECT {r6('lat')} AS lat, {r6('lon')} AS lon,
       {r6('max(v)')} AS v_max, {r6('min(v)')} AS v_min, {r6('stddev_pop(v)')} AS v_std, {r6('coalesce(sum(v), 0)')} AS v_sum,
       {r6('max(dmax)')} AS dmax_max, {r6('min(dmax)')} AS dmax_min, {r6('stddev_pop(dmax)')} AS dmax_std,
       {r6('coalesce(sum(dmax), 0)')} AS dmax_sum
FROM grid2 GROUP BY lat, lon""")
def reduce_time_stats_per_cell(spark, sf_dir):
    """Max, min, population std and sum over time, per cell, all in one aggregate."""
    return canon(multi_reduction(grid2(spark, sf_dir), ["max", "min", "std", "sum"], dim="time", dims=DIMS))


@query("reduce_other_methods_over_lon", f"""WITH {GRID2_SQL}
SELECT {ts('time')} AS time, {r6('lat')} AS lat,
       {r6('median(v)')} AS v_median, {r6('var_pop(v)')} AS v_var, count(v) AS v_count, {r6('product(v)')} AS v_prod
FROM grid2 GROUP BY time, lat""")
def reduce_other_methods_over_lon(spark, sf_dir):
    """Median, var, count, product by name over one dim (lon)."""
    return canon(multi_reduction(grid2(spark, sf_dir), ["median", "var", "count", "prod"], dim="lon",
                                 dims=DIMS, values=["v"]))


@query("reduce_spatial_weighted", f"""WITH {GRID2_SQL}
SELECT {ts('time')} AS time, {r6(f'sum({W} * v) / sum({W})')} AS v, {r6(f'sum({W} * dmax) / sum({W})')} AS dmax
FROM grid2 GROUP BY time""")
def reduce_spatial_weighted(spark, sf_dir):
    """Mean over (lat, lon) is the cos(lat) area-weighted mean; time kept."""
    return canon(calculate_reduction(grid2(spark, sf_dir), "mean", dim=["lat", "lon"], dims=DIMS))


@query("reduce_spatial_then_time", f"""WITH {GRID2_SQL},
s AS (SELECT time, sum({W} * v) / sum({W}) AS v, sum({W} * dmax) / sum({W}) AS dmax FROM grid2 GROUP BY time)
SELECT {r6('avg(v)')} AS v, {r6('avg(dmax)')} AS dmax FROM s""")
def reduce_spatial_then_time(spark, sf_dir):
    """Weighted spatial mean first, then the plain mean over time."""
    return canon(calculate_reduction(grid2(spark, sf_dir), "mean", dim=["time", "lat", "lon"], dims=DIMS))


@query("reduce_force_weighted", f"""WITH {GRID2_SQL}
SELECT {ts('time')} AS time, {r6('sum(cos(radians(lat)) * v) / sum(cos(radians(lat)))')} AS v
FROM grid2 GROUP BY time""")
def reduce_force_weighted(spark, sf_dir):
    """A8 with force_weighted: dims named y/x (first = latitude)."""
    g = grid2(spark, sf_dir).select("time", F.col("lat").alias("y"), F.col("lon").alias("x"), "v")
    return canon(calculate_reduction(g, "mean", dim=["y", "x"], dims=["time", "y", "x"], force_weighted=True))
