"""Registered time-window, distribution and de-duplication queries
(W1, W2, M16, M17, D1-D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..operators.distribution import fractions_skill_score, wasserstein
from ..operators.series import resample, time_window_stats
from . import testbed as tb
from .registry import canon, query, r6, ts


@query("timeseriesstat_bias_3h", f"""WITH {tb.EVENTS_SQL}
SELECT {ts("time_bucket(INTERVAL '3 hours', time)")} AS time, count(*) AS n, {r6('avg(m - o)')} AS mb
FROM ev GROUP BY 1""")
def timeseriesstat_bias_3h(spark, sf_dir):
    """Bias of all pairs in each 3-hour tumbling window."""
    return canon(time_window_stats(tb.events(spark, sf_dir), "o", "m", freq="3h", stat="mb"))


@query("timeseriesstat_rmse_by_type", f"""WITH {tb.EVENTS_SQL}
SELECT event_type, {ts("time_bucket(INTERVAL '1 day', time)")} AS time, count(*) AS n,
       {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse
FROM ev GROUP BY 1, 2""")
def timeseriesstat_rmse_by_type(spark, sf_dir):
    """W1 with stat='rmse', daily windows, one series per event type (V12 facet)."""
    return canon(time_window_stats(tb.events(spark, sf_dir), "o", "m", freq="D", stat="rmse",
                                   by=["event_type"]))


@query("resample_hourly", f"""WITH {tb.EVENTS_SQL}
SELECT event_type, {ts("time_bucket(INTERVAL '1 hour', time)")} AS time, {r6('avg(o)')} AS o, {r6('avg(m)')} AS m
FROM ev GROUP BY 1, 2""")
def resample_hourly(spark, sf_dir):
    """Hourly mean per series (event type)."""
    return canon(resample(tb.events(spark, sf_dir), "h", ["o", "m"], keys=["event_type"]))


@query("wasserstein_by_flag", f"""WITH {tb.PAIRS_SQL},
a AS (SELECT l_returnflag, o, row_number() OVER (PARTITION BY l_returnflag ORDER BY o) AS r FROM pairs),
b AS (SELECT l_returnflag, m, row_number() OVER (PARTITION BY l_returnflag ORDER BY m) AS r FROM pairs)
SELECT a.l_returnflag, {r6('avg(abs(a.o - b.m))')} AS wassersteindistance
FROM a JOIN b ON a.l_returnflag = b.l_returnflag AND a.r = b.r GROUP BY a.l_returnflag""")
def wasserstein_by_flag(spark, sf_dir):
    """Earth mover's distance between the obs and model distributions
    per return flag. Buckets of 65536 values are used here so the
    multi-bucket prefix-sum path is what the oracle checks (one bucket would
    hold everything at this scale); the oracle computes it the other way
    (mean |o_(i) - m_(i)| of the sorted samples)."""
    return canon(wasserstein(tb.pairs(spark, sf_dir), "o", "m", by=["l_returnflag"], rows_per_bucket=65536))


_FSS_SQL = f"""WITH {tb.GRID_SQL},
og AS (
  SELECT date_trunc('month', l_shipdate) AS time,
         (-85.0)::DOUBLE + 10.0::DOUBLE * ((l_partkey + 1) % 18) AS lat,
         (-175.0)::DOUBLE + 10.0::DOUBLE * (l_suppkey % 36) AS lon,
         avg(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2, 3),
ex AS (
  SELECT time, CAST(round((lat + 85.0) / 10.0) AS INTEGER) AS i, CAST(round((lon + 175.0) / 10.0) AS INTEGER) AS j,
         1 AS f, 0 AS o FROM grid WHERE v >= 26.0
  UNION ALL
  SELECT time, CAST(round((lat + 85.0) / 10.0) AS INTEGER), CAST(round((lon + 175.0) / 10.0) AS INTEGER),
         0, 1 FROM og WHERE v >= 26.0),
nb AS (
  SELECT time, i + di AS ti, j + dj AS tj, f, o
  FROM ex, (SELECT a.range AS di, b.range AS dj FROM range(-1, 2) a, range(-1, 2) b)
  WHERE i + di BETWEEN 0 AND 17 AND j + dj BETWEEN 0 AND 35),
fr AS (SELECT time, ti, tj, CAST(sum(f) AS DOUBLE) / 9.0::DOUBLE AS pf, CAST(sum(o) AS DOUBLE) / 9.0::DOUBLE AS po
       FROM nb GROUP BY 1, 2, 3),
every AS (SELECT time FROM grid UNION SELECT time FROM og)
SELECT {ts('time')} AS time,
       {r6('1 - sum((pf - po) * (pf - po)) / nullif(sum(pf * pf) + sum(po * po), 0)')} AS fss
FROM every LEFT JOIN fr USING (time) GROUP BY time"""


@query("fss_per_month", _FSS_SQL)
def fss_per_month(spark, sf_dir):
    """Fractions skill score of a displaced 'observed' field against the
    model grid, threshold 26, 3x3 neighbourhood, per month."""
    fc = tb.model_grid(spark, sf_dir)
    li = tb.read(spark, sf_dir, "lineitem")
    ob = (li.select(tb.month("l_shipdate").alias("time"),
                    (F.lit(-85.0) + 10.0 * ((F.col("l_partkey") + 1) % 18)).alias("lat"),
                    (F.lit(-175.0) + 10.0 * (F.col("l_suppkey") % 36)).alias("lon"), "l_quantity")
            .groupBy("time", "lat", "lon").agg(F.avg("l_quantity").alias("v")))
    return canon(fractions_skill_score(fc, ob, "v", "v", threshold=26.0, k=1, by=["time"],
                                       axes=tb.axes10(fc)))


@query("dedup_first_order", f"""WITH x AS (
  SELECT o_custkey, date_trunc('month', o_orderdate) AS month, o_orderdate, o_orderkey, o_totalprice FROM orders)
SELECT o_custkey, {ts('month')} AS month, {ts('o_orderdate')} AS o_orderdate, o_orderkey, {r6('o_totalprice')} AS o_totalprice
FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey, month ORDER BY o_orderdate, o_orderkey) = 1""")
def dedup_first_order(spark, sf_dir):
    """Keep the first order per (customer, month) by
    (order date, order key) -- a partial aggregate, not a window."""
    o = tb.read(spark, sf_dir, "orders").select(
        "o_custkey", tb.month("o_orderdate").alias("month"), F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
        "o_orderkey", "o_totalprice")
    return canon(keep_first(o, ["o_custkey", "month"], ["o_orderdate", "o_orderkey"]))
