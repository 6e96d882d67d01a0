"""Registered ingest and streaming queries."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators.pairing import RegularAxis
from ..sources.io import (date_frame, date_window, missing_dates, overlapping_stations,
                          parse_photometer_files, parse_photometer_lines)
from ..streaming.stream import read_stream, run_to_latest, run_to_table, stream_pair_nearest, stream_window_stats
from . import testbed as tb
from .pairing_queries import _G_IDX
from .registry import canon, query, r6, ts


@query("coverage_missing_days", """
SELECT strftime(d, '%Y-%m-%d') AS date
FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d)
WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT DISTINCT strftime(ts, '%Y-%m-%d') FROM events)""")
def coverage_missing_days(spark, sf_dir):
    """Requested days 2023-12-30..2024-01-31 that the event store
    does not cover (left anti join of the request against distinct days)."""
    store = tb.events(spark, sf_dir)
    return canon(missing_dates(store, date_frame(spark, "2023-12-30", "2024-01-31", "D")))


@query("dates_expand_12h", """
WITH r AS (SELECT date_trunc('day', min(ts)) AS s, date_trunc('day', max(ts)) AS e FROM events)
SELECT strftime(d, '%Y-%m-%d') AS date
FROM r, generate_series(r.s, r.e, INTERVAL 12 HOUR) g(d)""")
def dates_expand_12h(spark, sf_dir):
    """S3: inclusive date expansion over the events' span at a 12-hour
    frequency; dates are formatted %Y-%m-%d, so each day appears twice."""
    ev = tb.events(spark, sf_dir).agg(F.date_trunc("day", F.min("time")).alias("s"),
                                      F.date_trunc("day", F.max("time")).alias("e"))
    step = F.expr("INTERVAL 43200 SECONDS")
    return canon(ev.select(F.explode(F.sequence("s", "e", step)).alias("t"))
                   .select(F.date_format("t", "yyyy-MM-dd").alias("date")))


@query("station_overlap_orders", f"""
WITH h AS (SELECT o_custkey, min(o_orderdate) AS b, max(o_orderdate) AS e FROM orders GROUP BY 1),
k AS (SELECT o_custkey FROM h WHERE e >= TIMESTAMP '1996-01-01' AND b <= TIMESTAMP '1996-03-31')
SELECT o.o_custkey, count(*) AS n, {r6('sum(o.o_totalprice)')} AS total
FROM orders o SEMI JOIN k ON o.o_custkey = k.o_custkey
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1996-03-31'
GROUP BY o.o_custkey""")
def station_overlap_orders(spark, sf_dir):
    """S9/J14 + S8: stations (customers) whose history overlaps the request,
    then their records inside [first, last) of the requested dates."""
    o = tb.read(spark, sf_dir, "orders").withColumn("time", F.col("o_orderdate").cast("timestamp"))
    hist = o.groupBy("o_custkey").agg(F.min("time").alias("begin"), F.max("time").alias("end"))
    keep = overlapping_stations(hist, ["1996-01-01", "1996-03-31"]).select("o_custkey")
    rows = date_window(o.join(keep, "o_custkey", "left_semi"), ["1996-01-01", "1996-03-31"])
    return canon(rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("o_totalprice").alias("total")))


def _photometer_lines(spark, sf_dir):
    """Sun-photometer style text derived from the events table: a preamble,
    a header, then one data line per event."""
    e = tb.read(spark, sf_dir, "events")
    data = e.select(F.concat_ws(
        ",", F.date_format("ts", "dd:MM:yyyy"), F.date_format("ts", "HH:mm:ss"),
        F.format_string("%.1f", (F.col("user_id") % 90).cast("double")),
        F.format_string("%.1f", ((F.col("event_id") % 360) - 180).cast("double")),
        F.format_string("%.1f", (F.col("user_id") * 10).cast("double")),
        F.format_string("%.4f", F.col("value") / 100.0)).alias("value"))
    pre = e.select("event_type").distinct().select(
        F.concat(F.lit("Version 3: site "), F.col("event_type")).alias("value"))
    head = spark.range(1).select(F.lit(
        "Date(dd:mm:yyyy),Time(hh:mm:ss),Site_Latitude,Site_Longitude,Site_Elevation,AOD_550nm").alias("value"))
    return pre.unionByName(head).unionByName(data)


@query("photometer_ingest", f"""
SELECT {ts("date_trunc('second', ts)")} AS time, {r6('CAST(user_id % 90 AS DOUBLE)')} AS lat,
       {r6('CAST((event_id % 360) - 180 AS DOUBLE)')} AS lon, {r6('CAST(user_id * 10 AS DOUBLE)')} AS elevation,
       {r6("CAST(printf('%.4f', value / 100.0) AS DOUBLE)")} AS aod_550nm
FROM events""")
def photometer_ingest(spark, sf_dir):
    """Preamble-skipping text parse (dd:mm:yyyy + hh:mm:ss -> time)."""
    return canon(parse_photometer_lines(_photometer_lines(spark, sf_dir)))


def _events_stream(spark, sf_dir):
    schema = tb.read(spark, sf_dir, "events").schema
    s = read_stream(spark, os.path.join(sf_dir, "events*.parquet"), schema)
    return s.select(F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("o"),
                    (F.col("value") + (F.col("user_id") % 7 - 3) * 0.5).alias("m"))


@query("stream_window_stats_3h", f"""WITH {tb.EVENTS_SQL},
b AS (SELECT time_bucket(INTERVAL '3 hours', time) AS t, m - o AS d FROM ev)
SELECT {ts('t')} AS time, count(*) AS n, {r6('avg(d)')} AS mb, {r6('sqrt(avg(d * d))')} AS rmse
FROM b GROUP BY t
HAVING t + INTERVAL '3 hours' <= (SELECT max(time) FROM ev) - INTERVAL '6 hours'""")
def stream_window_stats_3h(spark, sf_dir):
    """3-hour window bias / rmse over the event stream with a 6-hour
    watermark, append mode: windows still open under the watermark at the
    end of the input are not emitted (the oracle states the same rule)."""
    out = run_to_table(stream_window_stats(_events_stream(spark, sf_dir), "o", "m", freq="3 hours",
                                           watermark="6 hours", metrics=["n", "mb", "rmse"]))
    return canon(out)


@query("stream_window_stats_all", f"""WITH {tb.EVENTS_SQL}
SELECT {ts("time_bucket(INTERVAL '3 hours', time)")} AS time, count(*) AS n, {r6('avg(m - o)')} AS mb,
       {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse
FROM ev GROUP BY 1""")
def stream_window_stats_all(spark, sf_dir):
    """X2 over a bounded stream to its end: every window, also those that the
    watermark leaves open, equal to the batch result."""
    d = stream_window_stats(_events_stream(spark, sf_dir), "o", "m", freq="3 hours", watermark="6 hours",
                            metrics=["n", "mb", "rmse"])
    return canon(run_to_latest(d, ["time"]))


@query("photometer_by_header", f"""
SELECT event_type AS file, {ts("date_trunc('second', ts)")} AS time, {r6('CAST(user_id % 90 AS DOUBLE)')} AS lat,
       {r6('CAST((event_id % 360) - 180 AS DOUBLE)')} AS lon,
       {r6("CASE WHEN event_type <> 'click' THEN CAST(user_id * 10 AS DOUBLE) END")} AS elevation,
       {r6("CAST(printf('%.4f', value / 100.0) AS DOUBLE)")} AS aod_550nm
FROM events""")
def photometer_by_header(spark, sf_dir):
    """S10 by header: one file per event type; the files of 'click' events have
    their columns in another order and no elevation."""
    e = tb.read(spark, sf_dir, "events")
    when = [F.date_format("ts", "dd:MM:yyyy"), F.date_format("ts", "HH:mm:ss")]
    lat, lon = (F.col("user_id") % 90).cast("string"), ((F.col("event_id") % 360) - 180).cast("string")
    aod = F.format_string("%.4f", F.col("value") / 100.0)
    usual = F.concat_ws(",", *when, lat, lon, (F.col("user_id") * 10).cast("string"), aod)
    other = F.concat_ws(",", *when, aod, F.lit("7"), lon, lat)
    click = F.col("event_type") == "click"
    data = e.select(F.col("event_type").alias("file"), F.when(click, other).otherwise(usual).alias("value"))
    heads = e.select("event_type").distinct().select(F.col("event_type").alias("file"), F.when(
        click, "Date(dd:mm:yyyy),Time(hh:mm:ss),AOD_550nm,Day_of_Year,Site_Longitude(Degrees),Site_Latitude(Degrees)").otherwise(
        "Date(dd:mm:yyyy),Time(hh:mm:ss),Site_Latitude(Degrees),Site_Longitude(Degrees),Site_Elevation(m),AOD_550nm").alias("value"))
    return canon(parse_photometer_files(heads.unionByName(data)))


_STREAM_PAIR_SQL = f"""WITH {tb.GRID_SQL},
{tb.STATIONS_SQL},
{_G_IDX},
ob AS (SELECT o.o_orderkey, o.o_custkey AS site_id, date_trunc('month', o.o_orderdate) AS time,
              o.o_totalprice AS obs, s.lat, s.lon
       FROM orders o JOIN stations s ON o.o_custkey = s.site_id),
c AS (SELECT *, least(greatest(CAST(floor((lat - (-85.0)) / 10.0 + 0.5) AS INTEGER), 0), 17) AS i,
             CAST((((floor((lon - (-175.0)) / 10.0 + 0.5)) % 36) + 36) % 36 AS INTEGER) AS j FROM ob)
SELECT c.o_orderkey, c.site_id, {ts('c.time')} AS time, {r6('c.lat')} AS lat, {r6('c.lon')} AS lon,
       {r6('c.obs')} AS obs, {r6('g.v')} AS v
FROM c LEFT JOIN gidx g ON g.time = c.time AND g.i = c.i AND g.j = c.j"""


@query("stream_pair_orders", _STREAM_PAIR_SQL)
def stream_pair_orders(spark, sf_dir):
    """The orders table read as a stream of observations, each paired
    with the static model grid's nearest cell (stream-static joins)."""
    schema = tb.read(spark, sf_dir, "orders").schema
    s = read_stream(spark, os.path.join(sf_dir, "orders*.parquet"), schema)
    obs = s.select("o_orderkey", F.col("o_custkey").alias("site_id"), tb.month("o_orderdate").alias("time"),
                   F.col("o_totalprice").alias("obs"))
    obs = obs.join(tb.stations(spark, sf_dir), "site_id")
    paired = stream_pair_nearest(obs, tb.model_grid(spark, sf_dir), "v",
                                 RegularAxis(-85.0, 10.0, 18), RegularAxis(-175.0, 10.0, 36, periodic=True))
    out = run_to_table(paired.select("o_orderkey", "site_id", "time", "lat", "lon", "obs", "v"))
    return canon(out)


@query("valid_times_from_cycles", f"""WITH cyc AS (SELECT DISTINCT date_trunc('day', ts) AS cycle FROM events),
vt AS (SELECT cycle, lead_h, cycle + to_hours(lead_h) AS time
       FROM cyc, (SELECT unnest([0, 3, 6, 9, 12, 15, 18, 21]) AS lead_h)),
ev AS (SELECT time_bucket(INTERVAL '3 hours', ts) AS time, count(*) AS n FROM events GROUP BY 1)
SELECT {ts('vt.cycle')} AS cycle, vt.lead_h, {ts('vt.time')} AS time, coalesce(ev.n, 0) AS n
FROM vt LEFT JOIN ev ON vt.time = ev.time""")
def valid_times_from_cycles(spark, sf_dir):
    """Forecast cycles (one per day of the event store) x the lead
    hours of the configuration give the valid times; each gets the number of
    events in its 3-hour slot."""
    from ..operators.pairing import valid_time_table
    e = tb.events(spark, sf_dir)
    cycles = e.select(F.date_trunc("day", "time").alias("cycle")).distinct()
    vt = valid_time_table(cycles, [0, 3, 6, 9, 12, 15, 18, 21])
    slots = e.groupBy(F.window("time", "3 hours").start.alias("time")).agg(F.count(F.lit(1)).alias("n"))
    out = vt.join(slots, "time", "left").select("cycle", F.col("lead_h").cast("int").alias("lead_h"), "time",
                                                F.coalesce("n", F.lit(0)).alias("n"))
    return canon(out)


@query("conform_subset", f"""WITH {tb.GRID_SQL},
tr AS (SELECT time, dense_rank() OVER (ORDER BY time) - 1 AS ix FROM (SELECT DISTINCT time FROM grid))
SELECT {ts('g.time')} AS time, {r6('g.lat')} AS lat, {r6('g.lon')} AS lon, {r6('g.v * 2.0 + 1.0')} AS quantity
FROM grid g JOIN tr ON g.time = tr.time
WHERE tr.ix < 12 AND g.lat IN (-45.0, 5.0, 55.0)""")
def conform_subset(spark, sf_dir):
    """P1-P3 + F1-F3: positional time subset (first 12 model times), label
    selection on lat, rename v -> quantity, scale x2 then offset +1; the
    subset keys may use the old or the new names."""
    from ..operators.conform import conform
    g = tb.model_grid(spark, sf_dir)
    out = conform(g, rename_map={"v": "quantity"}, scale_map={"quantity": 2.0}, offset_map={"quantity": 1.0},
                  isel_map={"time": slice(0, 12)}, sel_map={"lat": [-45.0, 5.0, 55.0]})
    return canon(out.select("time", "lat", "lon", "quantity"))


@query("stream_dedup_events", """SELECT DISTINCT user_id, event_type FROM events""")
def stream_dedup_events(spark, sf_dir):
    """The event stream de-duplicated per (user, event type) within a
    one-hour watermark; one micro-batch holds the whole table, so every key
    survives exactly once (the kept row of a key is the stream's choice,
    only the keys are compared)."""
    from ..streaming.stream import stream_dedup
    schema = tb.read(spark, sf_dir, "events").schema
    s = read_stream(spark, os.path.join(sf_dir, "events*.parquet"), schema)
    s = s.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("time"))
    out = run_to_table(stream_dedup(s, ["user_id", "event_type"], watermark="1 hour"))
    return canon(out.select("user_id", "event_type"))


@query("stream_pair_two_streams", f"""
SELECT o.o_orderkey, l.l_linenumber, {ts('o.o_orderdate')} AS time, {r6('o.o_totalprice')} AS obs,
       {r6('l.l_extendedprice')} AS v
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
 AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 3000 DAY AND o.o_orderdate + INTERVAL 3000 DAY""")
def stream_pair_two_streams(spark, sf_dir):
    """Observations (orders) and 'model' records (line items) arrive as
    two streams and are paired on the key within a time tolerance; both
    sides carry watermarks so the join state is bounded."""
    from ..streaming.stream import stream_pair_streams
    osch = tb.read(spark, sf_dir, "orders").schema
    lsch = tb.read(spark, sf_dir, "lineitem").schema
    o = read_stream(spark, os.path.join(sf_dir, "orders*.parquet"), osch).select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("time"), F.col("o_totalprice").alias("obs"))
    m = read_stream(spark, os.path.join(sf_dir, "lineitem*.parquet"), lsch).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
        F.col("l_shipdate").cast("timestamp").alias("time"), F.col("l_extendedprice").alias("v"))
    paired = stream_pair_streams(o, m, ["o_orderkey"], obs_watermark="3650 days", model_watermark="3650 days",
                                 tolerance="3000 days")
    out = run_to_table(paired.select("o_orderkey", "l_linenumber", "time", "obs", "v"))
    return canon(out)
