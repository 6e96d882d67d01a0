"""Registered pairing queries (J1-J10, U1, M26) on stations x model grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairing as pr
from ..operators.combine import combine_paired
from ..operators.stats import compute_statistics
from . import testbed as tb
from .registry import canon, query, r6, ts

# SQL twins of the index arithmetic (10 deg grid: lat -85..85 (18), lon -175..175 (36, periodic))
_G_IDX = """gidx AS (
  SELECT time, CAST(round((lat - (-85.0)) / 10.0) AS INTEGER) AS i,
         CAST((((round((lon - (-175.0)) / 10.0)) % 36) + 36) % 36 AS INTEGER) AS j, v
  FROM grid)"""

_NEAREST_CELLS = """ncells AS (
  SELECT DISTINCT lat, lon,
         least(greatest(CAST(floor((lat - (-85.0)) / 10.0 + 0.5) AS INTEGER), 0), 17) AS i,
         CAST((((floor((lon - (-175.0)) / 10.0 + 0.5)) % 36) + 36) % 36 AS INTEGER) AS j
  FROM sobs)"""

NEAREST_SQL_CTES = f"""{tb.GRID_SQL},
{tb.STATION_OBS_SQL},
{_G_IDX},
{_NEAREST_CELLS},
nearest AS (
  SELECT s.site_id, s.time, s.lat, s.lon, s.obs, g.v
  FROM sobs s JOIN ncells c ON s.lat = c.lat AND s.lon = c.lon
  LEFT JOIN gidx g ON g.time = s.time AND g.i = c.i AND g.j = c.j)"""


def _corners_sql(src: str, keys: str, out: str) -> str:
    k = (keys + ", ") if keys else ""
    return f"""{out}_f AS (
  SELECT DISTINCT {k}lat, lon, (lat - (-85.0)) / 10.0 AS fi, (lon - (-175.0)) / 10.0 AS fj FROM {src}),
{out} AS (
  SELECT {k}lat, lon, CAST(floor(fi) AS INTEGER) + di AS i,
         CAST((((floor(fj) + dj) % 36) + 36) % 36 AS INTEGER) AS j,
         (CASE WHEN di = 1 THEN fi - floor(fi) ELSE 1 - (fi - floor(fi)) END) *
         (CASE WHEN dj = 1 THEN fj - floor(fj) ELSE 1 - (fj - floor(fj)) END) AS w
  FROM {out}_f, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(di, dj)
  WHERE CAST(floor(fi) AS INTEGER) + di BETWEEN 0 AND 17)"""


BILINEAR_SQL_CTES = f"""{tb.GRID_SQL},
{tb.STATION_OBS_SQL},
{_G_IDX},
{_corners_sql('sobs', 'time', 'corners')},
binterp AS (
  SELECT c.time, c.lat, c.lon, CASE WHEN count(g.v) = 4 THEN sum(c.w * g.v) END AS v
  FROM corners c LEFT JOIN gidx g ON g.time = c.time AND g.i = c.i AND g.j = c.j
  GROUP BY 1, 2, 3),
bilinear AS (
  SELECT s.site_id, s.time, s.lat, s.lon, s.obs, b.v
  FROM sobs s LEFT JOIN binterp b ON s.time = b.time AND s.lat = b.lat AND s.lon = b.lon)"""


def _pair_out_sql(src: str) -> str:
    return (f"SELECT site_id, {ts('time')} AS time, {r6('lat')} AS lat, {r6('lon')} AS lon, "
            f"{r6('obs')} AS obs, {r6('v')} AS v FROM {src}")


@query("pair_nearest_stations", f"WITH {NEAREST_SQL_CTES}\n{_pair_out_sql('nearest')}")
def pair_nearest_stations(spark, sf_dir):
    """J1 + J6: every station observation with its nearest cell's model
    value at the same month (left join: NULL where that cell-month is absent)."""
    grid = tb.model_grid(spark, sf_dir)
    obs = tb.station_obs(spark, sf_dir)
    out = pr.pair_nearest(grid, obs, "v", axes=tb.axes10(grid))
    return canon(out.select("site_id", "time", "lat", "lon", "obs", "v"))


@query("pair_bilinear_stations", f"WITH {BILINEAR_SQL_CTES}\n{_pair_out_sql('bilinear')}")
def pair_bilinear_stations(spark, sf_dir):
    """Bilinear interpolation; NULL unless all four corners exist."""
    grid = tb.model_grid(spark, sf_dir)
    obs = tb.station_obs(spark, sf_dir)
    out = pr.pair_bilinear(grid, obs, "v", axes=tb.axes10(grid))
    return canon(out.select("site_id", "time", "lat", "lon", "obs", "v"))


@query("pair_nearest_nomerge", f"""WITH {NEAREST_SQL_CTES}
SELECT DISTINCT {ts('time')} AS time, {r6('lat')} AS lat, {r6('lon')} AS lon, {r6('v')} AS v
FROM nearest""")
def pair_nearest_nomerge(spark, sf_dir):
    """merge=False keeps only keys and model variables (distinct per
    site-time; repeated points would repeat the same model value)."""
    grid = tb.model_grid(spark, sf_dir)
    obs = tb.station_obs(spark, sf_dir)
    out = pr.pair_data(grid, obs, "v", method="nearest", merge=False, axes=tb.axes10(grid))
    return canon(out.distinct())


@query("regrid_bilinear", f"""WITH {tb.GRID_SQL},
{tb.grid_sql(15, 'grid15')},
{_G_IDX},
tcells AS (SELECT DISTINCT lat, lon FROM grid15),
{_corners_sql('tcells', '', 'tc')}
SELECT {ts('g.time')} AS time, {r6('tc.lat')} AS lat, {r6('tc.lon')} AS lon,
       {r6('CASE WHEN count(g.v) = 4 THEN sum(tc.w * g.v) END')} AS v
FROM tc JOIN gidx g ON g.i = tc.i AND g.j = tc.j
GROUP BY g.time, tc.lat, tc.lon""")
def regrid_bilinear(spark, sf_dir):
    """The 10 deg model onto the 15 deg grid's cells, every month."""
    grid = tb.model_grid(spark, sf_dir)
    target = tb.model_grid(spark, sf_dir, step=15).select("lat", "lon")
    return canon(pr.regrid(grid, target, "v", "bilinear", axes=tb.axes10(grid)))


@query("regrid_nearest", f"""WITH {tb.GRID_SQL},
{tb.grid_sql(15, 'grid15')},
{_G_IDX},
tcells AS (SELECT DISTINCT lat, lon,
         least(greatest(CAST(floor((lat - (-85.0)) / 10.0 + 0.5) AS INTEGER), 0), 17) AS i,
         CAST((((floor((lon - (-175.0)) / 10.0 + 0.5)) % 36) + 36) % 36 AS INTEGER) AS j
  FROM grid15)
SELECT {ts('g.time')} AS time, {r6('t.lat')} AS lat, {r6('t.lon')} AS lon, {r6('g.v')} AS v
FROM tcells t JOIN gidx g ON g.i = t.i AND g.j = t.j""")
def regrid_nearest(spark, sf_dir):
    """J4 (nearest): each 15 deg target cell takes its nearest 10 deg cell."""
    grid = tb.model_grid(spark, sf_dir)
    target = tb.model_grid(spark, sf_dir, step=15).select("lat", "lon")
    return canon(pr.regrid(grid, target, "v", "nearest", axes=tb.axes10(grid)))


_CONS_SQL = f"""WITH {tb.GRID_SQL},
{tb.grid_sql(15, 'grid15')},
{_G_IDX},
tcells AS (SELECT DISTINCT lat, lon FROM grid15),
src AS (SELECT i.range::INTEGER AS i, j.range::INTEGER AS j FROM range(18) i, range(36) j),
ov AS (
  SELECT t.lat, t.lon, s.i, s.j,
         least((-85.0) + 10.0 * (s.i + 0.5), t.lat + 15.0 / 2, 90.0) AS lat_hi,
         greatest((-85.0) + 10.0 * (s.i - 0.5), t.lat - 15.0 / 2, -90.0) AS lat_lo,
         least((-175.0) + 10.0 * (s.j + 0.5), t.lon + 15.0 / 2)
           - greatest((-175.0) + 10.0 * (s.j - 0.5), t.lon - 15.0 / 2) AS lon_ov
  FROM tcells t, src s),
wt AS (SELECT lat, lon, i, j, lon_ov * (sin(radians(lat_hi)) - sin(radians(lat_lo))) AS w
       FROM ov WHERE lat_hi > lat_lo AND lon_ov > 0)
SELECT {ts('g.time')} AS time, {r6('wt.lat')} AS lat, {r6('wt.lon')} AS lon,
       {r6('sum(wt.w * g.v) / sum(wt.w)')} AS v
FROM wt JOIN gidx g ON g.i = wt.i AND g.j = wt.j
GROUP BY g.time, wt.lat, wt.lon"""


@query("regrid_conservative", _CONS_SQL)
def regrid_conservative(spark, sf_dir):
    """Area-overlap weighted remap 10 deg -> 15 deg."""
    grid = tb.model_grid(spark, sf_dir)
    target = tb.model_grid(spark, sf_dir, step=15).select("lat", "lon")
    return canon(pr.regrid_conservative(grid, target, "v", target_step=(15.0, 15.0), axes=tb.axes10(grid)))


_INTERP_SQL = f"""WITH dm AS (
  SELECT event_type, date_trunc('day', ts) AS t, avg(value) AS v FROM events GROUP BY 1, 2),
ax AS (SELECT event_type, t AS t0, lead(t) OVER (PARTITION BY event_type ORDER BY t) AS t1
       FROM (SELECT DISTINCT event_type, t FROM dm)),
pt AS (SELECT DISTINCT event_type, ts FROM events),
br AS (SELECT pt.event_type, pt.ts, ax.t0, ax.t1 FROM pt JOIN ax ON pt.event_type = ax.event_type
       AND ax.t0 <= pt.ts AND (pt.ts < ax.t1 OR (ax.t1 IS NULL AND pt.ts = ax.t0))),
iv AS (SELECT br.event_type, br.ts,
         CASE WHEN br.ts = br.t0 THEN v0.v
              ELSE v0.v + (v1.v - v0.v) * (CAST(epoch_us(br.ts) - epoch_us(br.t0) AS DOUBLE)
                                          / CAST(epoch_us(br.t1) - epoch_us(br.t0) AS DOUBLE)) END AS v
       FROM br LEFT JOIN dm v0 ON v0.event_type = br.event_type AND v0.t = br.t0
       LEFT JOIN dm v1 ON v1.event_type = br.event_type AND v1.t = br.t1)
SELECT e.event_id, e.event_type, {ts('e.ts')} AS time, {r6('e.value')} AS o, {r6('iv.v')} AS v
FROM events e LEFT JOIN iv ON e.event_type = iv.event_type AND e.ts = iv.ts"""


@query("pair_interp_time", _INTERP_SQL)
def pair_interp_time(spark, sf_dir):
    """Daily-mean 'model' per event type linearly interpolated to each
    event's time (NULL after the last model time of its series)."""
    ev = tb.events(spark, sf_dir).select("event_id", "event_type", "time", "o")
    model = (ev.groupBy("event_type", F.date_trunc("day", "time").alias("time"))
               .agg(F.avg("o").alias("v")))
    out = pr.pair_interp_time(model, ev, "v", keys=["event_type"], bucket_seconds=86400)
    return canon(out.select("event_id", "event_type", "time", "o", "v"))


_ASOF_SQL = f"""WITH vw AS (SELECT event_id, user_id, ts AS time, value AS o FROM events WHERE event_type = 'view'),
ck AS (SELECT user_id, ts AS mt, value AS cv FROM events WHERE event_type = 'click'),
cand AS (
  SELECT p.user_id, p.time, ck.mt, ck.cv, abs(epoch_us(p.time) - epoch_us(ck.mt)) AS dt
  FROM (SELECT DISTINCT user_id, time FROM vw) p JOIN ck ON p.user_id = ck.user_id
  WHERE abs(epoch_us(p.time) - epoch_us(ck.mt)) <= 3600000000),
best AS (SELECT user_id, time, mt, cv FROM cand
         QUALIFY row_number() OVER (PARTITION BY user_id, time ORDER BY dt, mt, cv) = 1)
SELECT vw.event_id, vw.user_id, {ts('vw.time')} AS time, {r6('vw.o')} AS o,
       {ts('best.mt')} AS model_time, {r6('best.cv')} AS v
FROM vw LEFT JOIN best ON vw.user_id = best.user_id AND vw.time = best.time"""


@query("pair_asof_events", _ASOF_SQL)
def pair_asof_events(spark, sf_dir):
    """Each 'view' event takes the same user's nearest 'click' within one
    hour (bucketed equi join; earlier time wins ties)."""
    ev = tb.events(spark, sf_dir)
    views = ev.where(F.col("event_type") == "view").select("event_id", "user_id", "time", "o")
    clicks = ev.where(F.col("event_type") == "click").select("user_id", "time", F.col("o").alias("v"))
    out = pr.pair_asof(views, clicks, "v", keys=["user_id"], tolerance_seconds=3600)
    return canon(out.select("event_id", "user_id", "time", "o", "model_time", "v"))


def _curvi_cells(spark, sf_dir):
    g = tb.model_grid(spark, sf_dir).select("lat", "lon").distinct()
    return g.select(
        (F.round((F.col("lat") + 85.0) / 10.0).cast("int") * 36
         + F.round((F.col("lon") + 175.0) / 10.0).cast("int")).alias("cell_id"),
        (F.col("lat") + 2.0 * F.sin(F.col("lon") * 0.05)).alias("lat"),
        (F.col("lon") + 3.0 * F.cos(F.col("lat") * 0.05)).alias("lon"))


_CURVI_SQL = f"""WITH {tb.GRID_SQL},
{tb.STATIONS_SQL},
cells AS (
  SELECT CAST(round((lat + 85.0) / 10.0) AS INTEGER) * 36 + CAST(round((lon + 175.0) / 10.0) AS INTEGER) AS cell_id,
         lat + 2.0 * sin(lon * 0.05) AS clat, lon + 3.0 * cos(lat * 0.05) AS clon
  FROM (SELECT DISTINCT lat, lon FROM grid)),
s AS (SELECT DISTINCT lat, lon FROM stations),
d AS (SELECT s.lat, s.lon, c.cell_id,
             (s.lat - c.clat) * (s.lat - c.clat) + (s.lon - c.clon) * (s.lon - c.clon) AS d2
      FROM s, cells c)
SELECT {r6('lat')} AS lat, {r6('lon')} AS lon, cell_id, {r6('sqrt(d2)')} AS distance
FROM d QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY d2, cell_id) = 1"""


@query("pair_nearest_curvilinear", _CURVI_SQL)
def pair_nearest_curvilinear(spark, sf_dir):
    """Nearest cell of a distorted (2-D coordinate) grid for every
    station, exact via tiled candidate search (oracle: brute force)."""
    cells = _curvi_cells(spark, sf_dir)
    sites = tb.stations(spark, sf_dir)
    return canon(pr.pair_nearest_curvilinear(cells, sites))


_COMBINED_SQL = f"""WITH {NEAREST_SQL_CTES},
{_corners_sql('sobs', 'time', 'corners')},
binterp AS (
  SELECT c.time, c.lat, c.lon, CASE WHEN count(g.v) = 4 THEN sum(c.w * g.v) END AS v
  FROM corners c LEFT JOIN gidx g ON g.time = c.time AND g.i = c.i AND g.j = c.j
  GROUP BY 1, 2, 3),
bilinear AS (
  SELECT s.site_id, s.time, s.lat, s.lon, s.obs, b.v
  FROM sobs s LEFT JOIN binterp b ON s.time = b.time AND s.lat = b.lat AND s.lon = b.lon),
u AS (SELECT 'nearest' AS model, obs AS o, v AS m FROM nearest
      UNION ALL SELECT 'bilinear' AS model, obs AS o, v AS m FROM bilinear),
x AS (SELECT * FROM u WHERE o IS NOT NULL AND m IS NOT NULL AND NOT isnan(o) AND NOT isnan(m))
SELECT model, count(*) AS n, {r6('avg(m)')} AS mean_mod, {r6('avg(o)')} AS mean_obs,
       {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse,
       {r6('CASE WHEN count(*) >= 2 AND stddev_samp(o) > 0 AND stddev_samp(m) > 0 THEN covar_samp(o, m) / (stddev_samp(o) * stddev_samp(m)) END')} AS corr
FROM x GROUP BY model"""


@query("combined_model_scores", _COMBINED_SQL)
def combined_model_scores(spark, sf_dir):
    """U1 + M26: nearest and bilinear pairings combined along a ``model``
    key, then scored per model in one aggregate."""
    grid = tb.model_grid(spark, sf_dir)
    obs = tb.station_obs(spark, sf_dir)
    ax = tb.axes10(grid)
    both = combine_paired({"nearest": pr.pair_nearest(grid, obs, "v", axes=ax),
                           "bilinear": pr.pair_bilinear(grid, obs, "v", axes=ax)}, dim="model")
    return canon(compute_statistics(both, ["n", "mean_mod", "mean_obs", "rmse", "corr"], "obs", "v",
                                    by=["model"]))


_SPACE_TIME_SQL = f"""WITH {tb.GRID_SQL},
{tb.STATIONS_SQL},
{_G_IDX},
ob AS (SELECT o.o_orderkey, s.site_id, o.o_orderdate AS time, s.lat, s.lon, o.o_totalprice AS obs
       FROM orders o JOIN stations s ON o.o_custkey = s.site_id),
c AS (SELECT DISTINCT lat, lon,
         least(greatest(CAST(floor((lat - (-85.0)) / 10.0 + 0.5) AS INTEGER), 0), 17) AS i,
         CAST((((floor((lon - (-175.0)) / 10.0 + 0.5)) % 36) + 36) % 36 AS INTEGER) AS j
      FROM ob),
need AS (SELECT DISTINCT c.i, c.j, ob.time FROM ob JOIN c ON ob.lat = c.lat AND ob.lon = c.lon),
ax AS (SELECT i, j, time AS t0, lead(time) OVER (PARTITION BY i, j ORDER BY time) AS t1
       FROM (SELECT DISTINCT i, j, time FROM gidx)),
br AS (SELECT need.i, need.j, need.time, ax.t0, ax.t1 FROM need JOIN ax
       ON need.i = ax.i AND need.j = ax.j AND ax.t0 <= need.time
      AND (need.time < ax.t1 OR (ax.t1 IS NULL AND need.time = ax.t0))),
iv AS (SELECT br.i, br.j, br.time,
         CASE WHEN br.time = br.t0 THEN g0.v
              ELSE g0.v + (g1.v - g0.v) * (CAST(epoch_us(br.time) - epoch_us(br.t0) AS DOUBLE)
                                          / CAST(epoch_us(br.t1) - epoch_us(br.t0) AS DOUBLE)) END AS v
       FROM br LEFT JOIN gidx g0 ON g0.i = br.i AND g0.j = br.j AND g0.time = br.t0
       LEFT JOIN gidx g1 ON g1.i = br.i AND g1.j = br.j AND g1.time = br.t1)
SELECT ob.o_orderkey, ob.site_id, {ts('ob.time')} AS time, {r6('ob.obs')} AS obs, {r6('iv.v')} AS v
FROM ob JOIN c ON ob.lat = c.lat AND ob.lon = c.lon
LEFT JOIN iv ON iv.i = c.i AND iv.j = c.j AND iv.time = ob.time"""


@query("pair_nearest_interp_time", _SPACE_TIME_SQL)
def pair_nearest_interp_time(spark, sf_dir):
    """J1 + J7 (``interp_time``): every order at its station and exact order
    date, paired with the nearest cell's monthly model series interpolated
    linearly to that date (NULL after the cell's last month)."""
    grid = tb.model_grid(spark, sf_dir)
    o = tb.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("site_id"), F.col("o_orderdate").cast("timestamp").alias("time"),
        F.col("o_totalprice").alias("obs"))
    obs = o.join(tb.stations(spark, sf_dir), "site_id")
    out = pr.pair_data(grid, obs, "v", method="nearest", interp_time=True, axes=tb.axes10(grid))
    return canon(out.select("o_orderkey", "site_id", "time", "obs", "v"))


_GC_SQL = f"""WITH {tb.GRID_SQL},
{tb.STATIONS_SQL},
cells AS (
  SELECT CAST(round((lat + 85.0) / 10.0) AS INTEGER) * 36 + CAST(round((lon + 175.0) / 10.0) AS INTEGER) AS cell_id,
         lat + 2.0 * sin(lon * 0.05) AS clat, lon + 3.0 * cos(lat * 0.05) AS clon
  FROM (SELECT DISTINCT lat, lon FROM grid)),
cv AS (SELECT cell_id, cos(radians(clat)) * cos(radians(clon)) AS x, cos(radians(clat)) * sin(radians(clon)) AS y,
              sin(radians(clat)) AS z FROM cells),
s AS (SELECT DISTINCT lat, lon FROM stations),
sv AS (SELECT lat, lon, cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y,
              sin(radians(lat)) AS z FROM s),
d AS (SELECT sv.lat, sv.lon, cv.cell_id,
             sqrt((sv.x - cv.x) * (sv.x - cv.x) + (sv.y - cv.y) * (sv.y - cv.y) + (sv.z - cv.z) * (sv.z - cv.z)) AS chord
      FROM sv, cv)
SELECT {r6('lat')} AS lat, {r6('lon')} AS lon, cell_id, {r6('2 * 6371.0 * asin(least(1.0, chord / 2))')} AS distance_km
FROM d QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY chord, cell_id) = 1"""


@query("pair_nearest_great_circle", _GC_SQL)
def pair_nearest_great_circle(spark, sf_dir):
    """J2 on the sphere: nearest cell of the distorted grid for every station
    by great-circle distance (cube-hashed unit vectors; oracle: brute force)."""
    return canon(pr.pair_nearest_great_circle(_curvi_cells(spark, sf_dir), tb.stations(spark, sf_dir)))
