"""Registered queries on grids with uneven or 2-D coordinates, model against
model, wide neighbourhoods and grouping sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pairing as pr
from ..operators.distribution import fractions_skill_score
from ..operators.stats import compute_statistics
from . import testbed as tb
from .metric_queries import _pearson
from .pairing_queries import _G_IDX, _corners_sql
from .registry import canon, query, r6, ts

# ------------------------------------------------------------- uneven axes

_ULAT = "((-80.0)::DOUBLE + 9.0::DOUBLE * k + 0.6::DOUBLE * ((k * 5) % 4))"
_ULON = "((-176.0)::DOUBLE + 9.5::DOUBLE * k + 1.3::DOUBLE * ((k * 7) % 5))"


def uneven_grid(spark, sf_dir):
    """The model on 18 x 36 lines at uneven places (8 to 12 degrees apart);
    the axes are found from the data."""
    li = tb.read(spark, sf_dir, "lineitem")
    a, b = F.col("l_partkey") % 18, F.col("l_suppkey") % 36
    return (li.select(tb.month("l_shipdate").alias("time"),
                      (F.lit(-80.0) + 9.0 * a + 0.6 * ((a * 5) % 4)).alias("lat"),
                      (F.lit(-176.0) + 9.5 * b + 1.3 * ((b * 7) % 5)).alias("lon"), "l_quantity")
              .groupBy("time", "lat", "lon").agg(F.avg("l_quantity").alias("v")))


def _axis_sql(c: str) -> str:
    """Lines of an axis with the bounds of their cells, half way to the next."""
    return f"""ax_{c} AS (
  SELECT x, lead(x) OVER (ORDER BY x) AS nx,
         coalesce((lag(x) OVER (ORDER BY x) + x) / 2, x - (lead(x) OVER (ORDER BY x) - x) / 2) AS lo,
         coalesce((lead(x) OVER (ORDER BY x) + x) / 2, x + (x - lag(x) OVER (ORDER BY x)) / 2) AS hi,
         lead(x) OVER (ORDER BY x) IS NULL AS last
  FROM (SELECT DISTINCT {c} AS x FROM ugrid))"""


_UGRID_SQL = f"""ugrid AS (
  SELECT time, list_transform([a], lambda k: {_ULAT})[1] AS lat, list_transform([b], lambda k: {_ULON})[1] AS lon, avg(q) AS v
  FROM (SELECT date_trunc('month', l_shipdate) AS time, l_partkey % 18 AS a, l_suppkey % 36 AS b, l_quantity AS q FROM lineitem)
  GROUP BY 1, 2, 3),
{_axis_sql('lat')},
{_axis_sql('lon')}"""


@query("pair_nearest_uneven", f"""WITH {_UGRID_SQL},
{tb.STATION_OBS_SQL},
near AS (
  SELECT s.lat, s.lon, a.x AS glat, b.x AS glon
  FROM (SELECT DISTINCT lat, lon FROM sobs) s
  JOIN ax_lat a ON s.lat >= a.lo AND (s.lat < a.hi OR (a.last AND s.lat = a.hi))
  JOIN ax_lon b ON s.lon >= b.lo AND (s.lon < b.hi OR (b.last AND s.lon = b.hi)))
SELECT s.site_id, {ts('s.time')} AS time, {r6('s.obs')} AS obs, {r6('g.v')} AS v
FROM sobs s LEFT JOIN near n ON s.lat = n.lat AND s.lon = n.lon
LEFT JOIN ugrid g ON g.time = s.time AND g.lat = n.glat AND g.lon = n.glon""")
def pair_nearest_uneven(spark, sf_dir):
    """J1 on unevenly spaced axes found from the data: cells reach half way to
    the next line, stations beyond the outermost cells get no value."""
    out = pr.pair_data(uneven_grid(spark, sf_dir), tb.station_obs(spark, sf_dir), "v", method="nearest")
    return canon(out.select("site_id", "time", "obs", "v"))


@query("pair_bilinear_uneven", f"""WITH {_UGRID_SQL},
{tb.STATION_OBS_SQL},
br AS (
  SELECT s.lat, s.lon, a.x AS a0, a.nx AS a1, (s.lat - a.x) / (a.nx - a.x) AS t, b.x AS b0, b.nx AS b1,
         (s.lon - b.x) / (b.nx - b.x) AS u
  FROM (SELECT DISTINCT lat, lon FROM sobs) s
  JOIN ax_lat a ON a.x <= s.lat AND s.lat < a.nx JOIN ax_lon b ON b.x <= s.lon AND s.lon < b.nx),
co AS (SELECT lat, lon, CASE WHEN di = 1 THEN a1 ELSE a0 END AS glat, CASE WHEN dj = 1 THEN b1 ELSE b0 END AS glon,
         (CASE WHEN di = 1 THEN t ELSE 1 - t END) * (CASE WHEN dj = 1 THEN u ELSE 1 - u END) AS w
       FROM br, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(di, dj)),
val AS (SELECT s.time, s.lat, s.lon, CASE WHEN count(g.v) = 4 THEN sum(c.w * g.v) END AS v
        FROM (SELECT DISTINCT time, lat, lon FROM sobs) s JOIN co c ON s.lat = c.lat AND s.lon = c.lon
        LEFT JOIN ugrid g ON g.time = s.time AND g.lat = c.glat AND g.lon = c.glon GROUP BY 1, 2, 3)
SELECT s.site_id, {ts('s.time')} AS time, {r6('s.obs')} AS obs, {r6('val.v')} AS v
FROM sobs s LEFT JOIN val ON s.time = val.time AND s.lat = val.lat AND s.lon = val.lon""")
def pair_bilinear_uneven(spark, sf_dir):
    """J3 between unevenly spaced lines."""
    out = pr.pair_data(uneven_grid(spark, sf_dir), tb.station_obs(spark, sf_dir), "v", method="bilinear")
    return canon(out.select("site_id", "time", "obs", "v"))


@query("regrid_conservative_uneven", f"""WITH {_UGRID_SQL},
{tb.grid_sql(15, 'grid15')},
wt AS (
  SELECT t.lat, t.lon, a.x AS glat, b.x AS glon,
         (least(b.hi, t.lon + 7.5) - greatest(b.lo, t.lon - 7.5))
         * (sin(radians(least(a.hi, t.lat + 7.5, 90.0))) - sin(radians(greatest(a.lo, t.lat - 7.5, -90.0)))) AS w
  FROM (SELECT DISTINCT lat, lon FROM grid15) t, ax_lat a, ax_lon b
  WHERE least(b.hi, t.lon + 7.5) > greatest(b.lo, t.lon - 7.5)
    AND least(a.hi, t.lat + 7.5, 90.0) > greatest(a.lo, t.lat - 7.5, -90.0))
SELECT {ts('g.time')} AS time, {r6('wt.lat')} AS lat, {r6('wt.lon')} AS lon, {r6('sum(wt.w * g.v) / sum(wt.w)')} AS v
FROM wt JOIN ugrid g ON g.lat = wt.glat AND g.lon = wt.glon GROUP BY g.time, wt.lat, wt.lon""")
def regrid_conservative_uneven(spark, sf_dir):
    """J5 from uneven cells (half way between lines) to 15 degree cells."""
    target = tb.model_grid(spark, sf_dir, step=15).select("lat", "lon")
    return canon(pr.pair_data(uneven_grid(spark, sf_dir), target, "v", method="conservative", target_step=(15.0, 15.0)))


# ------------------------------------------------------------- 2-D coordinates


def curved_grid(spark, sf_dir):
    """The model on 18 x 36 cells numbered by (y, x) whose coordinates bend."""
    li = tb.read(spark, sf_dir, "lineitem")
    y, x = F.col("l_partkey") % 18, F.col("l_suppkey") % 36
    lat, lon = F.lit(-85.0) + 10.0 * y, F.lit(-175.0) + 10.0 * x
    return (li.select(tb.month("l_shipdate").alias("time"), y.alias("y"), x.alias("x"),
                      (lat + 2.0 * F.sin(lon * 0.05)).alias("lat"), (lon + 3.0 * F.cos(lat * 0.05)).alias("lon"), "l_quantity")
              .groupBy("time", "y", "x", "lat", "lon").agg(F.avg("l_quantity").alias("v")))


_CURVED_SQL = """cgrid AS (
  SELECT time, y, x, ry + 2.0 * sin(rx * 0.05) AS lat, rx + 3.0 * cos(ry * 0.05) AS lon, avg(q) AS v
  FROM (SELECT date_trunc('month', l_shipdate) AS time, l_partkey % 18 AS y, l_suppkey % 36 AS x,
               (-85.0)::DOUBLE + 10.0::DOUBLE * (l_partkey % 18) AS ry, (-175.0)::DOUBLE + 10.0::DOUBLE * (l_suppkey % 36) AS rx,
               l_quantity AS q FROM lineitem) GROUP BY 1, 2, 3, 4, 5),
ccells AS (SELECT y, x, min(lat) AS lat, min(lon) AS lon FROM cgrid GROUP BY 1, 2)"""


@query("pair_nearest_2d", f"""WITH {_CURVED_SQL},
{tb.STATION_OBS_SQL},
near AS (
  SELECT s.lat, s.lon, c.y, c.x,
         power(cos(radians(s.lat)) * cos(radians(s.lon)) - cos(radians(c.lat)) * cos(radians(c.lon)), 2)
         + power(cos(radians(s.lat)) * sin(radians(s.lon)) - cos(radians(c.lat)) * sin(radians(c.lon)), 2)
         + power(sin(radians(s.lat)) - sin(radians(c.lat)), 2) AS d2
  FROM (SELECT DISTINCT lat, lon FROM sobs) s, ccells c
  QUALIFY row_number() OVER (PARTITION BY s.lat, s.lon ORDER BY d2, c.y, c.x) = 1)
SELECT s.site_id, {ts('s.time')} AS time, {r6('s.obs')} AS obs, {r6('g.v')} AS v
FROM sobs s LEFT JOIN near n ON s.lat = n.lat AND s.lon = n.lon AND 2 * 6371.0 * asin(least(1.0, sqrt(n.d2) / 2)) <= 600.0
LEFT JOIN cgrid g ON g.time = s.time AND g.y = n.y AND g.x = n.x""")
def pair_nearest_2d(spark, sf_dir):
    """Values of a 2-D grid at the nearest cell on the sphere, none
    farther than 600 km (oracle: brute force)."""
    out = pr.pair_data(curved_grid(spark, sf_dir), tb.station_obs(spark, sf_dir), "v", method="nearest", cell=("y", "x"),
                       limit_km=600.0)
    return canon(out.select("site_id", "time", "obs", "v"))


@query("pair_bilinear_2d", f"""WITH {_CURVED_SQL},
{tb.STATION_OBS_SQL},
qd AS (
  SELECT a.y, a.x, a.lon AS x0, a.lat AS y0, b.lon - a.lon AS bx, b.lat - a.lat AS by_, d.lon - a.lon AS cx, d.lat - a.lat AS cy,
         a.lon - b.lon + c.lon - d.lon AS dx, a.lat - b.lat + c.lat - d.lat AS dy,
         least(a.lon, b.lon, c.lon, d.lon) AS w, greatest(a.lon, b.lon, c.lon, d.lon) AS e,
         least(a.lat, b.lat, c.lat, d.lat) AS s, greatest(a.lat, b.lat, c.lat, d.lat) AS n
  FROM ccells a JOIN ccells b ON b.y = a.y AND b.x = a.x + 1 JOIN ccells c ON c.y = a.y + 1 AND c.x = a.x + 1
  JOIN ccells d ON d.y = a.y + 1 AND d.x = a.x),
k AS (SELECT t.lat, t.lon, q.y, q.x, bx, by_, dx, dy, cx, cy, t.lon - x0 AS hx, t.lat - y0 AS hy
      FROM (SELECT DISTINCT lat, lon FROM sobs) t JOIN qd q ON t.lon BETWEEN q.w AND q.e AND t.lat BETWEEN q.s AND q.n),
p AS (SELECT *, dx * cy - dy * cx AS k2, bx * cy - by_ * cx + hx * dy - hy * dx AS k1, hx * by_ - hy * bx AS k0 FROM k),
r AS (SELECT *, -0.5 * (k1 + sign(k1) * sqrt(k1 * k1 - 4 * k0 * k2)) AS q FROM p WHERE k1 * k1 - 4 * k0 * k2 >= 0),
vv AS (SELECT *, unnest([k0 / q, CASE WHEN k2 <> 0 THEN q / k2 END]) AS v FROM r),
uv AS (SELECT *, CASE WHEN abs(bx + dx * v) > abs(by_ + dy * v) THEN (hx - cx * v) / (bx + dx * v)
                      ELSE (hy - cy * v) / (by_ + dy * v) END AS u FROM vv),
hit AS (SELECT * FROM uv WHERE u BETWEEN -1e-9 AND 1 + 1e-9 AND v BETWEEN -1e-9 AND 1 + 1e-9
        QUALIFY row_number() OVER (PARTITION BY lat, lon ORDER BY y, x) = 1),
co AS (SELECT lat, lon, y + di AS y, x + dj AS x, (CASE WHEN di = 1 THEN v ELSE 1 - v END) * (CASE WHEN dj = 1 THEN u ELSE 1 - u END) AS w
       FROM hit, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(di, dj)),
val AS (SELECT s.time, s.lat, s.lon, CASE WHEN count(g.v) = 4 THEN sum(c.w * g.v) END AS v
        FROM (SELECT DISTINCT time, lat, lon FROM sobs) s JOIN co c ON s.lat = c.lat AND s.lon = c.lon
        LEFT JOIN cgrid g ON g.time = s.time AND g.y = c.y AND g.x = c.x GROUP BY 1, 2, 3)
SELECT s.site_id, {ts('s.time')} AS time, {r6('s.obs')} AS obs, {r6('val.v')} AS v
FROM sobs s LEFT JOIN val ON s.time = val.time AND s.lat = val.lat AND s.lon = val.lon""")
def pair_bilinear_2d(spark, sf_dir):
    """J3 on a 2-D grid: the quad around each station and its inverse bilinear
    weights (oracle: all quads, the quadratic solved in closed form)."""
    out = pr.pair_data(curved_grid(spark, sf_dir), tb.station_obs(spark, sf_dir), "v", method="bilinear", cell=("y", "x"))
    return canon(out.select("site_id", "time", "obs", "v"))


# ---------------------------------------------------- model against model, sets


@query("model_vs_model_scores", f"""WITH {tb.GRID_SQL},
{tb.grid_sql(15, 'grid15')},
{_G_IDX},
tcells AS (SELECT DISTINCT lat, lon FROM grid15),
{_corners_sql('tcells', '', 'tc')},
rg AS (SELECT g.time, tc.lat, tc.lon, CASE WHEN count(g.v) = 4 THEN sum(tc.w * g.v) END AS m
       FROM tc JOIN gidx g ON g.i = tc.i AND g.j = tc.j GROUP BY 1, 2, 3),
x AS (SELECT t.lat, t.v AS o, rg.m FROM grid15 t JOIN rg ON rg.time = t.time AND rg.lat = t.lat AND rg.lon = t.lon WHERE m IS NOT NULL)
SELECT {r6('lat')} AS lat, count(*) AS n, {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse, {r6('avg(m - o)')} AS mb,
       {r6(_pearson())} AS corr FROM x GROUP BY lat""")
def model_vs_model_scores(spark, sf_dir):
    """The 10 degree model regridded onto a 15 degree one, merged
    with the target's values and scored per latitude."""
    grid, target = tb.model_grid(spark, sf_dir), tb.model_grid(spark, sf_dir, step=15)
    both = pr.pair_data(grid, target, "v", method="regrid", merge_target=True, axes=tb.axes10(grid))
    return canon(compute_statistics(both, ["n", "rmse", "mb", "corr"], "v_target", "v_source", by=["lat"]).where("n > 0"))


_SETS = [("l_returnflag", "l_linestatus"), ("l_returnflag",), ()]


def _rollup_sql() -> str:
    parts = []
    for keys in _SETS:
        ks = [k if k in keys else "NULL" for k in _SETS[0]]
        gid = sum(1 << (1 - i) for i, k in enumerate(_SETS[0]) if k not in keys)
        by = f"GROUP BY {', '.join(keys)}" if keys else ""
        on = " AND ".join(f"p.{k} = c.{k}" for k in keys) or "TRUE"
        pks = [f"p.{k}" if k in keys else "NULL" for k in _SETS[0]]
        parts.append(f"""SELECT {pks[0]} AS l_returnflag, {pks[1]} AS l_linestatus, {gid} AS grouping_id, count(*) AS n,
  {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse, {r6(_pearson())} AS corr,
  {r6('1 - sum((m - o) * (m - o)) / nullif(sum((abs(m - ob) + abs(o - ob)) * (abs(m - ob) + abs(o - ob))), 0)')} AS ioa_m,
  {r6('1 - sum(abs(m - o)) / nullif(sum(abs(m - ob) + abs(o - ob)), 0)')} AS d1
FROM pairs p JOIN (SELECT {', '.join([*keys, 'avg(o) AS ob'])} FROM pairs {by}) c ON {on}
{"GROUP BY " + ", ".join(f"p.{k}" for k in keys) if keys else ""}""")
    return f"WITH {tb.PAIRS_SQL}\n" + "\nUNION ALL\n".join(parts)


@query("scores_rollup", _rollup_sql())
def scores_rollup(spark, sf_dir):
    """Grouping sets: scores per flag and status, per flag, and over all, with
    metrics centred on each set's own mean, in one call."""
    return canon(compute_statistics(tb.pairs(spark, sf_dir), ["n", "rmse", "corr", "ioa_m", "d1"], "o", "m",
                                    by=["l_returnflag", "l_linestatus"], grouping="rollup"))


def _fss_sql(ex: str, k: int, wrap: bool) -> str:
    n = float((2 * k + 1) ** 2)
    tj = "(((j + dj) % 36) + 36) % 36" if wrap else "j + dj"
    return f"""{ex},
nb AS (
  SELECT g, time, i + di AS ti, {tj} AS tj, f, o
  FROM ex, (SELECT a.range AS di, b.range AS dj FROM range({-k}, {k + 1}) a, range({-k}, {k + 1}) b)
  WHERE i + di BETWEEN 0 AND 17{'' if wrap else ' AND j + dj BETWEEN 0 AND 35'}),
fr AS (SELECT g, time, ti, tj, sum(f)::DOUBLE / {n}::DOUBLE AS pf, sum(o)::DOUBLE / {n}::DOUBLE AS po FROM nb GROUP BY 1, 2, 3, 4)"""


_FSS = "1 - sum((pf - po) * (pf - po)) / nullif(sum(pf * pf) + sum(po * po), 0)"


@query("fss_wide_seam", f"""WITH {tb.GRID_SQL},
{_fss_sql('''ex AS (
  SELECT 0 AS g, time, CAST(round((lat + 85.0) / 10.0) AS INTEGER) AS i, CAST(round((lon + 175.0) / 10.0) AS INTEGER) AS j,
         1 AS f, 0 AS o FROM grid WHERE v >= 30.0
  UNION ALL
  SELECT 0, time, CAST(round((lat + 85.0) / 10.0) AS INTEGER), (CAST(round((lon + 175.0) / 10.0) AS INTEGER) + 3) % 36, 0, 1
  FROM grid WHERE v >= 30.0)''', 6, True)}
SELECT {ts('t.time')} AS time, {r6(_FSS)} AS fss FROM (SELECT DISTINCT time FROM grid) t LEFT JOIN fr USING (time) GROUP BY t.time""")
def fss_wide_seam(spark, sf_dir):
    """M16 with a 13 x 13 neighbourhood that goes on over the seam of the
    longitudes; the 'observed' field is the model moved three cells east."""
    fc = tb.model_grid(spark, sf_dir)
    ob = fc.withColumn("lon", F.when(F.col("lon") + 30.0 > 180.0, F.col("lon") - 330.0).otherwise(F.col("lon") + 30.0))
    return canon(fractions_skill_score(fc, ob, "v", "v", threshold=30.0, k=6, by=["time"], axes=tb.axes10(fc), seam=True))


# --- fixed values: a published list of metric names ---
PUBLISHED = ["rmse", "mb", "mae", "mse", "mape", "ioa_m", "fac2", "r2", "d1", "e1", "ac", "fss", "wassersteindistance"]


def _published_sql() -> str:
    d, pe = "(m - o)", "(abs(m - ob) + abs(o - ob))"
    return f"""WITH {tb.PAIRS_SQL},
x AS (SELECT p.*, c.ob FROM pairs p JOIN (SELECT l_returnflag, avg(o) AS ob FROM pairs GROUP BY 1) c USING (l_returnflag)),
s AS (SELECT l_returnflag, {r6(f'sqrt(avg({d} * {d}))')} AS rmse, {r6(f'avg({d})')} AS mb, {r6(f'avg(abs({d}))')} AS mae,
  {r6(f'avg({d} * {d})')} AS mse, {r6(f'100.0 * avg(abs({d}) / abs(o))')} AS mape,
  {r6(f'1 - sum({d} * {d}) / sum({pe} * {pe})')} AS ioa_m, {r6('avg(CASE WHEN m / o BETWEEN 0.5 AND 2.0 THEN 1.0 ELSE 0.0 END)')} AS fac2,
  {r6(f'power({_pearson()}, 2)')} AS r2, {r6(f'1 - sum(abs({d})) / sum({pe})')} AS d1,
  {r6(f'1 - sum(abs({d})) / sum(abs(o - ob))')} AS e1,
  {r6('sum((m - ob) * (o - ob)) / sqrt(sum((m - ob) * (m - ob)) * sum((o - ob) * (o - ob)))')} AS ac FROM x GROUP BY 1),
a AS (SELECT l_returnflag, o, row_number() OVER (PARTITION BY l_returnflag ORDER BY o) AS r FROM pairs),
b AS (SELECT l_returnflag, m, row_number() OVER (PARTITION BY l_returnflag ORDER BY m) AS r FROM pairs),
w AS (SELECT a.l_returnflag, {r6('avg(abs(a.o - b.m))')} AS wassersteindistance FROM a JOIN b ON a.l_returnflag = b.l_returnflag
  AND a.r = b.r GROUP BY 1),
cell AS (SELECT l_returnflag AS g, time, CAST(round((lat + 85.0) / 10.0) AS INTEGER) AS i,
  CAST(round((lon + 175.0) / 10.0) AS INTEGER) AS j, max(m) AS m, max(o) AS o FROM pairs GROUP BY 1, 2, 3, 4),
{_fss_sql('''ex AS (SELECT g, time, i, j, 1 AS f, 0 AS o FROM cell WHERE m >= 60000.0
  UNION ALL SELECT g, time, i, j, 0, 1 FROM cell WHERE o >= 60000.0)''', 2, False)},
f AS (SELECT g AS l_returnflag, {r6(_FSS)} AS fss FROM fr GROUP BY 1)
SELECT s.*, f.fss, w.wassersteindistance FROM s JOIN w USING (l_returnflag) LEFT JOIN f USING (l_returnflag)"""


@query("published_metric_list", _published_sql())
def published_metric_list(spark, sf_dir):
    """A published metric list by name in one call."""
    df = tb.pairs(spark, sf_dir)
    out = compute_statistics(df, PUBLISHED, "o", "m", by=["l_returnflag"], options={"fss": {
        "threshold": 60000.0, "k": 2, "axes": tb.axes10(df)}})
    return canon(out)
