"""Registered region queries (J11, J12, F4-F6, M25) with polygon regions."""

from __future__ import annotations

from ..operators import pairing as pr
from ..operators.regions import label_regions, region_table
from ..operators.stats import compute_statistics
from . import testbed as tb
from .pairing_queries import NEAREST_SQL_CTES
from .registry import canon, query, r6

# --- fixed values: test fixture polygons (name, priority, [(lat, lon), ...]) ---
# Our own fixture: five rings with slanted edges; "tropics" overlaps the others
# and loses by priority; some stations fall in no polygon (NULL label).
REGIONS = [
    ("arctic", 1, [(60, -180), (90, -180), (90, 180), (60, 180), (70, 0)]),
    ("americas", 2, [(-60, -120), (-60, -30), (15, -50), (75, -60), (75, -170), (20, -120)]),
    ("europe_africa", 3, [(-40, -20), (-40, 55), (40, 60), (72, 45), (72, -25), (35, -20)]),
    ("asia_oceania", 4, [(-50, 100), (-50, 180), (75, 180), (75, 50), (30, 55), (0, 90)]),
    ("tropics", 5, [(-23.5, -180), (-23.5, 180), (23.5, 180), (23.5, -180)]),
]


def _verts_sql() -> str:
    rows = ",\n    ".join(f"('{n}', {p}, {k}, {float(a)!r}, {float(b)!r})"
                          for n, p, poly in REGIONS for k, (a, b) in enumerate(poly))
    return f"""verts AS (SELECT * FROM (VALUES
    {rows}) v(name, priority, k, lat, lon)),
edges AS (
  SELECT name, priority, lat AS y1, lon AS x1,
         coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2,
         coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2
  FROM verts
  WINDOW w AS (PARTITION BY name ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def labels_sql(sites: str, out: str = "labels") -> str:
    return f"""{_verts_sql()},
{out}_c AS (
  SELECT s.lat, s.lon, e.name, e.priority,
         sum(CASE WHEN ((e.y1 > s.lat) <> (e.y2 > s.lat))
                   AND s.lon < (e.x2 - e.x1) * (s.lat - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) AS crossings
  FROM (SELECT DISTINCT lat, lon FROM {sites}) s, edges e
  GROUP BY 1, 2, 3, 4),
{out} AS (
  SELECT lat, lon, arg_min(name, priority) AS region FROM {out}_c WHERE crossings % 2 = 1 GROUP BY 1, 2)"""


@query("region_labels", f"""WITH {tb.STATIONS_SQL},
{labels_sql('stations')}
SELECT s.site_id, {r6('s.lat')} AS lat, {r6('s.lon')} AS lon, l.region
FROM stations s LEFT JOIN labels l ON s.lat = l.lat AND s.lon = l.lon""")
def region_labels(spark, sf_dir):
    """Polygon region label for every station (NULL outside all)."""
    regions = region_table(spark, REGIONS)
    return canon(label_regions(tb.stations(spark, sf_dir), regions).select("site_id", "lat", "lon", "region"))


@query("pair_region_scores", f"""WITH {NEAREST_SQL_CTES},
{labels_sql('sobs')},
x AS (SELECT l.region, n.obs AS o, n.v AS m FROM nearest n
      LEFT JOIN labels l ON n.lat = l.lat AND n.lon = l.lon
      WHERE n.obs IS NOT NULL AND n.v IS NOT NULL)
SELECT region, count(*) AS n, {r6('sqrt(avg((m - o) * (m - o)))')} AS rmse, {r6('avg(m - o)')} AS mb,
       {r6('CASE WHEN count(*) >= 2 AND stddev_samp(o) > 0 AND stddev_samp(m) > 0 THEN covar_samp(o, m) / (stddev_samp(o) * stddev_samp(m)) END')} AS corr
FROM x GROUP BY region""")
def pair_region_scores(spark, sf_dir):
    """The whole chain: scan -> nearest pairing -> polygon region label ->
    one grouped aggregate of rmse / mb / r per region (NULL = unlabelled)."""
    grid = tb.model_grid(spark, sf_dir)
    obs = tb.station_obs(spark, sf_dir)
    paired = label_regions(pr.pair_nearest(grid, obs, "v", axes=tb.axes10(grid)), region_table(spark, REGIONS))
    return canon(compute_statistics(paired, ["n", "rmse", "mb", "corr"], "obs", "v", by=["region"]))
