"""Mapping of the driver's star-schema tables onto verification inputs.

Each builder returns a lazy DataFrame derived from the given tables, so the
work of every registered query grows with the tables. The matching DuckDB
CTEs (``*_SQL``) state the same construction for the oracle.

* pairs: ``lineitem`` with obs ``o = l_extendedprice`` and model
  ``m = o*(1-l_discount)*(1+l_tax)``; second model ``m2 = o*(1-l_discount)``;
  synthetic coordinates ``lat = -85 + 10*(l_partkey % 18)``,
  ``lon = -175 + 10*(l_suppkey % 36)``; time = month of ``l_shipdate``;
  region = the supplier's nation's region.
* model grid: mean ``l_quantity`` per (month, lat, lon) cell on that 10 deg grid.
* stations: one per customer, coordinates from integer arithmetic (never
  equidistant from two cells); observations = orders' total price per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pairing import RegularAxis, grid_axes
from ..session import table_path

# The synthetic model grids are global by construction; their axes are part
# of the grid's definition (a sparse test table may not hold every value).
LAT10, LON10 = RegularAxis(-85.0, 10.0, 18), RegularAxis(-175.0, 10.0, 36, periodic=True)


def axes10(grid):
    return grid_axes(grid, lat_axis=LAT10, lon_axis=LON10)


_READS: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table; the DataFrame (a plan, no data) is reused per
    session so file listing and footer reads happen once."""
    # time keys are UTC instants; the oracle renders them in UTC too
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (id(spark), table_path(sf_dir, name))
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READS[key] = spark.read.parquet(key[1])
    return df


def month(c) -> "F.Column":
    return F.date_trunc("month", F.col(c).cast("timestamp"))


def nation_regions(spark, sf_dir) -> DataFrame:
    """nation -> region label (both tiny reference tables)."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "region")


def with_supplier_region(df: DataFrame, spark, sf_dir) -> DataFrame:
    """Fact rows -> supplier (join on the supplier key) -> nation/region label.
    Joining the fact table to one dimension at a time keeps the planner's
    size estimates sane (a pre-joined dimension chain is estimated as the
    product of its inputs and would make the fact side look smaller)."""
    sup = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    x = df.join(sup, df.l_suppkey == sup.s_suppkey).drop("s_suppkey")
    nr = nation_regions(spark, sf_dir)
    return x.join(nr, x.s_nationkey == nr.n_nationkey).drop("s_nationkey", "n_nationkey")


def pairs(spark, sf_dir, with_region: bool = False) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    o = F.col("l_extendedprice")
    df = li.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_suppkey", "l_partkey",
        month("l_shipdate").alias("time"),
        (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % 18)).alias("lat"),
        (F.lit(-175.0) + 10.0 * (F.col("l_suppkey") % 36)).alias("lon"),
        o.alias("o"),
        (o * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("m"),
        (o * (1 - F.col("l_discount"))).alias("m2"),
    )
    if with_region:
        df = with_supplier_region(df, spark, sf_dir)
    return df


PAIRS_SQL = """pairs AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_suppkey, l_partkey,
         date_trunc('month', l_shipdate) AS time,
         (-85.0)::DOUBLE + 10.0::DOUBLE * (l_partkey % 18) AS lat,
         (-175.0)::DOUBLE + 10.0::DOUBLE * (l_suppkey % 36) AS lon,
         l_extendedprice AS o,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS m,
         l_extendedprice * (1 - l_discount) AS m2
  FROM lineitem)"""

REGION_PAIRS_SQL = PAIRS_SQL + """,
sregion AS (
  SELECT s.s_suppkey, r.r_name AS region
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
rpairs AS (SELECT p.*, sr.region FROM pairs p JOIN sregion sr ON p.l_suppkey = sr.s_suppkey)"""


def model_grid(spark, sf_dir, step: int = 10) -> DataFrame:
    """Gridded 'model': mean quantity per (month, cell); a third of the
    cell-months are absent, which exercises the missing-corner rules."""
    li = read(spark, sf_dir, "lineitem")
    n_lat, n_lon = 180 // step, 360 // step
    first_lat, first_lon = -90 + step / 2, -180 + step / 2
    return (li.select(month("l_shipdate").alias("time"),
                      (F.lit(first_lat) + step * (F.col("l_partkey") % n_lat)).alias("lat"),
                      (F.lit(first_lon) + step * (F.col("l_suppkey") % n_lon)).alias("lon"),
                      "l_quantity")
              .groupBy("time", "lat", "lon").agg(F.avg("l_quantity").alias("v")))


def grid_sql(step: int = 10, name: str = "grid") -> str:
    n_lat, n_lon = 180 // step, 360 // step
    first_lat, first_lon = -90 + step / 2, -180 + step / 2
    return f"""{name} AS (
  SELECT date_trunc('month', l_shipdate) AS time,
         ({first_lat})::DOUBLE + ({step})::DOUBLE * (l_partkey % {n_lat}) AS lat,
         ({first_lon})::DOUBLE + ({step})::DOUBLE * (l_suppkey % {n_lon}) AS lon,
         avg(l_quantity) AS v
  FROM lineitem GROUP BY 1, 2, 3)"""


GRID_SQL = grid_sql(10)


def stations(spark, sf_dir) -> DataFrame:
    """One site per customer at a pseudo-random position (0.1 deg steps
    offset by 0.05, so never on a cell edge of a 10 or 15 deg grid)."""
    c = read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("site_id"),
                    (F.lit(-84.95) + ((F.col("c_custkey") * 37) % 1690) / 10.0).alias("lat"),
                    (F.lit(-174.95) + ((F.col("c_custkey") * 91) % 3490) / 10.0).alias("lon"))


STATIONS_SQL = """stations AS (
  SELECT c_custkey AS site_id,
         (-84.95)::DOUBLE + ((c_custkey * 37) % 1690)::DOUBLE / 10.0::DOUBLE AS lat,
         (-174.95)::DOUBLE + ((c_custkey * 91) % 3490)::DOUBLE / 10.0::DOUBLE AS lon
  FROM customer)"""


def station_obs(spark, sf_dir) -> DataFrame:
    """Observations: mean order total per (customer site, month)."""
    o = read(spark, sf_dir, "orders")
    obs = (o.select(F.col("o_custkey").alias("site_id"), month("o_orderdate").alias("time"),
                    "o_totalprice")
            .groupBy("site_id", "time").agg(F.avg("o_totalprice").alias("obs")))
    return obs.join(stations(spark, sf_dir), "site_id")


STATION_OBS_SQL = STATIONS_SQL + """,
sobs AS (
  SELECT s.site_id, x.time, s.lat, s.lon, x.obs
  FROM (SELECT o_custkey AS site_id, date_trunc('month', o_orderdate) AS time,
               avg(o_totalprice) AS obs
        FROM orders GROUP BY 1, 2) x JOIN stations s ON x.site_id = s.site_id)"""


def events(spark, sf_dir) -> DataFrame:
    """Event stream as a paired point series: obs = value, model = value
    perturbed by the user id; time as a UTC timestamp."""
    e = read(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("time"), "user_id", "event_type",
                    F.col("value").alias("o"),
                    (F.col("value") + (F.col("user_id") % 7 - 3) * 0.5).alias("m"))


EVENTS_SQL = """ev AS (
  SELECT event_id, ts AS time, user_id, event_type, value AS o,
         value + ((user_id % 7) - 3)::DOUBLE * 0.5::DOUBLE AS m
  FROM events)"""
