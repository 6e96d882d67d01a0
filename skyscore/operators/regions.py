"""Region labels and region filters.

A region table has ``name STRING, priority INT, poly ARRAY<STRUCT<lat, lon>>``
(the ring is closed implicitly). Labelling runs on the **distinct** site
coordinates only:

1. every ring becomes a table of its edges, each dealt to the columns of
   longitude it spans, every site to its column -> hash equi join on the column
   (no nested loop over sites x polygons, no ring copied whole);
2. the ray goes north along the site's meridian: an edge that spans the meridian
   north of the site counts once, and the parity of the count, a partial
   aggregate, says inside or outside. Meridians do not cross the date line, so
   edges over it are only cut into two ranges of longitude;
3. overlapping polygons: the lowest ``priority`` wins (``min`` of the regions'
   numbers in that order: aggregates of fixed width, hashed and not sorted);
   no match -> NULL label;
4. the labels are joined back to the data rows on the site, and a salt where it
   has many rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLY_TYPE = T.ArrayType(T.StructType([T.StructField("lat", T.DoubleType()),
                                      T.StructField("lon", T.DoubleType())]))
REGION_SCHEMA = T.StructType([T.StructField("name", T.StringType()),
                              T.StructField("priority", T.IntegerType()),
                              T.StructField("poly", POLY_TYPE)])


def region_table(spark, regions) -> DataFrame:
    """Regions from ``[(name, priority, [(lat, lon), ...]), ...]``."""
    rows = [(n, int(p), [(float(a), float(b)) for a, b in poly]) for n, p, poly in regions]
    return spark.createDataFrame(rows, REGION_SCHEMA)


def point_in_polygon(lat: Column, lon: Column, poly: Column) -> Column:
    """Even-odd ray casting (ray towards +lon). Edges pair each vertex
    with the next one, the last with the first."""
    n = F.size(poly)
    nxt = F.concat(F.slice(poly, 2, n - 1), F.slice(poly, 1, 1))
    edges = F.zip_with(poly, nxt, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def step(acc, e):
        y1, x1 = e["a"]["lat"], e["a"]["lon"]
        y2, x2 = e["b"]["lat"], e["b"]["lon"]
        straddles = (y1 > lat) != (y2 > lat)
        # evaluated only when the edge straddles the ray, so y2 != y1
        x_cross = (x2 - x1) * (lat - y1) / F.when(straddles, y2 - y1) + x1
        return acc + F.when(straddles & (lon < x_cross), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), step) % 2 == 1


def ring_edges(regions: DataFrame) -> DataFrame:
    """``name, priority, ring, x1, y1, x2, y2``: the edges of every ring, each
    vertex with the next and the last with the first; an edge of more than 180
    (and less than 360) degrees of longitude goes the short way, over the date
    line. ``x1`` lies in [-180, 180]; edges that leave that range are there
    again 360 degrees off. Repeated regions count once."""
    r = regions.select("name", "priority", "poly").distinct()
    n = F.size("poly")
    pairs = F.transform("poly", lambda v, i: F.struct(v.alias("a"), F.get("poly", (i + 1) % n).alias("b")))
    e = r.select("name", "priority", F.xxhash64("name", "priority", "poly").alias("ring"), F.explode(pairs).alias("e"))
    gap = F.col("e.b.lon") - F.col("e.a.lon")
    short = F.when((F.abs(gap) > 180.0) & (F.abs(gap) < 360.0), gap - F.signum(gap) * 360.0).otherwise(gap)
    x1 = F.col("e.a.lon")
    home = F.when(x1.between(-180.0, 180.0), x1).otherwise(F.pmod(x1 + 180.0, F.lit(360.0)) - 180.0)
    e = e.select("name", "priority", "ring", home.alias("x1"), F.col("e.a.lat").alias("y1"), (home + short).alias("x2"),
                 F.col("e.b.lat").alias("y2"))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    turns = F.filter(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0)),
                     lambda t: (low + t < 180.0) & (high + t > -180.0) & (low < high))
    e = e.withColumn("__t", F.explode(turns))
    return e.withColumns({"x1": F.col("x1") + F.col("__t"), "x2": F.col("x2") + F.col("__t")}).drop("__t")


def label_regions(df: DataFrame, regions: DataFrame, lat: str = "lat", lon: str = "lon",
                  label: str = "region", tile: float = 1.0) -> DataFrame:
    """Add a string column ``label`` naming the region of each row.
    Longitudes of any range; ``tile`` is the width of a column."""
    from .stats import join_group_values
    sites = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(lat, lon).agg(F.count(F.lit(1)).alias("__rows"))
    x = F.when(F.col(lon).between(-180.0, 179.9999999), F.col(lon)).otherwise(
        F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0)
    st = sites.withColumn("__x", x).withColumn("__col", F.floor(F.col("__x") / tile).cast("int"))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    columns = F.sequence(F.floor(F.greatest(low, F.lit(-180.0)) / tile).cast("int"),
                         F.floor(F.least(high, F.lit(180.0)) / tile).cast("int"))
    # numbers in the order of choice, so that whatever is grouped has a fixed width
    named = regions.select("name", "priority").distinct().withColumn(
        "__rank", F.row_number().over(Window.orderBy("priority", "name")))
    numbered = ring_edges(regions).join(F.broadcast(named.withColumnsRenamed({"name": "__n", "priority": "__p"})),
                                        F.col("name").eqNullSafe(F.col("__n")) & F.col("priority").eqNullSafe(F.col("__p")))
    edges = numbered.select("__rank", "ring", "x1", "y1", "x2", "y2", F.explode(columns).alias("__col"))
    at = F.col("y1") + (F.col("y2") - F.col("y1")) * (F.col("__x") - F.col("x1")) / (F.col("x2") - F.col("x1"))
    met = st.join(edges, "__col").where(((F.col("x1") > F.col("__x")) != (F.col("x2") > F.col("__x")))).where(
        at > F.col(lat))
    inside = met.groupBy(lat, lon, "__rows", "__rank", "ring").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    best = inside.groupBy(lat, lon, "__rows").agg(F.min("__rank").alias("__rank"))
    best = best.join(F.broadcast(named), "__rank").select(lat, lon, "__rows", F.col("name").alias(label))
    return join_group_values(df, best, [lat, lon], how="left", rows="__rows")


def find_region_column(df: DataFrame, region_col: str | None = None) -> str:
    """the explicit column, else the first string column; error if none."""
    if region_col:
        if region_col not in df.columns:
            raise ValueError(f"region column {region_col!r} not found")
        return region_col
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            return f.name
    raise ValueError("no region label column (string-typed) in the dataset")


def filter_region(df: DataFrame, region: str, region_col: str | None = None) -> DataFrame:
    """rows whose label equals ``region``."""
    return df.where(F.col(find_region_column(df, region_col)) == F.lit(region))


def missing_regions(df: DataFrame, requested, region_col: str) -> DataFrame:
    """requested regions that have no rows (to be reported and skipped)."""
    spark = df.sparkSession
    req = spark.createDataFrame([(r,) for r in requested], f"{region_col} string")
    return req.join(df.select(region_col).distinct(), region_col, "left_anti")


def safe_region_name(c, for_plots: bool = True) -> Column:
    """K5 sanitisers: plots replace ``[^a-zA-Z0-9\\-.]`` by ``_``; statistics
    replace spaces only."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"[^a-zA-Z0-9\-.]", "_") if for_plots else F.regexp_replace(c, " ", "_")


def render_name(template: str, region: str, for_plots: bool = True) -> str:
    """K5: fill ``{region}`` in an output name (error when it is missing)."""
    if "{region}" not in template:
        raise ValueError("savename must contain '{region}' when regions are given")
    safe = re.sub(r"[^a-zA-Z0-9\-.]", "_", region) if for_plots else region.replace(" ", "_")
    return template.replace("{region}", safe)
