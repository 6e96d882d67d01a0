"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _tag(edges: DataFrame):
    """Count and order-free checksum of an edge table."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()


def components(edges: DataFrame) -> DataFrame:
    """``v, comp`` for every end of ``edges`` (``a, b``, of one orderable type):
    ``comp`` is the least vertex that ``v`` reaches. Vertices without an edge
    do not appear. The tables between the steps are written to the shared
    folder; only a count and a checksum of them reach the driver."""
    e = written(edges.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    tag = _tag(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("_v")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: every greater neighbour of a vertex to its least one
        large = (both.filter("b > a").join(low, F.col("a") == F.col("_v"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: every lesser neighbour and the vertex itself to the least one
        least = large.groupBy(F.col("a").alias("_v")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("_v"))
        e = written(small.select("a", F.col("m").alias("b"))
                    .unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
                    .distinct(), "edges")
        new = _tag(e)
        if new == tag:
            break
        tag = new
    return e.select(F.col("a").alias("v"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("v"), F.col("b").alias("comp")).distinct())


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of further ``links`` together with those that gave
    ``comps``, written: only the components' own names are joined, so the steps
    run over the new links alone. No new links: ``comps``."""
    if links.isEmpty():
        return comps
    d = links.select("a", "b")
    for end in "ab":
        name = comps.select(F.col("v").alias("_v"), F.col("comp").alias("_c"))
        d = d.join(name, F.col(end) == F.col("_v"), "left").withColumn(end, F.coalesce("_c", end)).drop("_v", "_c")
    over = components(d).select(F.col("v").alias("_v"), F.col("comp").alias("_c"))
    # a name that is in no row of comps is a vertex without an edge so far
    return written(comps.join(over, F.col("comp") == F.col("_v"), "full").select(
        F.coalesce("v", "_v").alias("v"), F.coalesce("_c", "comp").alias("comp")), "components")
