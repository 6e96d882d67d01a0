"""Grids with 2-D coordinates (J2, J3): nearest cell and bilinear quads.

Nearest: the cells lie in a pyramid of tiles, each tile with the box around its
cells. A site first walks down the nearest boxes to one cell, whose distance
bounds the search; then it descends again into every box within that distance.
Both descents are flat equi joins on the tile (boxes of a level are broadcast
where their written size allows), bounds are plain columns, and the walk keeps
one row a site and level. The number of levels follows from the number of cells.

Bilinear: four neighbouring cells make a quad. Quads are dealt to square tiles
of about their own size (so a quad touches four tiles at most, however sizes
vary over the grid), a site looks into its tile of every size, and the inverse
bilinear map, solved by Newton steps as a fold, says whether it is inside and
with which weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: a tile splits into this many parts (a power of two) along each axis
_FAN_BITS = 2
#: bits of a tile's place along one axis
_BITS = 21


def _known(*names: str) -> Column:
    out = F.lit(True)
    for c in names:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


def _parent(tile: Column, axes: int) -> Column:
    mask = (1 << _BITS) - 1
    out = F.lit(0).cast("long")
    for a in range(axes):
        place = F.shiftright(F.shiftright(tile, _BITS * a).bitwiseAND(F.lit(mask)), _FAN_BITS)
        out = out + F.shiftleft(place, _BITS * a)
    return out


def _to_box(q: list[Column]) -> Column:
    """Squared distance from ``q`` to a tile's box."""
    gaps = [F.greatest(F.col(f"lo{a}") - x, x - F.col(f"hi{a}"), F.lit(0.0)) for a, x in enumerate(q)]
    return sum(g * g for g in gaps)


def nearest_by_tiles(cells: DataFrame, sites: DataFrame, lat: str, lon: str, cell_id: str, point,
                     leaf: float | None = None) -> DataFrame:
    """Nearest cell of each distinct site by straight distance between
    ``point(lat, lon)`` (a list of Columns): ``lat, lon, cell_id, __d2``.

    The driver sees one row: count and extent of the cells. ``leaf`` asks for
    last tiles of at most that side (otherwise about one cell a tile). Sites
    with a missing coordinate, and all sites when there are no cells, get a
    NULL cell. Cells with a missing coordinate are not considered. Ties take
    the least ``cell_id``."""
    wanted = sites.select(lat, lon).distinct()
    k = len(point(F.lit(0.0), F.lit(0.0)))
    at = [f"p{a}" for a in range(k)]
    cl = cells.where(_known(lat, lon)).select(
        F.col(cell_id).alias("__id"), *[p.alias(n) for n, p in zip(at, point(F.col(lat), F.col(lon)))])
    ext = cl.agg(F.count(F.lit(1)), *[F.min(c) for c in at], *[F.max(c) for c in at]).first()
    n, low, high = ext[0], ext[1:k + 1], ext[k + 1:]
    none = [F.lit(None).cast(cells.schema[cell_id].dataType).alias(cell_id), F.lit(None).cast("double").alias("__d2")]
    if n == 0:
        return wanted.select(lat, lon, *none)
    side = max(h - x for h, x in zip(high, low)) * (1 + 1e-9) or 1.0
    levels = math.ceil(math.log(side / leaf, 1 << _FAN_BITS) if leaf else math.log(n, 1 << 2 * _FAN_BITS))
    levels = min(max(1, levels), (_BITS - 1) // _FAN_BITS)
    slack = 1e-12 * (side + max(map(abs, [*low, *high])))
    parts = 1 << _FAN_BITS * levels
    tile = sum((F.shiftleft(F.least(F.floor((F.col(c) - x) * (parts / side)), F.lit(parts - 1)).cast("long"), _BITS * a)
                for a, (c, x) in enumerate(zip(at, low))), F.lit(0).cast("long"))
    # cells in one place count once
    cl = materialise(cl.groupBy(tile.alias("tile"), *at).agg(F.min("__id").alias("__id")), "cells")

    def boxes(d: DataFrame, key: Column, lo, hi) -> DataFrame:
        return d.groupBy(key.alias("tile")).agg(*[F.min(c).alias(f"lo{a}") for a, c in enumerate(lo)],
                                                *[F.max(c).alias(f"hi{a}") for a, c in enumerate(hi)])
    level = boxes(cl, F.col("tile"), at, at)
    pyramid = None
    for t in range(levels, 0, -1):
        rows = level.select(F.lit(t).alias("level"), "tile", _parent(F.col("tile"), k).alias("up"),
                            *[f"{s}{a}" for s in ("lo", "hi") for a in range(k)])
        pyramid = rows if pyramid is None else pyramid.unionByName(rows)
        level = boxes(level, _parent(F.col("tile"), k), [f"lo{a}" for a in range(k)], [f"hi{a}" for a in range(k)])
    pyramid = materialise(pyramid, "tiles", ("level",))
    tables = {}
    for t in range(1, levels + 1):
        d = pyramid.where(F.col("level") == t).drop("level")
        # the two top levels hold a bounded number of tiles
        tables[t] = F.broadcast(d) if t <= 2 else d

    q = point(F.col(lat), F.col(lon))
    known = wanted.where(_known(lat, lon))
    here = known.withColumn("__tile", F.lit(0).cast("long"))
    for t in range(1, levels + 1):
        here = here.join(tables[t], F.col("__tile") == F.col("up")).groupBy(lat, lon).agg(
            F.min(F.struct(_to_box(q).alias("d"), F.col("tile"))).alias("__b")).select(
            lat, lon, F.col("__b.tile").alias("__tile"))
    d2 = sum((x - F.col(c)) * (x - F.col(c)) for x, c in zip(q, at))
    found = here.join(cl, F.col("__tile") == F.col("tile")).groupBy(lat, lon).agg(F.min(d2).alias("__d2"))
    # the sites with their bounds are read once more from here
    held = materialise(found.select(lat, lon, F.pow(F.sqrt("__d2") + slack, 2).alias("__reach")), "reach").withColumn(
        "__tile", F.lit(0).cast("long"))
    for t in range(1, levels + 1):
        held = held.join(tables[t], F.col("__tile") == F.col("up")).where(_to_box(q) <= F.col("__reach")).select(
            lat, lon, "__reach", F.col("tile").alias("__tile"))
    best = (held.join(cl, F.col("__tile") == F.col("tile")).groupBy(lat, lon)
            .agg(F.min(F.struct(d2.alias("d2"), F.col("__id"))).alias("__b"))
            .select(lat, lon, F.col("__b.__id").alias(cell_id), F.col("__b.d2").alias("__d2")))
    return best.unionByName(wanted.where(~_known(lat, lon)).select(lat, lon, *none))


def pair_nearest_curvilinear(cells: DataFrame, sites: DataFrame, lat="lat", lon="lon",
                             cell_id: str = "cell_id", tile: float | str = "auto") -> DataFrame:
    """J2 on a plane: nearest cell of a 2-D (curvilinear) grid for each distinct
    site by Euclidean distance of the two coordinates (projected coordinates, or
    degrees on a small region: it knows neither the date line nor the shrinking
    of longitude; :func:`pair_nearest_great_circle` does). See
    :func:`nearest_by_tiles`; ``tile`` bounds the side of the last tiles."""
    out = nearest_by_tiles(cells, sites, lat, lon, cell_id,
                           lambda a, b: [a.cast("double"), b.cast("double")], None if tile == "auto" else float(tile))
    return out.select(lat, lon, cell_id, F.sqrt("__d2").alias("distance"))


def _unit_vector(lat: Column, lon: Column) -> list[Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def pair_nearest_great_circle(cells: DataFrame, sites: DataFrame, lat="lat", lon="lon",
                              cell_id: str = "cell_id") -> DataFrame:
    """J2 on the sphere: nearest cell by great-circle distance (exact across
    the date line and at the poles; any range of longitudes). Points become
    unit vectors; the nearest by chord is the nearest by arc. See
    :func:`nearest_by_tiles`. Output distance in kilometres (R = 6371 km)."""
    out = nearest_by_tiles(cells, sites, lat, lon, cell_id, _unit_vector)
    arc_km = 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt("__d2") / 2))
    return out.select(lat, lon, cell_id, F.when(F.col("__d2").isNotNull(), arc_km).alias("distance_km"))


def cells_2d(model: DataFrame, cell: tuple[str, str], lat: str, lon: str) -> DataFrame:
    """``__i, __j, lat, lon`` of the cells of a model table whose cells are
    numbered by the columns ``cell`` (row, column); the coordinates of a cell
    do not change (the least is taken where they do)."""
    g = model.groupBy(F.col(cell[0]).cast("long").alias("__i"), F.col(cell[1]).cast("long").alias("__j"))
    return g.agg(F.min(F.struct(lat, lon)).alias("__p")).select("__i", "__j", f"__p.{lat}", f"__p.{lon}")


def nearest_2d(cells: DataFrame, sites: DataFrame, lat="lat", lon="lon", limit_km: float | None = None) -> DataFrame:
    """``lat, lon, __i, __j, distance_km``: nearest cell (of :func:`cells_2d`)
    of each distinct site on the sphere; none beyond ``limit_km``."""
    numbered = cells.select(F.struct("__i", "__j").alias("__c"), lat, lon)
    out = pair_nearest_great_circle(numbered, sites, lat, lon, "__c")
    near = F.lit(True) if limit_km is None else F.col("distance_km") <= float(limit_km)
    return out.select(lat, lon, *[F.when(near, F.col(f"__c.{c}")).alias(c) for c in ("__i", "__j")], "distance_km")


_CORNERS = ((0, 0), (0, 1), (1, 1), (1, 0))
#: Newton steps; quadratic convergence from the middle of a quad
_STEPS = 12


def quads(cells: DataFrame, lat="lat", lon="lon") -> DataFrame:
    """One row for every four cells ``(i, j), (i, j+1), (i+1, j+1), (i+1, j)``
    that all have coordinates: ``__qi, __qj`` (the first), ``la0..la3``,
    ``lo0..lo3`` (longitudes counted on from the first corner's, so a quad may
    lie over the date line). One aggregate, no join."""
    corners = F.array(*[F.struct((F.col("__i") - di).alias("i"), (F.col("__j") - dj).alias("j"), F.lit(c).alias("c"))
                        for c, (di, dj) in enumerate(_CORNERS)])
    d = cells.where(_known(lat, lon)).select(F.explode(corners).alias("__q"), F.col(lat).cast("double").alias("la"),
                                             F.col(lon).cast("double").alias("lo"))
    d = d.groupBy(F.col("__q.i").alias("__qi"), F.col("__q.j").alias("__qj")).agg(
        F.count(F.lit(1)).alias("__n"), *[F.max(F.when(F.col("__q.c") == c, F.col(v))).alias(f"{v}{c}")
                                          for c in range(4) for v in ("la", "lo")])
    first = F.pmod(F.col("lo0") + 180.0, F.lit(360.0)) - 180.0
    turned = {f"lo{c}": first + F.pmod(F.col(f"lo{c}") - F.col("lo0") + 180.0, F.lit(360.0)) - 180.0 for c in range(1, 4)}
    return d.where("__n = 4").drop("__n").withColumns({**turned, "lo0": first})


def _inverse(x: Column, y: Column) -> Column:
    """``u`` (along columns) and ``v`` (along rows) of a point in a quad: Newton
    steps of the bilinear map; NULL where a step has no solution."""
    def parts(n):
        a, b, c, d = (F.col(f"{n}{k}") for k in range(4))
        return a, b - a, d - a, c - b - d + a  # constant, u, v, uv
    a1, b1, c1, d1 = parts("lo")
    a2, b2, c2, d2 = parts("la")

    def step(s, _):
        u, v = s["u"], s["v"]
        e1, e2 = a1 + b1 * u + c1 * v + d1 * u * v - x, a2 + b2 * u + c2 * v + d2 * u * v - y
        j11, j12, j21, j22 = b1 + d1 * v, c1 + d1 * u, b2 + d2 * v, c2 + d2 * u
        det = j11 * j22 - j12 * j21
        return F.struct((u - F.try_divide(j22 * e1 - j12 * e2, det)).alias("u"),
                        (v - F.try_divide(j11 * e2 - j21 * e1, det)).alias("v"))
    start = F.struct(F.lit(0.5).alias("u"), F.lit(0.5).alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), start, step)


def corners_2d(cells: DataFrame, sites: DataFrame, lat="lat", lon="lon", keys=()) -> DataFrame:
    """Each distinct site inside the grid -> the four cells of its quad
    (``lat, lon, __i, __j, __w``). A site on an edge belongs to the quad of the
    least number. Quads around a pole are not found (their corners go round all
    longitudes)."""
    q = quads(cells, lat, lon)
    la, lo = [F.col(f"la{c}") for c in range(4)], [F.col(f"lo{c}") for c in range(4)]
    q = q.select("*", F.least(*la).alias("__s"), F.greatest(*la).alias("__n"), F.least(*lo).alias("__w"),
                 F.greatest(*lo).alias("__e"))
    size = F.ceil(F.log2(F.greatest(F.col("__n") - F.col("__s"), F.col("__e") - F.col("__w"), F.lit(1e-6)))).cast("int")
    q = materialise(q.where(F.col("__e") - F.col("__w") < 180.0).withColumn("__size", size), "quads")
    sizes = q.select(F.collect_set("__size").alias("s")).scalar()
    side = F.pow(F.lit(2.0), F.col("__size"))
    # longitudes of sites are in [-180, 180): a quad over the seam is there twice
    turns = F.filter(F.array(*[F.lit(t) for t in (-360.0, 0.0, 360.0)]),
                     lambda t: (F.col("__w") + t < 180.0) & (F.col("__e") + t >= -180.0))
    q = q.withColumn("__turn", F.explode(turns))
    q = q.withColumns({f"lo{c}": F.col(f"lo{c}") + F.col("__turn") for c in range(4)}).withColumns(
        {c: F.col(c) + F.col("__turn") for c in ("__w", "__e")})

    def tiles(a, b):
        return F.sequence(F.floor(F.col(a) / side).cast("long"), F.floor(F.col(b) / side).cast("long"))
    q = q.withColumn("__ty", F.explode(tiles("__s", "__n"))).withColumn("__tx", F.explode(tiles("__w", "__e")))
    x = F.pmod(F.col(lon).cast("double") + 180.0, F.lit(360.0)) - 180.0
    s = sites.select(lat, lon).distinct().where(_known(lat, lon)).withColumns({"__x": x, "__size": F.explode(sizes)})
    s = s.withColumns({"__ty": F.floor(F.col(lat) / side).cast("long"), "__tx": F.floor(F.col("__x") / side).cast("long")})
    y = F.col(lat).cast("double")
    d = s.join(q, ["__size", "__ty", "__tx"]).where(
        y.between(F.col("__s") - 1e-9, F.col("__n") + 1e-9) & F.col("__x").between(F.col("__w") - 1e-9, F.col("__e") + 1e-9))
    d = d.select(lat, lon, "__qi", "__qj", _inverse(F.col("__x"), y).alias("__uv")).where(
        F.col("__uv.u").between(-1e-9, 1 + 1e-9) & F.col("__uv.v").between(-1e-9, 1 + 1e-9))
    d = d.groupBy(lat, lon).agg(F.min(F.struct("__qi", "__qj", "__uv")).alias("__q"))
    u, v = F.col("__q.__uv.u"), F.col("__q.__uv.v")
    four = F.array(*[F.struct((F.col("__q.__qi") + di).alias("i"), (F.col("__q.__qj") + dj).alias("j"),
                              ((v if di else 1 - v) * (u if dj else 1 - u)).alias("w")) for di, dj in _CORNERS])
    return d.select(lat, lon, F.explode(four).alias("__c")).select(
        lat, lon, F.col("__c.i").alias("__i"), F.col("__c.j").alias("__j"), F.col("__c.w").alias("__w"))
