"""Pairing of gridded model output with points or other grids.

Scale design
------------
Grid rows (time x cells) vastly outnumber distinct sites, and sites vastly
outnumber axis values. So every method works in three steps:

1. *Match* coordinates to grid-cell indices by arithmetic against an
   axis description (literals; a search between uneven lines); cells of a 2-D grid by a
   descent through a pyramid of tiles.
2. *Fetch* model values with a hash equi join on integer cell indices (and
   time). Integer keys avoid floating-point equality on coordinates.
3. *Attach* the result to the observation rows with an equi join on the site
   coordinates (and time).

No range join is evaluated as a nested loop over sites x cells; of the data only
axis descriptions (the lines of uneven axes) and one-row extents reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .curvilinear import (cells_2d, corners_2d, nearest_2d, pair_nearest_curvilinear,  # noqa: F401
                          pair_nearest_great_circle)
from .axes import (LineAxis, RegularAxis, axes_row, axis_columns, fractional_index, grid_axes, in_axis, in_reach,  # noqa: F401
                   line_at, lower_bound, search, wrap)

def indexed_grid(grid: DataFrame, axes: dict, var, lat="lat", lon="lon", time="time") -> DataFrame:
    """Grid rows keyed by integer cell indices ``(time, __i, __j)``."""
    var = [var] if isinstance(var, str) else list(var)
    tcols = [time] if time else []
    g = grid.withColumns(axes)
    return g.select(*tcols,
                    F.round(fractional_index(F.col(lat), "a")).cast("int").alias("__i"),
                    wrap(F.round(fractional_index(F.col(lon), "b")).cast("int"), "b").alias("__j"),
                    *var)


# ---------------------------------------------------------------- nearest


def with_nearest(df: DataFrame, axes: dict, lat="lat", lon="lon", clamp: bool = True, limit="cell") -> DataFrame:
    """``df`` with the nearest cell indices ``__i, __j`` of each row and the
    axis description ``__ax``; a missing coordinate gives NULL indices.

    Nearest = ``floor(index + 0.5)`` (ties go to the upper cell), also between
    uneven lines. Points beyond the outermost cells have no cell; ``limit``
    degrees beyond the outermost lines (None: at any distance) take the edge
    cell instead. Periodic longitudes wrap. ``clamp=False`` gives raw indices."""
    s = df.withColumn("__ax", F.struct(*[v.alias(k) for k, v in axes.items()]))
    s = s.withColumns({"__fi": fractional_index(F.col(lat), "__ax.a"), "__fj": fractional_index(F.col(lon), "__ax.b")})
    i, j = (F.floor(F.col(f) + 0.5).cast("int") for f in ("__fi", "__fj"))
    if clamp:  # least and greatest skip NULL, so a missing index is kept apart
        near = in_reach(F.col(lat), F.col("__fi"), "__ax.a", limit) & in_reach(F.col(lon), F.col("__fj"), "__ax.b", limit)
        i = F.when(i.isNotNull() & near, F.least(F.greatest(i, F.lit(0)), F.col("__ax.an") - 1))
        j = F.when(near & F.col("__ax.bp"), F.pmod(j, F.col("__ax.bn"))).when(
            j.isNotNull() & near, F.least(F.greatest(j, F.lit(0)), F.col("__ax.bn") - 1))
    else:
        j = wrap(j, "__ax.b")
    return s.withColumns({"__i": i, "__j": j}).drop("__fi", "__fj")


def nearest_cells(sites: DataFrame, axes: dict, lat="lat", lon="lon", clamp: bool = True, limit="cell") -> DataFrame:
    """Distinct site coordinates with their nearest cell indices ``__i, __j``
    (:func:`with_nearest`)."""
    return with_nearest(sites.select(lat, lon).distinct(), axes, lat, lon, clamp, limit).drop("__ax")


def pair_nearest(model: DataFrame, points: DataFrame, var, lat="lat", lon="lon", time="time",
                 how: str = "left", axes: dict | None = None, lat_axis=None, lon_axis=None,
                 with_cell: bool = False, limit="cell") -> DataFrame:
    """Each point (row of ``points``) takes the value of its nearest
    grid cell at the same time. ``how='left'`` keeps every point (model NULL
    when the cell-time is absent, a coordinate is missing or the point lies
    beyond ``limit``, see :func:`with_nearest`); ``'inner'`` keeps matched
    pairs only. The cell index is arithmetic on the row's own columns, so the
    only shuffle is the join to the grid."""
    var = [var] if isinstance(var, str) else list(var)
    axes = axes if axes is not None else grid_axes(model, lat, lon, lat_axis, lon_axis)
    g = indexed_grid(model, axes, var, lat, lon, time)
    keyed = with_nearest(points, axes, lat, lon, limit=limit)
    if with_cell:
        keyed = keyed.withColumns({"cell_lat": line_at(F.col("__i"), "__ax.a"), "cell_lon": line_at(F.col("__j"), "__ax.b")})
    on = ([time] if time else []) + ["__i", "__j"]
    out = keyed.drop("__ax").join(g, on, how)
    if with_cell:
        out = out.select(*[c for c in out.columns if c not in ("cell_lat", "cell_lon")], "cell_lat", "cell_lon")
    return out.drop("__i", "__j")


# --------------------------------------------------------------- bilinear


def bilinear_corners(sites: DataFrame, axes: dict, lat="lat", lon="lon", keys=()) -> DataFrame:
    """Each distinct site (plus ``keys``) -> its four surrounding cells with
    bilinear weights (explode x4 of the distinct sites only)."""
    keys = list(keys)
    s = sites.select(*keys, lat, lon).distinct().withColumns(axes)
    s = s.select(*keys, lat, lon, "ap", "an", "bp", "bn", fractional_index(F.col(lat), "a").alias("__fi"),
                 fractional_index(F.col(lon), "b").alias("__fj"))
    fi, fj = F.col("__fi"), F.col("__fj")

    def lower(f, p):  # a point on the last line belongs to the last interval
        last = ~F.col(f"{p}p") & (f == F.col(f"{p}n") - 1) & (F.col(f"{p}n") > 1)
        return F.when(last, F.col(f"{p}n") - 2).otherwise(F.floor(f)).cast("int")
    i0, j0 = lower(fi, "a"), lower(fj, "b")
    s = s.select(*keys, lat, lon, "ap", "an", "bp", "bn", i0.alias("__i0"), j0.alias("__j0"),
                 (fi - i0).alias("__tx"), (fj - j0).alias("__ty"))
    corners = F.array(*[
        F.struct(F.lit(di).alias("di"), F.lit(dj).alias("dj"),
                 ((F.col("__tx") if di else 1 - F.col("__tx")) *
                  (F.col("__ty") if dj else 1 - F.col("__ty"))).alias("w"))
        for di in (0, 1) for dj in (0, 1)])
    e = s.select(*keys, lat, lon, "ap", "an", "bp", "bn", "__i0", "__j0",
                 F.explode(corners).alias("__c"))
    i = F.col("__i0") + F.col("__c.di")
    j = wrap(F.col("__j0") + F.col("__c.dj"), "b")
    return e.select(*keys, lat, lon, i.alias("__i"), j.alias("__j"), F.col("__c.w").alias("__w"),
                    (in_axis(i, "a") & in_axis(j, "b")).alias("__ok"))


def _blend(corner_vals: DataFrame, group, var) -> DataFrame:
    """Sum of weight x value over the four corners; NULL unless all four
    corners exist with a value."""
    aggs = []
    for v in var:
        aggs += [F.sum(F.col("__w") * F.col(v)).alias(f"__s_{v}"),
                 F.count(F.col(v)).alias(f"__n_{v}")]
    a = corner_vals.groupBy(*group).agg(*aggs)
    return a.select(*group, *[F.when(F.col(f"__n_{v}") == 4, F.col(f"__s_{v}")).alias(v) for v in var])


#: corners of a quad of cells: steps from its first one along both axes
_QUAD = ((0, 0), (0, 1), (1, 0), (1, 1))


def with_quad(df: DataFrame, axes: dict, lat="lat", lon="lon") -> DataFrame:
    """``df`` with the first of the four cells around each row (``__i, __j``),
    the weights ``__w0..__w3`` of the four (:data:`_QUAD`) and ``__ok``: one of
    them at least lies on the axes. Arithmetic on the row's own columns."""
    s = df.withColumn("__ax", F.struct(*[v.alias(k) for k, v in axes.items()]))
    s = s.withColumns({"__fi": fractional_index(F.col(lat), "__ax.a"), "__fj": fractional_index(F.col(lon), "__ax.b")})

    def lower(f, p):  # a point on the last line belongs to the last interval
        last = ~F.col(f"{p}p") & (F.col(f) == F.col(f"{p}n") - 1) & (F.col(f"{p}n") > 1)
        return F.when(last, F.col(f"{p}n") - 2).otherwise(F.floor(f)).cast("int")
    s = s.withColumns({"__i": lower("__fi", "__ax.a"), "__j": lower("__fj", "__ax.b")})
    tx, ty = F.col("__fi") - F.col("__i"), F.col("__fj") - F.col("__j")
    weights = {f"__w{k}": (tx if di else 1 - tx) * (ty if dj else 1 - ty) for k, (di, dj) in enumerate(_QUAD)}
    inside = lambda f, p, w: in_axis(F.col(f), p) | in_axis(F.col(f) + 1, p) | w
    ok = inside("__i", "__ax.a", F.lit(False)) & inside("__j", "__ax.b", F.col("__ax.bp"))
    s = s.withColumns({**weights, "__ok": F.coalesce(ok, F.lit(False))})
    return s.withColumn("__j", wrap(F.col("__j"), "__ax.b")).drop("__ax", "__fi", "__fj")


def quad_values(g: DataFrame, keys, var, axes: dict | None = None) -> DataFrame:
    """Values of the four cells of every quad side by side, under ``keys`` and
    its first cell ``__i, __j``: how many there are (``__n_v``) and their sums
    by corner (``__v0..__v3`` with the variable's place). One aggregate of the
    grid; with ``axes`` the second axis may wrap and cells off the axes do not
    count."""
    if axes is not None:
        g = g.withColumns(axes).where(in_axis(F.col("__i"), "a") & in_axis(F.col("__j"), "b"))
    first = lambda dj: F.col("__j") - dj if axes is None else wrap(F.col("__j") - dj, "b")
    corners = F.array(*[F.struct((F.col("__i") - di).alias("i"), first(dj).alias("j"), F.lit(k).alias("k"))
                        for k, (di, dj) in enumerate(_QUAD)])
    e = g.select(*keys, *[F.col(v).cast("double").alias(f"__val{n}") for n, v in enumerate(var)], F.explode(corners).alias("__c"))
    aggs = []
    for n in range(len(var)):
        aggs.append(F.count(f"__val{n}").alias(f"__n{n}"))
        aggs += [F.sum(F.when(F.col("__c.k") == k, F.col(f"__val{n}"))).alias(f"__v{n}_{k}") for k in range(4)]
    return e.groupBy(*keys, F.col("__c.i").alias("__i"), F.col("__c.j").alias("__j")).agg(*aggs)


def _attach_quads(keyed: DataFrame, quads: DataFrame, tk: list[str], var, lat: str, lon: str, how: str,
                  columns: list[str]) -> DataFrame:
    """Rows of ``keyed`` (``columns`` and those of :func:`with_quad`) with the
    blended values: NULL unless all four cells have one. ``how='inner'`` keeps
    the rows that have cells."""
    if how == "inner":
        keyed = keyed.where("__ok")
        for t in tk:
            keyed = keyed.where(F.col(t).isNotNull())
    d = keyed.join(quads, [*tk, "__i", "__j"], "left")
    vals = []
    for n, v in enumerate(var):
        terms = [F.coalesce(F.col(f"__w{k}") * F.col(f"__v{n}_{k}"), F.lit(0.0)) for k in range(4)]
        vals.append(F.when(F.col(f"__n{n}") == 4, sum(terms[1:], terms[0])).alias(v))
    on = [*tk, lat, lon]
    return d.select(*on, *[F.col(f"`{c}`") for c in columns if c not in on], *vals)


def pair_bilinear(model: DataFrame, points: DataFrame, var, lat="lat", lon="lon", time="time",
                  how: str = "left", axes: dict | None = None, lat_axis=None,
                  lon_axis=None) -> DataFrame:
    """Bilinear interpolation of the model to each point at its time. The
    quad and its weights are arithmetic on the point's own columns, so points
    move once (or not, where the planner broadcasts the grid): for the join to
    the quads of the grid."""
    var = [var] if isinstance(var, str) else list(var)
    axes = axes if axes is not None else grid_axes(model, lat, lon, lat_axis, lon_axis)
    tk = [time] if time else []
    quads = quad_values(indexed_grid(model, axes, var, lat, lon, time), tk, var, axes)
    return _attach_quads(with_quad(points, axes, lat, lon), quads, tk, var, lat, lon, how, points.columns)


# ------------------------------------------------------------ regrid


def regrid(model: DataFrame, target_cells: DataFrame, var, method: str = "bilinear",
           lat="lat", lon="lon", time="time", axes: dict | None = None) -> DataFrame:
    """Model onto the target grid's cells for every model time.

    Weights are computed once on the distinct target cells (small), then one
    equi join on cell indices fetches all times."""
    var = [var] if isinstance(var, str) else list(var)
    axes = axes if axes is not None else grid_axes(model, lat, lon)
    g = indexed_grid(model, axes, var, lat, lon, time)
    tk = [time] if time else []
    if method == "nearest":
        cells = nearest_cells(target_cells, axes, lat, lon)
        return cells.join(g, ["__i", "__j"]).select(*tk, lat, lon, *var)
    if method == "bilinear":
        corners = bilinear_corners(target_cells, axes, lat, lon).where("__ok")
        vals = corners.join(g, ["__i", "__j"], "inner")
        return _blend(vals, tk + [lat, lon], var)
    if method == "conservative":
        return regrid_conservative(model, target_cells, var, lat, lon, time, axes=axes)
    raise ValueError(f"unknown regrid method {method!r}")


def regrid_conservative(model: DataFrame, target_cells: DataFrame, var, lat="lat", lon="lon",
                        time="time", target_step=None, axes: dict | None = None) -> DataFrame:
    """Area-conservative remap. Target cell = ``lat +- dlat/2`` x
    ``lon +- dlon/2`` (``target_step=(dlat, dlon)``); without it target cells
    reach half way to the next line of the target's own axes. Weight of a source cell = overlap width in longitude
    (degrees) x (sin(phi2) - sin(phi1)) of the latitude overlap; result =
    sum(w v) / sum(w) over source cells holding a value."""
    var = [var] if isinstance(var, str) else list(var)
    axes = axes if axes is not None else grid_axes(model, lat, lon)
    t = target_cells.select(lat, lon).distinct().withColumns(axes)
    if target_step is None:
        t = t.withColumns({**axis_columns(target_cells, lat, "ta", periodic=False), **axis_columns(target_cells, lon, "tb")})
        edges = []
        for c, p in ((lat, "ta"), (lon, "tb")):
            k = F.round(fractional_index(F.col(c), p))
            edges += [lower_bound(k, p), lower_bound(k + 1, p)]
    else:
        edges = [F.col(c) + sign * float(step) / 2 for c, step in zip((lat, lon), target_step) for sign in (-1, 1)]
    held = list(axes)
    t = t.select(lat, lon, *held, *[e.alias(n) for e, n in zip(edges, ("tlo_a", "thi_a", "tlo_b", "thi_b"))])
    # candidate source indices: every source cell whose interval may touch; an
    # axis that does not wrap ends at its outermost cells
    def touched(end: str, p: str) -> Column:
        i = F.floor(fractional_index(F.col(end), p) + 0.5)
        return F.when(F.col(f"{p}p"), i).otherwise(F.least(F.greatest(i, F.lit(0)), F.col(f"{p}n") - 1)).cast("int")
    t = t.withColumn("__i", F.explode(F.sequence(touched("tlo_a", "a"), touched("thi_a", "a"))))
    t = t.withColumn("__jr", F.explode(F.sequence(touched("tlo_b", "b"), touched("thi_b", "b"))))
    slo_a, shi_a = lower_bound(F.col("__i"), "a"), lower_bound(F.col("__i") + 1, "a")
    slo_b, shi_b = lower_bound(F.col("__jr"), "b"), lower_bound(F.col("__jr") + 1, "b")
    lat_lo = F.greatest(slo_a, F.col("tlo_a"), F.lit(-90.0))
    lat_hi = F.least(shi_a, F.col("thi_a"), F.lit(90.0))
    lon_ov = F.least(shi_b, F.col("thi_b")) - F.greatest(slo_b, F.col("tlo_b"))
    w = lon_ov * (F.sin(F.radians(lat_hi)) - F.sin(F.radians(lat_lo)))
    ok = (lat_hi > lat_lo) & (lon_ov > 0) & in_axis(F.col("__i"), "a") & \
        (F.col("bp") | in_axis(F.col("__jr"), "b"))
    wt = t.where(ok).select(lat, lon, "__i", wrap(F.col("__jr"), "b").alias("__j"), w.alias("__w"))
    g = indexed_grid(model, axes, var, lat, lon, time)
    tk = [time] if time else []
    vals = wt.join(g, ["__i", "__j"], "inner")
    aggs = []
    for v in var:
        aggs += [F.sum(F.when(F.col(v).isNotNull(), F.col("__w") * F.col(v))).alias(f"__s_{v}"),
                 F.sum(F.when(F.col(v).isNotNull(), F.col("__w"))).alias(f"__w_{v}")]
    a = vals.groupBy(*tk, lat, lon).agg(*aggs)
    return a.select(*tk, lat, lon, *[F.when(F.col(f"__w_{v}") > 0, F.col(f"__s_{v}") / F.col(f"__w_{v}")).alias(v)
                                     for v in var])


# ------------------------------------------------------- time interpolation

#: equal-count pieces of the time axis; a power of two
_PIECES = 1024


def time_pieces(*times: DataFrame) -> Column:
    """Sorted microseconds that cut the times of all the one-column frames into
    up to ``_PIECES`` pieces of about equal counts: one mergeable sketch, read as
    a scalar subquery."""
    t = times[0].select(F.unix_micros(times[0].columns[0]).alias("t"))
    for d in times[1:]:
        t = t.unionAll(d.select(F.unix_micros(d.columns[0])))
    at = ", ".join(f"{k / _PIECES!r}D" for k in range(1, _PIECES))
    return t.agg(F.expr(f"array_distinct(percentile_approx(t, array({at}), {4 * _PIECES}))").alias("e")).scalar()


def pair_interp_time(model: DataFrame, points: DataFrame, var, time: str = "time", keys=(),
                     bucket_seconds=None, how: str = "left", pieces: Column | None = None, unique: bool = False) -> DataFrame:
    """J7 (``interp_time``): model series (per ``keys``) linearly interpolated
    in time to each point's time: ``v0 + (v1 - v0) * (t - t0) / (t1 - t0)``;
    exactly at a model time the value is taken as is; NULL outside the model
    time range or when a bracketing value is missing. Of model rows with the
    same keys and time the least is taken; rows of ``points`` stay as they are.

    A merge of both sides, without brackets or candidate pairs: model rows and
    points are united and sorted inside (keys, piece of the time axis), where
    the last model row before and the first one after are filled in. What lies
    in other pieces comes from the table of pieces (one row per key and piece:
    its first and last model row, carried forward and back over empty pieces),
    so a gap of any length costs nothing. Pieces hold equal counts of times; a
    key with a third of all rows is split into many of them.
    ``unique`` says that keys and time are unique in the model;
    ``pieces`` takes edges from :func:`time_pieces` of cheaper frames;
    ``bucket_seconds`` is accepted and not needed."""
    keys = list(keys)
    var = [var] if isinstance(var, str) else list(var)
    no_row = F.lit(None).cast(points.select(F.struct("*").alias("r")).schema["r"].dataType)
    mrow = F.struct(F.col(time).alias("mt"), *[F.col(v).alias(f"v{k}") for k, v in enumerate(var)])
    m = model.select(*keys, F.col(time).alias("__t"), mrow.alias("__m")).where(F.col("__t").isNotNull())
    for k in keys:
        m = m.where(F.col(k).isNotNull())
    if not unique:
        m = m.groupBy(*keys, "__t").agg(F.min("__m").alias("__m"))
    no_model = F.lit(None).cast(m.schema["__m"].dataType)
    edges = time_pieces(model.select(time), points.select(time)) if pieces is None else pieces
    timed = points.where(F.col(time).isNotNull())
    u = m.withColumns({"__row": no_row, "__pt": F.lit(False)}).unionByName(timed.select(
        *keys, F.col(time).alias("__t"), no_model.alias("__m"), F.struct("*").alias("__row"), F.lit(True).alias("__pt")))
    strides = F.lit([_PIECES >> k for k in range(_PIECES.bit_length())])
    u = u.withColumn("__e", edges)
    u = u.withColumn("__b", search(F.col("__e"), strides, F.unix_micros("__t"))).drop("__e")
    u = u.repartition(*keys, "__b")  # moved once, for the window and for the table of pieces
    w = Window.partitionBy(*keys, "__b").orderBy("__t", "__pt")
    # backward fill as a forward one in the other order: frames that end at the
    # last row are recomputed for every row
    back = Window.partitionBy(*keys, "__b").orderBy(F.desc("__t"), F.desc("__pt"))
    filled = u.select(*keys, "__t", "__b", "__pt", "__row",
                      F.last("__m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__prev"),
                      F.last("__m", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("__next"))
    over, past = Window.partitionBy(*keys).orderBy("__b"), Window.partitionBy(*keys).orderBy(F.desc("__b"))
    table = u.groupBy(*keys, "__b").agg(F.max("__m").alias("__last"), F.min("__m").alias("__first"))
    table = table.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__pb"),
        F.last("__last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.last("__first", ignorenulls=True).over(past.rowsBetween(Window.unboundedPreceding, -1)).alias("__after"))
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col("__b") == F.col("__pb")]
    d = filled.where("__pt").join(table, on, "left").select(
        "__row", "__t", F.coalesce("__prev", "__before").alias("__p"), F.coalesce("__next", "__after").alias("__n"))
    there = F.col("__p.mt") == F.col("__t")
    if how == "inner":
        d = d.where(there | (F.col("__p").isNotNull() & F.col("__n").isNotNull()))
    since = lambda c: (F.unix_micros(c) - F.unix_micros("__p.mt")).cast("double")
    frac = since("__t") / since("__n.mt")
    vals = [F.when(there, F.col(f"__p.v{k}")).otherwise(
        F.col(f"__p.v{k}") + (F.col(f"__n.v{k}") - F.col(f"__p.v{k}")) * frac).alias(v) for k, v in enumerate(var)]
    kept = [c for c in points.columns if c not in var]
    out = d.select(*[F.col(f"__row.`{c}`") for c in kept], *vals)
    if how == "inner":
        return out
    untimed = points.where(F.col(time).isNull()).select(
        *kept, *[F.lit(None).cast(out.schema[v].dataType).alias(v) for v in var])
    return out.unionByName(untimed)


# --------------------------------------------------------- as-of nearest


def pair_asof(points: DataFrame, model: DataFrame, var, time: str = "time", keys=(),
              tolerance_seconds: int = 3600, how: str = "left", model_time_col: str = "model_time") -> DataFrame:
    """Each point takes the model row nearest in time within
    ``tolerance`` (same ``keys``); ties go to the earlier model time.

    A merge-style as-of join that never emits candidate pairs:

    1. model rows are reduced to one per (keys, time) (``min`` of a struct,
       a partial aggregate);
    2. points and model rows are unioned and sorted inside (keys, time
       bucket) partitions of width ``tolerance``; a forward fill (``last``
       ignoring nulls) gives each point its previous model row and a backward
       fill (``first``) its next one in the bucket;
    3. the last / first model row of the neighbouring buckets (one row per
       key and bucket) covers points near a bucket edge -- nothing farther
       than one bucket can be within the tolerance.

    Work per point is constant; a key with many rows is split by time bucket."""
    keys = list(keys)
    var = [var] if isinstance(var, str) else list(var)
    width = tolerance_seconds * 1_000_000
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(width)).cast("long")
    mrow = F.struct(F.col(time).alias("mt"), *[F.col(v) for v in var])
    m = model.select(*keys, F.col(time).alias("__t"), mrow.alias("__m")).where(F.col("__t").isNotNull())
    m = m.groupBy(*keys, "__t").agg(F.min("__m").alias("__m"))
    mtype = m.schema["__m"].dataType
    p = points.select(*keys, F.col(time).alias("__t")).distinct().where(F.col("__t").isNotNull())
    u = (m.withColumn("__pt", F.lit(False))
          .unionByName(p.withColumn("__m", F.lit(None).cast(mtype)).withColumn("__pt", F.lit(True)))
          .withColumn("__b", bucket("__t")))
    w = Window.partitionBy(*keys, "__b").orderBy("__t", "__pt")
    back = Window.partitionBy(*keys, "__b").orderBy(F.desc("__t"), F.desc("__pt"))
    u = u.select(*keys, "__t", "__b", "__pt",
                 F.last("__m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__prev"),
                 F.last("__m", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0)).alias("__next"))
    pts = u.where("__pt").drop("__pt")
    edges = m.withColumn("__b", bucket("__t")).groupBy(*keys, "__b").agg(
        F.max("__m").alias("__last"), F.min("__m").alias("__first"))
    before = edges.select(*keys, (F.col("__b") + 1).alias("__b"), "__last")
    after = edges.select(*keys, (F.col("__b") - 1).alias("__b"), "__first")
    pts = pts.join(before, keys + ["__b"], "left").join(after, keys + ["__b"], "left")
    tol = tolerance_seconds * 1_000_000

    def cand(c):
        dt = F.abs(F.unix_micros("__t") - F.unix_micros(F.col(c)["mt"]))
        return F.when(F.col(c).isNotNull() & (dt <= tol), F.struct(dt.alias("dt"), F.col(c).alias("m")))
    best = F.least(*[cand(c) for c in ("__prev", "__next", "__last", "__first")])
    out = pts.select(*keys, F.col("__t").alias(time), best.alias("__best"))
    out = out.select(*keys, time, F.col("__best.m.mt").alias(model_time_col),
                     *[F.col(f"__best.m.{v}").alias(v) for v in var])
    return points.join(out, keys + [time], how)


# ----------------------------------------------------- join helpers


def suffix_clashes(source: DataFrame, target: DataFrame, keys, suffix_source: str = "_source",
                   suffix_target: str = "_target"):
    """Rename non-key columns present on both sides."""
    keys = set(keys)
    clash = [c for c in source.columns if c in target.columns and c not in keys]
    if clash:
        source = source.withColumnsRenamed({c: f"{c}{suffix_source}" for c in clash})
        target = target.withColumnsRenamed({c: f"{c}{suffix_target}" for c in clash})
    return source, target


def _interp_time_at_cells(g: DataFrame, var, site_cells: DataFrame, points: DataFrame, lat, lon, time,
                          pieces: Column, unique: bool) -> DataFrame:
    """Model series of each needed cell (``g``: time, __i, __j, variables)
    interpolated in time to the points' times: keys are the integer cell
    indices, so every cell is one series."""
    need = points.select(lat, lon, time).distinct().join(site_cells, [lat, lon])
    cells = need.select("__i", "__j").distinct()
    g = g.join(cells, ["__i", "__j"], "left_semi")
    per_cell = pair_interp_time(g, need.select("__i", "__j", time).distinct(), var, time=time, keys=["__i", "__j"],
                                how="inner", pieces=pieces, unique=unique)
    return need.join(per_cell, ["__i", "__j", time], "left")


#: resolution methods of ``pair_data``
METHODS = ("nearest", "bilinear", "interpolate", "regrid", "conservative")


def pair_data(model: DataFrame, points: DataFrame, var, method: str = "nearest", merge: bool = True,
              interp_time: bool = False, suffix_source: str = "_source", suffix_target: str = "_target",
              time_trunc: str | None = None, bucket_seconds=None, merge_target: bool = False, mask=None,
              mask_column: str = "region", cell: tuple[str, str] | None = None, drop_duplicates: bool = True,
              sort: bool = False, limit="cell", limit_km: float | None = None, **kw) -> DataFrame:
    """Entry point mirroring ``pair_data``.

    ``method``: nearest / bilinear / interpolate (= bilinear) / regrid /
    conservative. ``interp_time``: model values are linearly interpolated in
    time to each observation time (per cell, before the spatial blend)
    instead of matched on equal time. ``time_trunc`` (e.g. 'hour') matches
    observations to the model time their time truncates to. Name clashes
    between observation columns and model variables get ``suffix_target`` /
    ``suffix_source`` (J10). ``merge=False`` keeps only keys and model
    variables (J9). ``merge_target`` (regrid, conservative) joins the target
    grid's own columns to the regridded model, so that the two can be scored;
    target cells without a value keep their row. ``cell=(row, column)`` says
    that the model's coordinates are 2-D and its cells numbered by those
    columns (nearest within ``limit_km``, bilinear inside quads). Several model
    rows for one cell and time count once, the least of them
    (``drop_duplicates``). ``mask``: a region table
    (:func:`~skyscore.operators.regions.region_table`) whose labels are added
    as ``mask_column``. ``sort`` orders the result by time. Columns of model
    variables carry a history note."""
    from .conform import with_history
    if method not in METHODS:
        raise ValueError(f"unknown pairing method {method!r}")
    var = [var] if isinstance(var, str) else list(var)
    lat, lon, time = kw.get("lat", "lat"), kw.get("lon", "lon"), kw.get("time", "time")
    how = kw.get("how", "left")
    keys = [time, lat, lon]
    clash = [v for v in var if v in points.columns and v not in keys]
    if clash:
        points = points.withColumnsRenamed({v: f"{v}{suffix_target}" for v in clash})
        model = model.withColumnsRenamed({v: f"{v}{suffix_source}" for v in clash})
        var = [f"{v}{suffix_source}" if v in clash else v for v in var]
    match_time = time
    gridded = method in ("regrid", "conservative")
    if time_trunc and not gridded:
        points = points.withColumn("__tmatch", F.date_trunc(time_trunc, F.col(time)))
        model = model.withColumnRenamed(time, "__tmatch")
        match_time = "__tmatch"
    if cell and method == "conservative":
        raise ValueError("conservative regridding needs cell bounds: 1-D axes only")
    edges = time_pieces(model.select(match_time), points.select(match_time)) if interp_time else None
    axes = None if cell else kw.get("axes") or grid_axes(model, lat, lon, kw.get("lat_axis"), kw.get("lon_axis"))

    def grid_values() -> DataFrame:
        """``time, __i, __j``, variables: one row a cell and time."""
        if cell:
            g = model.select(match_time, F.col(cell[0]).cast("long").alias("__i"), F.col(cell[1]).cast("long").alias("__j"), *var)
        else:
            g = indexed_grid(model, axes, var, lat, lon, match_time)
        return _one_each(g, [match_time, "__i", "__j"], var) if drop_duplicates else g

    def weights(sites: DataFrame) -> DataFrame:
        """``lat, lon, __i, __j, __w`` of the distinct sites that have cells."""
        if cell:
            return corners_2d(cells_2d(model, cell, lat, lon), sites, lat, lon)
        return bilinear_corners(sites, axes, lat, lon).where("__ok").drop("__ok")

    def nearest(sites: DataFrame) -> DataFrame:
        if cell:
            return nearest_2d(cells_2d(model, cell, lat, lon), sites, lat, lon, limit_km).drop("distance_km")
        return nearest_cells(sites, axes, lat, lon, limit=limit)

    if gridded:
        kind = "conservative" if method == "conservative" else kw.get("regrid_method", "bilinear")
        if kind == "conservative":
            source = model
            if drop_duplicates:
                source = _one_each(model.select(time, lat, lon, *var), [time, lat, lon], var)
            out = regrid_conservative(source, points, var, lat, lon, time, kw.get("target_step"), axes=axes)
        else:
            g = grid_values()
            if kind == "nearest":
                out = nearest(points).join(g, ["__i", "__j"]).select(time, lat, lon, *var)
            elif kind == "bilinear":
                out = _blend(weights(points).join(g, ["__i", "__j"]), [time, lat, lon], var)
            else:
                raise ValueError(f"unknown regrid method {kind!r}")
        if merge_target:
            on = [c for c in keys if c in points.columns]
            out = points.join(out, on, how).select(*points.columns, *[c for c in out.columns if c not in points.columns])
    elif interp_time and method == "nearest":
        vals = _interp_time_at_cells(grid_values(), var, nearest(points), points, lat, lon, match_time, edges, drop_duplicates)
        out = points.join(vals.drop("__i", "__j"), [lat, lon, match_time], how)
    elif interp_time:
        corners = weights(points)
        vals = _interp_time_at_cells(grid_values(), var, corners.select(lat, lon, "__i", "__j").distinct(),
                                     points, lat, lon, match_time, edges, drop_duplicates)
        vals = vals.join(corners, [lat, lon, "__i", "__j"])
        out = points.join(_blend(vals, [match_time, lat, lon], var), [match_time, lat, lon], how)
    elif method == "nearest":
        if cell:
            near = nearest(points).withColumnsRenamed({lat: "__lat", lon: "__lon"})
            keyed = points.join(near, (F.col(lat) == F.col("__lat")) & (F.col(lon) == F.col("__lon")), "left")
        else:
            keyed = with_nearest(points, axes, lat, lon, limit=limit)
        out = keyed.drop("__ax", "__lat", "__lon").join(grid_values(), [match_time, "__i", "__j"], how).drop("__i", "__j")
    else:
        if cell:  # the four cells of a site as one row, in the order of _QUAD
            four = F.sort_array(F.collect_list(F.struct("__i", "__j", "__w")))
            site = weights(points).groupBy(F.col(lat).alias("__lat"), F.col(lon).alias("__lon")).agg(four.alias("__four"))
            site = site.select("__lat", "__lon", F.col("__four")[0]["__i"].alias("__i"), F.col("__four")[0]["__j"].alias("__j"),
                               *[F.col("__four")[k]["__w"].alias(f"__w{k}") for k in range(4)], F.lit(True).alias("__ok"))
            keyed = points.join(site, (F.col(lat) == F.col("__lat")) & (F.col(lon) == F.col("__lon")), "left")
        else:
            keyed = with_quad(points, axes, lat, lon)
        out = _attach_quads(keyed, quad_values(grid_values(), [match_time], var, axes), [match_time], var, lat, lon, how,
                            points.columns)
    if match_time != time:
        out = out.drop(match_time)
    if not merge:
        out = out.select(*[c for c in keys if c in out.columns], *var)
    if mask is not None:
        from .regions import label_regions
        out = label_regions(out, mask, lat, lon, mask_column)
    note = f"Paired using method '{method}'" + ", interpolated in time" * interp_time
    for v in var:
        out = with_history(out, v, note)
    return sort_by_time(out, time) if sort else out


def _one_each(df: DataFrame, keys: list[str], var: list[str]) -> DataFrame:
    """One row per ``keys``, that of the least values (of one variable: not
    NULL if there is a value): a partial aggregate on
    the keys of the join that follows (no further exchange)."""
    d = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(var)])).alias("__least"))
    return d.select(*keys, *[F.col(f"__least.v{i}").alias(v) for i, v in enumerate(var)])


def sort_by_time(df: DataFrame, time: str = "time", within_partitions: bool = False) -> DataFrame:
    """O1: sorted output by time (sink-side global sort, or per partition)."""
    return df.sortWithinPartitions(time) if within_partitions else df.orderBy(time)


def valid_time_table(cycles: DataFrame, leads, cycle="cycle", lead="lead_h") -> DataFrame:
    """Every forecast cycle with every lead hour of the configuration
    list (an ``explode`` of the literal list, no join) -> valid times."""
    return (cycles.withColumn(lead, F.explode(F.array(*[F.lit(int(h)) for h in leads])))
                  .withColumn("time", F.col(cycle) + F.make_interval(hours=F.col(lead))))
