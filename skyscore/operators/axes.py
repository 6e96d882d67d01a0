"""Coordinate axes of gridded data.

An axis is described by a handful of literals, given by the caller or read
from the grid by one small job (:func:`find_axis`), so that plans hold plain
arithmetic. Lines may be evenly spaced (index by arithmetic) or at any
places (their sorted array and a binary search as a Column expression). Either
way a coordinate gets a *fractional index*: whole at the lines, linear between
them, so that ``floor(f + 0.5)`` is the nearest line and ``f - floor(f)`` the
weight of interpolation, and cells reach half way to the next line.

Keys of a description with prefix ``p``: ``p0`` first line, ``pd`` mean step,
``pn`` number of lines, ``pp`` periodic in 360 degrees, ``pv`` the lines (NULL
where the step is even), ``ps`` the strides of the search (powers of two).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("0", "d", "n", "p", "v", "s")


@dataclass(frozen=True)
class RegularAxis:
    """A regular coordinate axis: ``first + step * i`` for ``i`` in ``[0, n)``.
    ``periodic`` axes (global longitudes) wrap the index modulo ``n``."""
    first: float
    step: float
    n: int
    periodic: bool = False


@dataclass(frozen=True)
class LineAxis:
    """An axis by its lines, at any places. ``periodic``: the last line is
    followed by the first one, 360 degrees on."""
    lines: tuple[float, ...]
    periodic: bool = False


def axis_columns(grid: DataFrame, coord: str, prefix: str, spec: RegularAxis | LineAxis | None = None,
                 periodic: bool | None = None) -> dict:
    """Description of the axis ``coord`` of ``grid``. Without a spec the lines
    are the distinct values of the column; the step counts as even when all
    gaps agree within 1 % (axes stored in single precision). A longitude axis
    is taken for periodic when the gap from its last line round to its first
    is a step like the others (even), or no wider than the widest (uneven). A
    single line counts as a step of 1. The window and the sorted array hold
    the axis, whose size is not that of the data."""
    if spec is None:
        spec = find_axis(grid, coord, periodic)
    if isinstance(spec, LineAxis):
        lines = sorted({float(v) for v in spec.lines})
        n = len(lines)
        if n < 2:
            raise ValueError("an axis by its lines needs two of them")
        return {f"{prefix}0": F.lit(lines[0]), f"{prefix}d": F.lit((lines[-1] - lines[0]) / (n - 1)),
                f"{prefix}n": F.lit(n), f"{prefix}p": F.lit(bool(spec.periodic)),
                f"{prefix}v": _array(lines, "double"), f"{prefix}s": _array(strides(n), "int")}
    first = float("nan") if spec.first is None else float(spec.first)
    return {f"{prefix}0": F.lit(first), f"{prefix}d": F.lit(float(spec.step)), f"{prefix}n": F.lit(int(spec.n)),
            f"{prefix}p": F.lit(bool(spec.periodic)), f"{prefix}v": F.lit(None).cast("array<double>"),
            f"{prefix}s": F.lit(None).cast("array<int>")}


def _array(values, kind: str) -> Column:
    """A literal array (parsed at once: a Column per element is slow to build)."""
    suffix = "D" if kind == "double" else ""
    return F.expr(f"array({', '.join(f'{v!r}{suffix}' for v in values)})")


def strides(n: int) -> list[int]:
    """Steps of a binary search over ``n`` places: falling powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1)]


def find_axis(grid: DataFrame, coord: str, periodic: bool | None = None) -> RegularAxis | LineAxis:
    """The axis whose lines are the distinct values of ``coord``. The driver
    gets one row: the extent, and the lines only where they are uneven."""
    x = F.col(coord).cast("double")
    vals = grid.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x")).distinct()
    gaps = vals.select("x", (F.lead("x").over(Window.orderBy("x")) - F.col("x")).alias("g"))
    even = F.coalesce(F.max("g") - F.min("g") <= 0.01 * F.min("g"), F.lit(True))
    a = gaps.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"), F.max("g").alias("g"),
                 F.when(~even, F.sort_array(F.collect_list("x"))).alias("v")).first()
    if a["v"] is not None:
        seam = 360.0 - (a["hi"] - a["lo"])
        return LineAxis(tuple(a["v"]), 0 < seam <= 1.01 * a["g"] if periodic is None else periodic)
    step = (a["hi"] - a["lo"]) / (a["n"] - 1) if a["n"] > 1 else 1.0
    return RegularAxis(a["lo"], step, a["n"], abs(a["n"] * step - 360.0) < 0.01 * step if periodic is None else periodic)


def grid_axes(grid: DataFrame, lat: str = "lat", lon: str = "lon", lat_axis=None, lon_axis=None,
              lon_periodic: bool | None = None) -> dict:
    """Both axis descriptions (``a*`` = lat, ``b*`` = lon) as a dict of
    Columns, attached to rows with ``withColumns`` (scalars, never a join)."""
    return {**axis_columns(grid, lat, "a", lat_axis, periodic=False),
            **axis_columns(grid, lon, "b", lon_axis, periodic=lon_periodic)}


def axes_row(axes: dict):
    """The axis description as a Python row (tests / inspection)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.range(1).select(*[v.alias(k) for k, v in axes.items()]).first()


def _let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), F.lit(0))


def search(lines: Column, steps: Column, x: Column) -> Column:
    """Place of the last line at or before ``x`` (0 before the first): a binary
    search, one comparison a stride."""
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when(F.get(lines, at + s) <= x, at + s).otherwise(at))


def fractional_index(x: Column, p: str) -> Column:
    """Index of coordinate ``x`` on axis ``p``. Beyond the ends of a periodic
    axis it goes on counting (wrap it), beyond those of another it follows the
    last gap. NULL for a missing coordinate."""
    first, n, lines = F.col(f"{p}0"), F.col(f"{p}n"), F.col(f"{p}v")

    def uneven(y: Column, turns: Column) -> Column:
        def at(i: Column) -> Column:
            left = F.get(lines, i)
            right = F.when(i + 1 < n, F.get(lines, i + 1)).otherwise(first + 360.0)
            return i + (y - left) / (right - left) + n * turns
        found = search(lines, F.col(f"{p}s"), y)
        return _let(F.when(F.col(f"{p}p"), found).otherwise(F.least(found, n - 2)), at)

    turns = F.when(F.col(f"{p}p"), F.floor((x - first) / 360.0)).otherwise(0)
    return F.when(lines.isNull(), (x - first) / F.col(f"{p}d")).otherwise(
        _let(turns, lambda t: uneven(x - 360.0 * t, t)))


def line_at(i: Column, p: str) -> Column:
    """Coordinate of line ``i`` (whole), also beyond the ends."""
    first, n, lines = F.col(f"{p}0"), F.col(f"{p}n"), F.col(f"{p}v")
    turned = F.get(lines, F.pmod(i, n).cast("int")) + 360.0 * F.floor(i / n)
    last = F.get(lines, n - 1)
    straight = (F.when(i < 0, first + i * (F.get(lines, F.lit(1)) - first))
                .when(i >= n, last + (i - n + 1) * (last - F.get(lines, n - 2)))
                .otherwise(F.get(lines, i.cast("int"))))
    return F.when(lines.isNull(), first + F.col(f"{p}d") * i).otherwise(
        F.when(F.col(f"{p}p"), turned).otherwise(straight))


def lower_bound(i: Column, p: str) -> Column:
    """Where cell ``i`` begins: half way from the line before."""
    return (line_at(i - 1, p) + line_at(i, p)) / 2


def wrap(i: Column, p: str) -> Column:
    """Periodic axes wrap; others keep the raw index (validity checked later)."""
    return F.when(F.col(f"{p}p"), F.pmod(i, F.col(f"{p}n"))).otherwise(i)


def in_axis(i: Column, p: str) -> Column:
    return (i >= 0) & (i < F.col(f"{p}n"))


def in_reach(x: Column, f: Column, p: str, limit) -> Column:
    """Whether a coordinate (with its fractional index) is near enough to the
    axis: inside the outermost cells (``limit='cell'``), at most ``limit``
    degrees beyond the outermost lines (a number), or anywhere (None)."""
    if limit is None:
        return F.lit(True)
    n = F.col(f"{p}n")
    if limit == "cell":
        near = (f >= -0.5 - 1e-9) & (f <= n - 0.5 + 1e-9)
    else:
        near = (x >= F.col(f"{p}0") - float(limit)) & (x <= line_at(n - 1, p) + float(limit))
    return F.col(f"{p}p") | near
