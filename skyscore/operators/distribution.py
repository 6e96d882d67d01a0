"""Distribution-level metrics that are not a single aggregate (M16, M17), and
exact order statistics.

wasserstein (M17)
    1-D earth mover's distance between the obs and model value distributions
    of each group: ``W = integral |F_o(x) - F_m(x)| dx`` (equal to the mean
    absolute difference of the sorted samples when both have n values).

quantiles
    Exact continuous quantiles.

    Both are exact at any group size and never hold a group in one task: a
    mergeable sketch gives each group equal-count bucket edges (none to a group
    of one bucket), values are tallied per distinct (group, bucket, value) --
    copies collapse in a partial aggregate --, cumulated inside each bucket
    with a window, and offset by prefix sums over the bucket table (one row per
    bucket). The edges only have to be roughly even; every figure comes from
    the exact tally. One algorithm, whatever the size.

fractions_skill_score (M16)
    Roberts & Lean (2008): binary exceedance of ``threshold`` per field,
    neighbourhood fraction over a (2k+1)^2 window of grid cells (zero
    padding outside the grid), ``FSS = 1 - sum (Pf-Po)^2 / (sum Pf^2 + sum Po^2)``.
    The window sums are separable: an exceeding cell opens and closes an interval
    along its row, a running sum turns the intervals into row counts, and the same
    along the columns, where the runs of equal counts are summed without being
    spelt out. The cost does not depend on the size of the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numerics import pairwise_valid, safe_div
from .axes import axis_columns, fractional_index, in_axis, search, wrap

#: most buckets of a group
BUCKETS = 512


def value_tally(rows: DataFrame, by, counts, rows_per_bucket: int, value: str = "x", bucket: str = "bpath") -> DataFrame:
    """Distinct (group, value) tally with value buckets of about equal counts.

    ``rows``: ``by``, the column ``value`` and count columns. Returns ``by,
    bucket, value`` and the summed counts; bucket numbers follow the values. A
    group of more than ``rows_per_bucket`` rows has buckets of about half as
    many, and at most ``BUCKETS``; a value of which there are many copies is one
    row of its bucket."""
    from .stats import join_group_values
    at = ", ".join(f"{k / BUCKETS!r}D" for k in range(1, BUCKETS))
    g = rows.groupBy(*by).agg(F.expr(f"percentile_approx(`{value}`, array({at}), {4 * BUCKETS})").alias("__q"),
                              F.count(F.lit(1)).alias("__n"))
    # every step-th edge, so that small groups carry none
    step = F.when(F.col("__n") <= rows_per_bucket, BUCKETS).otherwise(F.greatest(
        F.lit(1), F.floor(F.lit(BUCKETS) * rows_per_bucket / (2 * F.col("__n"))))).cast("int")
    edges = g.select(*by, F.array_distinct(F.filter("__q", lambda q, i: (i + 1) % step == 0)).alias("__edges"))
    e = join_group_values(rows, edges, by, few=2_000)  # 4 kB of edges a group at most
    strides = F.lit([BUCKETS >> k for k in range(BUCKETS.bit_length())])
    first, x = F.get("__edges", F.lit(0)), F.col(value)
    b = F.when(first.isNull() | (x < first), 0).otherwise(search(F.col("__edges"), strides, x) + 1)
    return e.select(*by, b.cast("int").alias(bucket), value, *counts).groupBy(*by, bucket, value).agg(
        *[F.sum(c).alias(c) for c in counts])


def bucket_offsets(tally: DataFrame, by, counts) -> DataFrame:
    """Per (group, bucket): totals, counts before the bucket (prefix sums in
    value order), group totals, first value and the next bucket's first
    value. One row per bucket: the windows run over this small table."""
    bt = tally.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"__t{c}") for c in counts], F.min("__x").alias("__bx"))
    w = Window.partitionBy(*by).orderBy("__b")
    whole = Window.partitionBy(*by)
    cols = []
    for c in counts:
        cols += [(F.sum(f"__t{c}").over(w) - F.col(f"__t{c}")).alias(f"__o{c}"),
                 F.sum(f"__t{c}").over(whole).alias(f"__n{c}")]
    return bt.select(*by, "__b", *[f"__t{c}" for c in counts], *cols, F.lead("__bx").over(w).alias("__nbx"))


def _grouped(df: DataFrame, by) -> tuple[DataFrame, list[str], list[str]]:
    """One group: a constant key keeps every step a keyed join."""
    by = list(by)
    return (df, by, by) if by else (df.withColumn("__all", F.lit(0)), ["__all"], [])


def wasserstein(df: DataFrame, obs: str, mod: str, by=(), rows_per_bucket: int = 100_000,
                paired: bool = True) -> DataFrame:
    """M17 per group of ``by``. ``paired`` applies pairwise deletion first."""
    from .stats import join_group_values
    df, by, keep = _grouped(df, by)
    v = df.where(pairwise_valid(obs, mod)) if paired else df.where(F.col(obs).isNotNull() | F.col(mod).isNotNull())
    rows = v.select(*by, F.explode(F.array(
        F.struct(F.col(obs).cast("double").alias("__x"), F.lit(1).alias("__co"), F.lit(0).alias("__cm")),
        F.struct(F.col(mod).cast("double").alias("__x"), F.lit(0).alias("__co"), F.lit(1).alias("__cm")))).alias("__e"))
    rows = rows.select(*by, "__e.__x", "__e.__co", "__e.__cm").where(F.col("__x").isNotNull())
    tally = value_tally(rows, by, ["__co", "__cm"], rows_per_bucket, "__x", "__b")
    bt = bucket_offsets(tally, by, ["__co", "__cm"])
    t = join_group_values(tally, bt, [*by, "__b"], salts=0)
    wx = Window.partitionBy(*by, "__b").orderBy("__x")
    run = wx.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select(*by, "__n__co", "__n__cm",
                 (F.col("__o__co") + F.sum("__co").over(run)).alias("__Co"),
                 (F.col("__o__cm") + F.sum("__cm").over(run)).alias("__Cm"),
                 (F.coalesce(F.lead("__x").over(wx), F.col("__nbx")) - F.col("__x")).alias("__dx"))
    contrib = F.abs(safe_div(F.col("__Co"), F.col("__n__co")) - safe_div(F.col("__Cm"), F.col("__n__cm"))) * F.col("__dx")
    empty = (F.max("__n__co") == 0) | (F.max("__n__cm") == 0)
    out = t.groupBy(*by).agg(F.when(~empty, F.sum(F.coalesce(contrib, F.lit(0.0)))).alias("wassersteindistance"))
    return out.select(*keep, "wassersteindistance")


def _running(events: DataFrame, line: list[str], place: str, end: str) -> DataFrame:
    """Runs of constant counts along each ``line`` from events (``place``,
    changes ``f`` and ``o``): ``line, start, stop, f, o``. A line has as many
    places as the grid's axis, so a window holds no more than that."""
    w = Window.partitionBy(*line).orderBy(place)
    e = events.groupBy(*line, place, end).agg(F.sum("f").alias("f"), F.sum("o").alias("o"))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.select(*line, F.col(place).alias("start"), F.coalesce(F.lead(place).over(w), F.col(end)).alias("stop"),
                 F.sum("f").over(run).alias("f"), F.sum("o").over(run).alias("o"))
    return e.where((F.col("f") > 0) | (F.col("o") > 0))


def _open_and_close(d: DataFrame, keep: list[str], at, n: str, k: int, turns) -> DataFrame:
    """Each row as two events of the interval ``at - k .. at + k`` on an axis of
    ``n`` places: cut at its ends, or going on round where ``turns`` is true."""
    size = 2 * k + 1
    whole = F.floor(F.lit(size) / F.col(n)).cast("int")
    rest = F.lit(size) - whole * F.col(n)
    first = F.pmod(at - k, F.col(n))
    over = F.greatest(first + rest - F.col(n), F.lit(0))
    piece = lambda a, b, m: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), m.cast("int").alias("m"))
    one = F.lit(1)
    around = F.array(piece(F.lit(0), F.col(n), whole), piece(first, F.least(first + rest, F.col(n)), one),
                     piece(F.lit(0), over, one))
    cut = F.array(piece(F.greatest(at - k, F.lit(0)), F.least(at + k + 1, F.col(n)), one))
    d = d.withColumn("__s", F.explode(F.filter(F.when(turns, around).otherwise(cut), lambda s: (s["b"] > s["a"]) & (s["m"] > 0))))
    ends = F.array(F.struct(F.col("__s.a").alias("p"), F.col("__s.m").alias("m")),
                   F.struct(F.col("__s.b").alias("p"), (-F.col("__s.m")).alias("m")))
    d = d.withColumn("__e", F.explode(ends))
    return d.select(*keep, n, F.col("__e.p").alias("__p"), (F.col("__e.m") * F.col("f")).alias("f"),
                    (F.col("__e.m") * F.col("o")).alias("o"))


def fractions_skill_score(fcst: DataFrame, obs: DataFrame, var_f: str, var_o: str, threshold: float,
                          k: int = 1, lat: str = "lat", lon: str = "lon", time: str = "time",
                          by=(), axes: dict | None = None, seam: bool = False) -> DataFrame:
    """M16 per group of ``by`` (keys present in both grids, e.g. time). A group
    without a value at or above ``threshold`` in either grid scores NULL.
    ``seam``: windows go on over the seam of a periodic longitude axis."""
    by = list(by)
    if axes is None:
        axes = {**axis_columns(fcst, lat, "a", periodic=False),
                **axis_columns(fcst, lon, "b", periodic=None if seam else False)}
    keys = [*by, *([time] if time and time not in by else [])]

    def ex(df, var, flag):
        d = df.where(F.col(var) >= threshold).withColumns(axes)
        d = d.select(*keys, "an", "bn", "ap", "bp", F.round(fractional_index(F.col(lat), "a")).cast("int").alias("__i"),
                     wrap(F.round(fractional_index(F.col(lon), "b")).cast("int"), "b").alias("__j"),
                     F.lit(int(flag == "f")).alias("f"), F.lit(int(flag == "o")).alias("o"))
        return d.where(in_axis(F.col("__i"), "a") & in_axis(F.col("__j"), "b"))
    e = ex(fcst, var_f, "f").unionByName(ex(obs, var_o, "o"))
    rows = _open_and_close(e, [*keys, "__i", "an"], F.col("__j"), "bn", k, F.lit(seam) & F.col("bp"))
    rows = _running(rows.withColumn("__end", F.col("bn")).drop("bn"), [*keys, "__i", "an"], "__p", "__end")
    cells = rows.withColumn("__j", F.explode(F.sequence(F.col("start"), F.col("stop") - 1))).drop("start", "stop")
    columns = _open_and_close(cells, [*keys, "__j"], F.col("__i"), "an", k, F.lit(False))
    runs = _running(columns.withColumn("__end", F.col("an")).drop("an"), [*keys, "__j"], "__p", "__end")
    n = float((2 * k + 1) ** 2)
    d = runs.select(*by, (F.col("stop") - F.col("start")).alias("__n"), (F.col("f") / n).alias("pf"), (F.col("o") / n).alias("po"))
    if by:  # every group of either grid has a row
        groups = fcst.select(*by).unionByName(obs.select(*by)).distinct()
        zero = F.lit(0.0)
        d = d.unionByName(groups.select(*by, F.lit(0).alias("__n"), zero.alias("pf"), zero.alias("po")))
    gap = F.col("pf") - F.col("po")
    s = d.groupBy(*by).agg(F.sum(F.col("__n") * gap * gap).alias("num"),
                           F.sum(F.col("__n") * (F.col("pf") * F.col("pf") + F.col("po") * F.col("po"))).alias("den"))
    return s.select(*by, (1 - safe_div(F.col("num"), F.col("den"))).alias("fss"))


def percent_name(q: float) -> str:
    """``0.5`` -> ``50``, ``0.125`` -> ``12_5``."""
    whole, _, part = f"{q * 100:.10f}".rstrip("0").rstrip(".").partition(".")
    return whole.zfill(2) + (f"_{part}" if part else "")


def quantiles(df: DataFrame, value: str, qs, by=(), rows_per_bucket: int = 100_000,
              prefix: str = "q") -> DataFrame:
    """Exact continuous quantiles (linear interpolation between order
    statistics: position ``q * (n - 1)``, as numpy / ``percentile`` /
    ``quantile_cont``) of ``value`` per group, without holding a group in one
    task and without asking the driver: a tally in value buckets
    (:func:`value_tally`), the rank range of every bucket from prefix sums
    (:func:`bucket_offsets`), running counts inside the buckets that hold a
    wanted rank, and the two order statistics around each position as
    conditional aggregates.

    Output: ``by`` + one column ``{prefix}{pct:02d}`` per requested q (parts of
    a percent after an underscore: ``q00_4`` is 0.4 %)."""
    from .stats import join_group_values
    df, by, keep = _grouped(df, by)
    qs = [float(q) for q in qs]
    rows = df.select(*by, F.col(value).cast("double").alias("__x"), F.lit(1).alias("__c")) \
             .where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    names = [f"{prefix}{percent_name(q)}" for q in qs]
    tally = value_tally(rows, by, ["__c"], rows_per_bucket, "__x", "__b")
    place = [F.lit(q) * (F.col("__n__c") - 1) for q in qs]
    ranks = [f(p).cast("long") for p in place for f in (F.floor, F.ceil)]
    wanted = F.lit(False)
    for r in ranks:
        wanted = wanted | ((r >= F.col("__o__c")) & (r < F.col("__o__c") + F.col("__t__c")))
    bt = bucket_offsets(tally, by, ["__c"]).where(wanted)
    run = Window.partitionBy(*by, "__b").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = join_group_values(tally, bt, [*by, "__b"], salts=0).withColumn("__end", F.col("__o__c") + F.sum("__c").over(run))
    here = lambda r: F.max(F.when((r >= F.col("__end") - F.col("__c")) & (r < F.col("__end")), F.col("__x")))
    found = t.groupBy(*by).agg(F.max("__n__c").alias("__n__c"), *[here(r).alias(f"__r{i}") for i, r in enumerate(ranks)])
    out = []
    for i, (p, name) in enumerate(zip(place, names)):
        low, high = F.col(f"__r{2 * i}"), F.col(f"__r{2 * i + 1}")
        # equal neighbours (infinite ones too) need no interpolation
        out.append(F.when(low == high, low).otherwise(low + (p - F.floor(p)) * (high - low)).alias(name))
    return found.select(*keep, *out)
