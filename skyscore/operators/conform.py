"""Name, unit and coordinate conforming.

All functions are projections or filters: Catalyst folds them into the scan's
whole-stage-codegen span and pushes the filters into the Parquet reader.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numerics import col, pairwise_valid, safe_div

log = logging.getLogger(__name__)

# --- fixed values: exact time-coordinate names tried first, in order (S6) ---
TIME_NAMES = ("time", "valid_time", "dates", "date", "valid_date", "reference_time")
# --- fixed values: source rename presets (P13) ---
RENAME_PRESETS = {"ish_lite": {"temp": "t2m"}, "gfs": {"TMP": "TMP_2maboveground"}}


def discover_spatial_dims(names, dims=None):
    """P10: first names containing 'lat' / 'lon' (case-insensitive)."""
    pool = list(dims) if dims is not None else list(names)
    lat = next((n for n in pool if "lat" in n.lower()), None)
    lon = next((n for n in pool if "lon" in n.lower()), None)
    return lat, lon


def find_time_column(names):
    """Exact known names first, else the first name containing time/date."""
    names = list(names)
    for t in TIME_NAMES:
        if t in names:
            return t
    return next((n for n in names if "time" in n.lower() or "date" in n.lower()), None)


def rename(df: DataFrame, mapping: dict | None) -> DataFrame:
    """Rename keys that exist; error if a target already exists."""
    if not mapping:
        return df
    present = {k: v for k, v in mapping.items() if k in df.columns}
    targets = list(present.values())
    clash = [v for v in targets if v in df.columns and v not in present] or \
        [v for v in set(targets) if targets.count(v) > 1]
    if clash:
        raise ValueError(f"rename would create duplicate columns: {clash}")
    return df.withColumnsRenamed(present) if present else df


def scale(df: DataFrame, factors: dict | None) -> DataFrame:
    """``v * factor`` for the named columns that exist."""
    if not factors:
        return df
    return df.withColumns({v: F.col(v) * F.lit(f) for v, f in factors.items() if v in df.columns})


def offset(df: DataFrame, shifts: dict | None) -> DataFrame:
    """``v + shift`` for the named columns that exist (after scale)."""
    if not shifts:
        return df
    return df.withColumns({v: F.col(v) + F.lit(s) for v, s in shifts.items() if v in df.columns})


def wind_speed(df: DataFrame, target: str = "wind_speed") -> DataFrame:
    """``hypot(u, v)`` from UGRD/VGRD, else u_wind/v_wind; only when the
    target does not exist yet."""
    if target in df.columns:
        return df
    for u, v in (("UGRD", "VGRD"), ("u_wind", "v_wind")):
        if u in df.columns and v in df.columns:
            return df.withColumn(target, F.hypot(F.col(u), F.col(v))) \
                     .withMetadata(target, {"units": "m s-1", "long_name": "wind speed"})
    return df


def valid_time_to_time(df: DataFrame) -> DataFrame:
    """P5: ``valid_time`` -> ``time`` when ``time`` is absent."""
    if "valid_time" in df.columns and "time" not in df.columns:
        return df.withColumnRenamed("valid_time", "time")
    return df


def valid_time_from_lead(df: DataFrame, cycle: str = "cycle", lead: str = "lead_h",
                         target: str = "time") -> DataFrame:
    """Valid time = cycle time + lead hours (long form carries both)."""
    return df.withColumn(target, F.col(cycle) + F.make_interval(hours=F.col(lead).cast("int")))


def harmonise_coords(df: DataFrame) -> DataFrame:
    """Keep lat/lon when present (dropping latitude/longitude), else alias
    latitude/longitude to lat/lon."""
    cols = df.columns
    if "lat" in cols and "lon" in cols:
        return df.drop(*[c for c in ("latitude", "longitude") if c in cols])
    ren = {}
    if "latitude" in cols and "lat" not in cols:
        ren["latitude"] = "lat"
    if "longitude" in cols and "lon" not in cols:
        ren["longitude"] = "lon"
    return df.withColumnsRenamed(ren) if ren else df


def normalise_lon(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Longitudes in [-180, 180) whatever the source convention (0..360)."""
    return df.withColumn(lon, F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0)


def drop_helpers(df: DataFrame, names=("mesh",)) -> DataFrame:
    """Drop helper variables before a merge."""
    return df.drop(*[n for n in names if n in df.columns])


def subset_variables(df: DataFrame, keys, variables) -> DataFrame:
    """Keep the key columns and the named variables."""
    variables = [variables] if isinstance(variables, str) else list(variables)
    return df.select(*[k for k in keys if k in df.columns], *variables)


def resolve_pair_columns(kwargs: dict):
    """Obs from col1/var1/y, model from col2/var2."""
    obs = kwargs.get("col1") or kwargs.get("var1") or kwargs.get("y")
    mod = kwargs.get("col2") or kwargs.get("var2")
    return obs, mod


def with_history(df: DataFrame, column: str, message: str) -> DataFrame:
    """Append ``message`` to the column's ``history`` metadata."""
    meta = dict(df.schema[column].metadata or {})
    hist = meta.get("history")
    if isinstance(hist, dict):
        hist = dict(hist)
        hist[str(len(hist))] = message
    else:
        hist = f"{hist}\n{message}" if hist else message
    meta["history"] = hist
    return df.withMetadata(column, meta)


def apply_preset(df: DataFrame, source_type: str) -> DataFrame:
    """Source rename presets for pairing compatibility."""
    return rename(df, RENAME_PRESETS.get(source_type, {}))


def align_pressure_units(obs: DataFrame, model: DataFrame, obs_p: str, mod_p: str) -> DataFrame:
    """Bring the observed pressure to the model's unit (Pa <-> hPa).

    If max(model p) < 2000 and max(obs p) > 10000 the obs are in Pa and the
    model in hPa -> obs / 100; the converse multiplies by 100. Two global
    maxima as scalar subqueries and a CASE; nothing is collected."""
    mo = obs.agg(F.max(obs_p)).scalar()
    mm = model.agg(F.max(mod_p)).scalar()
    f = (F.when((mm < 2000) & (mo > 10000), F.lit(0.01))
         .when((mo < 2000) & (mm > 10000), F.lit(100.0))
         .otherwise(F.lit(1.0)))
    return obs.withColumn(obs_p, F.col(obs_p) * f)


def area_weight(lat="lat") -> Column:
    """cos(latitude) area weight."""
    return F.cos(F.radians(col(lat)))


def bias(obs, mod) -> Column:
    """Model minus observation."""
    return col(mod) - col(obs)


def time_range_text(df: DataFrame, time: str = "time") -> DataFrame:
    """One row: 'YYYY-MM-DD to YYYY-MM-DD', a single date, or NULL."""
    a = df.agg(F.min(time).alias("t0"), F.max(time).alias("t1"))
    d0, d1 = F.date_format("t0", "yyyy-MM-dd"), F.date_format("t1", "yyyy-MM-dd")
    return a.select(F.when(d0 == d1, d0).otherwise(F.concat_ws(" to ", d0, d1)).alias("time_range"))


def summary_title(df: DataFrame, obs: str, mod: str, title: str, plot_type: str = "",
                  stat: str | None = None, time: str = "time") -> DataFrame:
    """P18: 'title | time range | STAT=x.xxx' (default stat rmse, mb for bias plots)."""
    from .stats import compute_statistics
    stat = stat or ("mb" if "bias" in plot_type.lower() else "rmse")
    s = compute_statistics(df, [stat], obs, mod)
    tr = time_range_text(df, time).scalar()
    return s.select(F.concat_ws(
        " | ", F.lit(title), tr,
        F.concat(F.lit(stat.upper() + "="), F.format_string("%.3f", F.col(stat)))).alias("title"))


# ---------------------------------------------------------------- subsetting

def isel(df: DataFrame, index: dict | None) -> DataFrame:
    """positional selection along dimensions (unknown dims ignored).

    The axis is the small table of distinct coordinate values (missing ones
    left out); it is ranked (0-based, ascending) and semi-joined back, so the
    big table is never ordered. Indices, lists and slices (with steps) count
    from the end when negative, as in Python."""
    if not index:
        return df
    for dim, ix in index.items():
        if dim not in df.columns:
            continue
        axis = df.select(dim).where(F.col(dim).isNotNull()).distinct()
        ranked = axis.withColumns({"__ix": F.dense_rank().over(Window.orderBy(dim)) - 1,
                                   "__n": F.count(F.lit(1)).over(Window.partitionBy())})
        at, n = F.col("__ix"), F.col("__n")

        def place(i):
            return F.lit(i) if i >= 0 else n + F.lit(i)
        if isinstance(ix, slice):
            step = 1 if ix.step is None else ix.step
            if step == 0:
                raise ValueError("slice step cannot be zero")
            if step > 0:
                first = F.lit(0) if ix.start is None else F.greatest(place(ix.start), F.lit(0))
                cond = (at >= first) & (at < (n if ix.stop is None else place(ix.stop)))
            else:
                first = n - 1 if ix.start is None else F.least(place(ix.start), n - 1)
                cond = (at <= first) & (at > (F.lit(-1) if ix.stop is None else place(ix.stop)))
            cond = cond & (F.abs(at - first) % abs(step) == 0)
        elif isinstance(ix, (list, tuple)):
            cond = at.isin([place(i) for i in ix]) if ix else F.lit(False)
        else:
            cond = at == place(ix)
        keep = ranked.where(cond).select(dim)
        df = df.join(keep, dim, "left_semi")  # AQE broadcasts it at its measured size
    return df


def sel(df: DataFrame, labels: dict | None) -> DataFrame:
    """label selection (exact, list or slice); unknown names ignored."""
    if not labels:
        return df
    for name, v in labels.items():
        if name not in df.columns:
            continue
        c = F.col(name)
        if isinstance(v, slice):
            cond = F.lit(True)
            if v.start is not None:
                cond = cond & (c >= F.lit(v.start))
            if v.stop is not None:
                cond = cond & (c <= F.lit(v.stop))
        elif isinstance(v, (list, tuple)):
            cond = c.isin(list(v))
        else:
            cond = c == F.lit(v)
        df = df.where(cond)
    return df


def conform(df: DataFrame, rename_map=None, scale_map=None, offset_map=None,
            isel_map=None, sel_map=None, lon_wrap: bool = False) -> DataFrame:
    """Standard conforming chain (F3 applied once: each subset key is resolved
    against the original name, then the renamed one)."""
    df = valid_time_to_time(df)
    rename_map = rename_map or {}
    inv = {v: k for k, v in rename_map.items()}

    def _resolve(d):
        if not d:
            return d
        return {(k if k in df.columns else inv.get(k, k)): v for k, v in d.items()}

    df = isel(df, _resolve(isel_map))
    df = sel(df, _resolve(sel_map))
    df = rename(df, rename_map)
    df = scale(df, scale_map)
    df = offset(df, offset_map)
    df = harmonise_coords(df)
    if lon_wrap and "lon" in df.columns:
        df = normalise_lon(df)
    return wind_speed(df)


def finite_pairs(df: DataFrame, obs: str, mod: str) -> DataFrame:
    """rows where both members of the pair are finite."""
    return df.where(pairwise_valid(obs, mod))


def drop_missing(df: DataFrame, columns) -> DataFrame:
    """F8."""
    return df.dropna(subset=[columns] if isinstance(columns, str) else list(columns))


def ratio(num, den) -> Column:
    return safe_div(num, den)
