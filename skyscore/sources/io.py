"""Scans and ingest.

Sources are read with an explicit schema where one is given (no inference
pass over 100 TB), filters are expressed as Column predicates so Catalyst
pushes them into the Parquet reader, and stores are laid out by ``date`` so
date lists become static partition pruning.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import conform


@dataclass
class SourceSpec:
    """A named dataset type = where, how and what to conform."""
    path: str | list
    fmt: str = "parquet"
    schema: T.StructType | str | None = None
    options: dict = field(default_factory=dict)
    rename: dict | None = None
    scale: dict | None = None
    offset: dict | None = None
    isel: dict | None = None
    sel: dict | None = None
    filters: dict | None = None


def load_data(spark: SparkSession, spec: SourceSpec, dates=None, time_col: str = "time") -> DataFrame:
    """S1 entry point: scan -> level/variable filters (S11) -> date filter
    (partition pruning when the store is partitioned by ``date``) -> conform."""
    r = spark.read.format(spec.fmt).options(**spec.options)
    if spec.schema is not None:
        r = r.schema(spec.schema)
    df = r.load(spec.path if isinstance(spec.path, str) else list(spec.path))
    if spec.filters:
        df = level_filter(df, spec.filters)
    if dates is not None:
        dates = normalise_dates(dates)
        if "date" in df.columns:
            df = df.where(F.col("date").isin(dates))
        elif time_col in df.columns:
            df = df.where(_on_days(F.col(time_col), [dt.date.fromisoformat(d) for d in dates]))
    df = conform(df, spec.rename, spec.scale, spec.offset, spec.isel, spec.sel)
    return missing_as_null(df)


def _on_days(time, days):
    """``time`` falls on one of ``days``: half-open ranges over runs of days, which
    reach the file reader (a function of ``time`` would not)."""
    day, runs = dt.timedelta(days=1), []
    for d in sorted(set(days)):
        if runs and runs[-1][1] == d:
            runs[-1][1] = d + day
        else:
            runs.append([d, d + day])
    found = F.lit(False)
    for lo, hi in runs:
        found = found | ((time >= F.lit(lo)) & (time < F.lit(hi)))
    return found


def missing_as_null(df: DataFrame) -> DataFrame:
    """§1.4 policy at ingest: NaN and +-inf in floating value columns become
    NULL, so every aggregate skips them (one projection, no cast of other
    types; column metadata such as units and history is kept)."""
    from ..functions.numerics import nan_to_null
    fields = df.schema.fields
    if not any(isinstance(f.dataType, (T.DoubleType, T.FloatType)) for f in fields):
        return df
    return df.select(*[nan_to_null(f.name).alias(f.name, metadata=f.metadata)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in fields])


def read_store(spark: SparkSession, path: str, dates=None) -> DataFrame:
    """Read a previously saved store (partitioned by ``date``)."""
    df = spark.read.parquet(path)
    if dates is not None:
        df = df.where(F.col("date").isin(normalise_dates(dates)))
    return df


def normalise_date_args(kwargs: dict) -> dict:
    """S4 + S3 argument handling: ``date`` -> ``dates``; ``start_date`` /
    ``end_date`` / ``date_freq`` -> an inclusive ``dates`` list only when
    ``dates`` is absent."""
    kw = dict(kwargs)
    if "date" in kw and "dates" not in kw:
        kw["dates"] = kw.pop("date")
    if "dates" not in kw and "start_date" in kw and "end_date" in kw:
        kw["dates"] = date_list(kw.pop("start_date"), kw.pop("end_date"), kw.pop("date_freq", "D"))
    return kw


def _freq_seconds(freq: str) -> int:
    f = freq.strip().lower()
    num = int("".join(ch for ch in f if ch.isdigit()) or 1)
    unit = f.lstrip("0123456789")
    mult = {"d": 86400, "h": 3600, "min": 60, "t": 60, "s": 1, "w": 7 * 86400}.get(unit)
    if mult is None:
        raise ValueError(f"unsupported frequency {freq!r}")
    return num * mult


def date_list(start, end, freq: str = "D") -> list[str]:
    """S3 (driver side, a configuration list): inclusive range formatted
    ``%Y-%m-%d`` -- a sub-daily frequency repeats dates. Empty -> ValueError."""
    t0 = dt.datetime.fromisoformat(str(start))
    t1 = dt.datetime.fromisoformat(str(end))
    step = dt.timedelta(seconds=_freq_seconds(freq))
    out, t = [], t0
    while t <= t1:
        out.append(t.strftime("%Y-%m-%d"))
        t += step
    if not out:
        raise ValueError(f"empty date range {start} .. {end}")
    return out


def date_frame(spark: SparkSession, start, end, freq: str = "D") -> DataFrame:
    """S3 as a DataFrame: ``sequence`` + ``explode`` of timestamps; ``start``
    and ``end`` may be literals or Columns of a one-row frame."""
    step = F.expr(f"INTERVAL {_freq_seconds(freq)} SECONDS")
    s = F.lit(start).cast("timestamp") if not hasattr(start, "_jc") else start
    e = F.lit(end).cast("timestamp") if not hasattr(end, "_jc") else end
    return spark.range(1).select(F.explode(F.sequence(s, e, step)).alias("t")).select(
        F.date_format("t", "yyyy-MM-dd").alias("date"))


def normalise_dates(dates) -> list[str]:
    if isinstance(dates, (str, dt.date)):
        dates = [dates]
    return [str(d)[:10] for d in dates]


def missing_dates(store: DataFrame, requested: DataFrame, time_col: str = "time") -> DataFrame:
    """Requested dates absent from the store (left anti join of
    the requested list against the store's distinct dates). Empty => reuse
    the store; otherwise (re)load those dates."""
    have = store.select(F.date_format(F.to_date(F.col(time_col)), "yyyy-MM-dd").alias("date")).distinct()
    return requested.select("date").distinct().join(have, "date", "left_anti")


def store_covers(store: DataFrame, requested: DataFrame | None, time_col: str = "time") -> bool:
    """S5 decision (one small action): every requested date is present; with
    no request the store must be non-empty."""
    if requested is None:
        return not store.isEmpty()
    return missing_dates(store, requested, time_col).isEmpty()


def existing_paths(spark: SparkSession, paths) -> list[str]:
    """Paths that exist, via the cluster file system (works for any Hadoop
    scheme: hdfs, s3a, gs, abfs, file)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def read_station_files(spark: SparkSession, paths, schema=None, fmt: str = "csv", **options):
    """One scan over many station files; absent ones are skipped and
    counted. Files vanishing between listing and reading are tolerated by
    ``ignoreMissingFiles``. Returns ``(df, n_skipped)``."""
    paths = list(paths)
    present = existing_paths(spark, paths)
    skipped = len(paths) - len(present)
    if not present:
        raise ValueError("no station file could be read")
    r = spark.read.format(fmt).option("ignoreMissingFiles", "true").options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(present), skipped


def listed_files(spark: SparkSession, folders) -> DataFrame:
    """``path, length`` of the files under ``folders``, as a table: Spark lists
    many folders on the executors, and no content is read. Absent folders have
    no files."""
    there = existing_paths(spark, sorted(set(folders)))
    if not there:
        return spark.createDataFrame([], "path string, length long")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)
            .select("path", "length"))


def _plain_path(c):
    """A path without scheme and authority (``file:///a``, ``file:/a``, ``/a``)."""
    return F.regexp_replace(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def read_station_manifest(spark: SparkSession, paths, schema, fmt: str = "csv", **options):
    """S7 with an account of every file: ``(df, manifest)``.

    ``df`` has the rows of all files that can be read; absent ones are left out
    and corrupt ones skipped (``ignoreCorruptFiles``). ``manifest`` has a row for
    each requested path: ``path, status, n_rows`` with status ``read``,
    ``absent`` (not there, or without a byte: Spark lists no empty files) or
    ``unreadable`` (there, but without a row that could be read). One call to the file system per folder, not per file:
    the listing is a table, requested paths meet it in joins, and the rows per
    file come from the scan's own file names."""
    paths = sorted(set(paths))
    wanted = spark.createDataFrame([(p,) for p in paths], "path string").withColumn("__p", _plain_path("path"))
    files = listed_files(spark, [os.path.dirname(p) for p in paths]).select(
        _plain_path("path").alias("__p"), "length").distinct()
    found = wanted.join(files, "__p", "left")
    present = [r["path"] for r in found.where("length is not null").select("path").collect()]
    r = spark.read.format(fmt).options(**options).option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    r = r.schema(schema)
    if present:
        df = r.load(present)
        read = df.groupBy(F.input_file_name().alias("__f")).agg(F.count(F.lit(1)).alias("n_rows"))
        read = read.select(F.url_decode(_plain_path("__f")).alias("__p"), "n_rows")
    else:
        df = spark.createDataFrame([], schema)
        read = spark.createDataFrame([], "__p string, n_rows long")
    status = (F.when(F.col("length").isNull(), "absent").when(F.col("n_rows").isNotNull(), "read")
              .otherwise("unreadable"))
    manifest = found.join(read, "__p", "left").select("path", status.alias("status"),
                                                      F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    return df, manifest


def date_window(df: DataFrame, dates, time_col: str = "time") -> DataFrame:
    """Keep ``[min, max)`` of the requested dates; one date = that whole day."""
    ds = sorted(normalise_dates(dates))
    d0 = dt.date.fromisoformat(ds[0])
    d1 = dt.date.fromisoformat(ds[-1])
    if d0 == d1:
        d1 = d0 + dt.timedelta(days=1)
    t = F.col(time_col)
    return df.where((t >= F.lit(d0).cast("timestamp")) & (t < F.lit(d1).cast("timestamp")))


def overlapping_stations(history: DataFrame, dates, begin: str = "begin", end: str = "end") -> DataFrame:
    """Stations whose ``[begin, end]`` overlaps the requested dates."""
    ds = sorted(normalise_dates(dates))
    lo, hi = F.lit(ds[0]).cast("timestamp"), F.lit(ds[-1]).cast("timestamp")
    return history.where((F.col(end) >= lo) & (F.col(begin) <= hi))


def level_filter(df: DataFrame, filters: dict) -> DataFrame:
    """``{column: value or [values]}`` equality / membership filters
    (pushed to the Parquet scan); unknown columns are ignored."""
    for k, v in (filters or {}).items():
        if k not in df.columns:
            continue
        df = df.where(F.col(k).isin(list(v)) if isinstance(v, (list, tuple)) else F.col(k) == F.lit(v))
    return df


def ensure_nonempty(df: DataFrame, name: str = "dataset") -> DataFrame:
    """S12 (opt-in, runs a tiny job): error when nothing was loaded."""
    if df.isEmpty():
        raise ValueError(f"no data loaded for {name!r}")
    return df


# --- fixed values: sun-photometer text layout (S10) ---
PHOTOMETER_DATA_LINE = r"^\d{2}:\d{2}:\d{4},\d{2}:\d{2}:\d{2},"
PHOTOMETER_COLUMNS = ["date", "clock", "site_lat", "site_lon", "elevation", "aod_550nm"]
PHOTOMETER_FILL = -999.0  # missing-value marker of the text format


def parse_photometer_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Text lines (``spark.read.text`` of many files) -> point table.

    Preamble and header lines are dropped by the data-line pattern; fields are
    split on commas; ``dd:mm:yyyy`` + ``hh:mm:ss`` become a timestamp. Pure
    Column expressions, so the parse is distributed with the scan."""
    d = lines.where(F.col(value).rlike(PHOTOMETER_DATA_LINE))
    parts = F.split(F.col(value), ",")
    cols = {n: parts.getItem(i) for i, n in enumerate(PHOTOMETER_COLUMNS)}
    # try_* forms: one malformed line yields NULLs instead of failing the job
    aod = cols["aod_550nm"].try_cast("double")
    return d.select(
        F.try_to_timestamp(F.concat_ws(" ", cols["date"], cols["clock"]),
                           F.lit("dd:MM:yyyy HH:mm:ss")).alias("time"),
        cols["site_lat"].try_cast("double").alias("lat"),
        cols["site_lon"].try_cast("double").alias("lon"),
        cols["elevation"].try_cast("double").alias("elevation"),
        F.when(aod != PHOTOMETER_FILL, aod).alias("aod_550nm"),
    )


# --- fixed values: names of a photometer header, without their units (S10) ---
PHOTOMETER_HEADER = r"^Date\(dd:mm:yyyy\),"
PHOTOMETER_NAMES = {"lat": "site_latitude", "lon": "site_longitude", "elevation": "site_elevation", "aod_550nm": "aod_550nm"}


def parse_photometer_files(lines: DataFrame, names: dict[str, str] | None = None, file: str = "file",
                           value: str = "value") -> DataFrame:
    """S10 by header: ``lines`` (``file, value``: lines of many files, see
    :func:`read_photometer_files`) -> ``file, time`` and a column for each of
    ``names`` (output name -> header name in lower case without its unit in
    brackets).

    Every file's own header row says which field is which, so files with other
    column orders or more columns go into one scan: the header (one row a file)
    is joined by file name, and a data line becomes a map of header name to
    field. A column that a file does not have is NULL, and so are the fill
    value and malformed fields; lines of a file without a header are dropped."""
    from ..operators.stats import join_group_values
    names = names or PHOTOMETER_NAMES
    head = lines.where(F.col(value).rlike(PHOTOMETER_HEADER)).groupBy(file).agg(F.min(value).alias("__h"))
    fields = F.transform(F.split("__h", ","), lambda h: F.lower(F.trim(F.regexp_replace(h, r"\(.*\)", ""))))
    # of two columns of one name the first counts
    head = head.select(file, F.transform(fields, lambda h, i: F.when(F.array_position(fields, h) == i + 1, h).otherwise(
        F.concat(F.lit("#"), i.cast("string")))).alias("__names"))
    d = join_group_values(lines.select(file, value).where(F.col(value).rlike(PHOTOMETER_DATA_LINE)), head, [file])
    got = F.slice(F.concat(F.split(value, ","), F.array_repeat(F.lit(None).cast("string"), F.size("__names"))), 1, F.size("__names"))
    d = d.withColumn("__row", F.map_from_arrays("__names", got))

    def number(name):
        v = F.try_element_at("__row", F.lit(name)).try_cast("double")
        return F.when(v != PHOTOMETER_FILL, v)
    time = F.try_to_timestamp(F.concat_ws(" ", F.try_element_at("__row", F.lit("date")), F.try_element_at("__row", F.lit("time"))),
                              F.lit("dd:MM:yyyy HH:mm:ss"))
    return d.select(file, time.alias("time"), *[number(h.lower()).alias(n) for n, h in names.items()])


def read_photometer_files(spark: SparkSession, paths) -> DataFrame:
    """``file, value``: the lines of text files with the file each comes from."""
    return spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")


# --- fixed values: dataset types named in configurations (S1) ---
GRID_TYPES = ("cmaq", "wrfchem", "gefs", "gfs", "icap_mme", "merra2", "ufs", "viirs")
POINT_TYPES = ("aeronet", "airnow", "ish_lite", "openaq", "radiosonde")
# --- fixed values: default level filter for gridded message files when none is
# given (2 m above ground: first surface type 103 at scaled value 2, no second surface) ---
DEFAULT_2M_FILTER = {"typeOfFirstFixedSurface": 103, "scaledValueOfFirstFixedSurface": 2,
                     "typeOfSecondFixedSurface": 255}


def load_named(spark: SparkSession, name: str, dataset_type: str, path, fmt: str = "parquet",
               schema=None, time_col: str = "time", order_col: str | None = None, **kwargs) -> DataFrame:
    """S1 by dataset type: the long-form store of a named source, with the
    type's conventions -- message-level filter default for GRIB-derived grids
    (applied only if the columns exist), rename presets (P13), the first row
    kept per time and site for sun-photometer tables (S13, ``order_col`` =
    ingest order) -- then the user's date list, subsets, renames, scale and
    offset. Unknown types raise."""
    from ..operators.conform import RENAME_PRESETS
    from ..operators.dedup import keep_first
    if dataset_type not in GRID_TYPES + POINT_TYPES:
        raise ValueError(f"unknown dataset type {dataset_type!r}")
    kw = normalise_date_args(kwargs)
    filters = kw.get("filters")
    if filters is None and dataset_type in ("gfs", "gefs"):
        filters = DEFAULT_2M_FILTER
    rename_map = {**RENAME_PRESETS.get(dataset_type, {}), **(kw.get("rename") or {})}
    spec = SourceSpec(path=path, fmt=fmt, schema=schema, options=kw.get("options", {}), rename=rename_map,
                      scale=kw.get("scale"), offset=kw.get("offset"), isel=kw.get("isel"), sel=kw.get("sel"),
                      filters=filters)
    df = load_data(spark, spec, dates=kw.get("dates"), time_col=time_col)
    if dataset_type == "aeronet" and order_col and time_col in df.columns:
        site = [c for c in ("site_id", "lat", "lon") if c in df.columns]
        df = keep_first(df, [time_col, *site], [order_col])
    from ..operators.conform import with_history
    from ..operators.reduce import value_columns
    for c in value_columns(df, (time_col, "lat", "lon", "site_id", "date", *(filters or {}))):
        df = with_history(df, c, f"Loaded dataset '{name}' of type '{dataset_type}'")
    return df
