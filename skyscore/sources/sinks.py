"""Sinks (K1-K5): idempotent saves, versioned snapshots, statistics files.

Writes are plain DataFrame writers: every task writes its own files, the
commit protocol makes the job atomic and re-runnable after executor loss;
``overwrite`` with dynamic partition overwrite replaces only the dates
being written.
"""

from __future__ import annotations

import datetime as dt
import math
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: accepted storage backends (K3) ---
BACKENDS = ("parquet", "orc", "json", "csv")


def _check(df, backend: str):
    if not isinstance(df, DataFrame):
        raise TypeError(f"save expects a DataFrame, got {type(df).__name__}")
    if backend not in BACKENDS:
        raise ValueError(f"unsupported backend {backend!r}; use one of {BACKENDS}")


def save_data(df: DataFrame, url: str, backend: str = "parquet", partition_by="date",
              time_col: str = "time", dynamic: bool = True) -> str:
    """K1: overwrite the store at ``url`` (parents are created by the writer).
    A ``date`` partition column is derived from ``time`` when asked for and
    absent. With ``dynamic`` only the partitions present in ``df`` are
    replaced, so re-saving a day is idempotent and leaves other days intact."""
    _check(df, backend)
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if "date" in parts and "date" not in df.columns and time_col in df.columns:
        df = df.withColumn("date", F.date_format(F.col(time_col), "yyyy-MM-dd"))
    w = df.write.mode("overwrite").format(backend)
    if parts:
        w = w.partitionBy(*parts)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.save(url)
    return url


SNAPSHOT_LOG = "_snapshots"
SNAPSHOT_SCHEMA = T.StructType([T.StructField("snapshot", T.LongType()),
                                T.StructField("message", T.StringType()),
                                T.StructField("committed_at", T.TimestampType())])


def _log(spark: SparkSession, url: str) -> DataFrame | None:
    try:
        return spark.read.schema(SNAPSHOT_SCHEMA).parquet(os.path.join(url, SNAPSHOT_LOG))
    except Exception:  # no log yet
        return None


def save_versioned(df: DataFrame, url: str, message: str, backend: str = "parquet") -> int:
    """K2: write a new immutable snapshot ``url/snapshot=<n>`` and then commit
    it by appending ``(n, message, time)`` to ``url/_snapshots``. Readers
    only see committed snapshots, so a failed write is never visible."""
    _check(df, backend)
    spark = df.sparkSession
    log = _log(spark, url)
    n = 0 if log is None else (log.agg(F.max("snapshot")).first()[0] or 0) + 1
    df.write.mode("overwrite").format(backend).save(os.path.join(url, f"snapshot={n}"))
    row = spark.createDataFrame([(n, message, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))],
                                SNAPSHOT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(os.path.join(url, SNAPSHOT_LOG))
    return n


def read_versioned(spark: SparkSession, url: str, snapshot: int | None = None,
                   backend: str = "parquet") -> DataFrame:
    """Read the latest committed snapshot (or a given one)."""
    log = _log(spark, url)
    if log is None:
        raise ValueError(f"no committed snapshot at {url}")
    if snapshot is None:
        snapshot = log.agg(F.max("snapshot")).first()[0]
    return spark.read.format(backend).load(os.path.join(url, f"snapshot={snapshot}"))


def snapshot_log(spark: SparkSession, url: str) -> DataFrame:
    log = _log(spark, url)
    if log is None:
        raise ValueError(f"no committed snapshot at {url}")
    return log


def save_statistics(stats: DataFrame, savename: str, keys=(), average: bool = True) -> str:
    """K4: ``.csv`` / ``.json`` via the distributed writer; otherwise a
    Markdown table with 4 decimals, in a file of the driver, written partition
    by partition. Without ``keys`` the rows are averaged to one (a single row
    stays as it is) -- this is not the pooled score; ``average=False`` keeps
    every row."""
    keys = list(keys)
    metric_cols = [c for c in stats.columns if c not in keys]
    if not keys and average:
        stats = stats.agg(*[F.avg(c).alias(c) for c in metric_cols])
    if savename.endswith(".csv"):
        stats.write.mode("overwrite").option("header", True).csv(savename)
        return savename
    if savename.endswith(".json"):
        stats.write.mode("overwrite").json(savename)
        return savename
    # a human-readable report; large per-cell results belong in csv/json/parquet
    with open(savename, "w") as fh:
        for r in stats.toLocalIterator():
            fh.write(markdown_table([r], keys, metric_cols))
    return savename


def _fmt(v) -> str:
    if v is None:
        return "nan"
    if isinstance(v, float):
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        if math.isnan(v):
            return "nan"
        return f"{v:.4f}"
    return str(v)


def markdown_table(rows, keys, metric_cols) -> str:
    """Statistics as Markdown: one ``| Metric | Value |`` table per group."""
    out = []
    for r in rows:
        d = r.asDict()
        if keys:
            out.append("## " + ", ".join(f"{k}={d[k]}" for k in keys) + "\n")
        out.append("| Metric | Value |\n|--------|-------|")
        out.extend(f"| {m} | {_fmt(d[m])} |" for m in metric_cols)
        out.append("")
    return "\n".join(out) + "\n"
