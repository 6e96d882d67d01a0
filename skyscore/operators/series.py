"""Time-window statistics and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import compute_statistics

# --- fixed values: frequency aliases understood by the window helpers ---
FREQ_UNITS = {"min": "minutes", "t": "minutes", "h": "hours", "d": "days", "s": "seconds", "w": "weeks"}


def spark_duration(freq: str) -> str:
    """'3h' -> '3 hours', 'h' -> '1 hours', 'D' -> '1 days'; Spark strings pass through."""
    f = freq.strip()
    if " " in f:
        return f
    num = "".join(ch for ch in f if ch.isdigit()) or "1"
    unit = f[len(num) if f[:len(num)].isdigit() else 0:].lower()
    if unit not in FREQ_UNITS:
        raise ValueError(f"unsupported frequency {freq!r}")
    return f"{num} {FREQ_UNITS[unit]}"


def time_window_stats(df: DataFrame, obs: str, mod: str, freq: str = "3h", stat="mb",
                      time: str = "time", by=()) -> DataFrame:
    """W1 (``timeseriesstat``): statistic(s) of all pairs in each tumbling
    window of length ``freq`` (aligned to the epoch), one aggregate."""
    stats = [stat] if isinstance(stat, str) else list(stat)
    w = df.withColumn("__win", F.window(time, spark_duration(freq)).start)
    s = compute_statistics(w, ["n", *stats] if "n" not in stats else stats, obs, mod, by=[*by, "__win"])
    return s.withColumnRenamed("__win", time)


def resample(df: DataFrame, freq: str = "1h", values=None, time: str = "time", keys=(),
             how: str = "mean") -> DataFrame:
    """Per key, mean (or other) of each value in tumbling windows."""
    values = [values] if isinstance(values, str) else list(values)
    agg = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[how]
    return (df.groupBy(*keys, F.window(time, spark_duration(freq)).start.alias(time))
              .agg(*[agg(v).alias(v) for v in values]))
