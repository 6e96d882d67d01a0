"""De-duplication and ordering.

"Keep the first row per key" is an aggregate, not a window: ``min`` of a
struct whose leading fields are the ordering columns. The aggregate is
partial on the map side, so a hot key (say a third of all rows) is reduced
inside every task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``order`` columns
    (remaining columns break exact ties, so the result is deterministic)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return best.select(*keys, *[F.col(f"__first.__o{i}").alias(c) for i, c in enumerate(order)],
                       *[F.col(f"__first.{c}") for c in rest]).select(*df.columns)


def drop_duplicate_times(df: DataFrame, time: str = "time", order=None, kind: str = "grid",
                         cell=("y", "x")) -> DataFrame:
    """D1-D3. ``kind='grid'``: keep the first row per (time, cell) -- only when
    an x or y dimension exists; ``'table'``: first row per time; ``'point'``:
    never de-duplicated by time (every observation survives pairing).
    ``order`` names the ingest-order column(s) defining "first"; without it
    the remaining columns are used, which is deterministic."""
    if kind == "point":
        return df
    if kind == "grid":
        present = [c for c in cell if c in df.columns]
        if not present:
            return df
        keys = [time, *present]
    elif kind == "table":
        keys = [time]
    else:
        raise ValueError(f"unknown kind {kind!r}")
    order = order or [c for c in df.columns if c not in keys]
    return keep_first(df, keys, order)


def sort_by(df: DataFrame, cols, within_partitions: bool = False) -> DataFrame:
    """O1: a global sort for the sink, or a per-partition sort in flight."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.sortWithinPartitions(*cols) if within_partitions else df.orderBy(*cols)
