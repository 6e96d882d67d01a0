"""Combining several paired datasets along a new key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_paired(paired: dict, dim: str = "model") -> DataFrame:
    """Tag each paired DataFrame with its name in column ``dim`` and
    stack them (union by name; columns missing on one side become NULL).
    A union is a narrow operation: no shuffle."""
    if not isinstance(paired, dict) or not paired:
        raise ValueError("combine needs a non-empty dict of paired datasets")
    bad = [k for k, v in paired.items() if not isinstance(v, DataFrame)]
    if bad:
        raise TypeError(f"unsupported dataset types for {bad}")
    tagged = [df.withColumn(dim, F.lit(str(name))) for name, df in paired.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_many(spark, paths, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """U4: one scan over many files (one DataFrame, not a Python loop)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(list(paths))
