"""Vertical profiles (W6, A14, V8; P14 lives in ``conform``).

A sounding is the set of rows sharing a ``valid_time``; levels per sounding
are few (tens), so a window per ``valid_time`` over the model's levels is a
bounded partition, and the bracket join's fan-out is bounded by
levels x levels per sounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interp_to_pressure(obs: DataFrame, model: DataFrame, var: str, time: str = "valid_time",
                       obs_p: str = "press", mod_p: str = "isobaric_surface", out: str | None = None,
                       keys=()) -> DataFrame:
    """Linearly interpolate model ``var`` (on its pressure levels) to the
    observed pressure of each obs row of the same sounding (``keys`` + time,
    e.g. a site id). Levels are taken in ascending pressure; the top interval
    is closed; outside the model's range the value is NULL."""
    out = out or f"{var}_model"
    keys = list(keys)
    sk = [*keys, time]
    w = Window.partitionBy(*sk).orderBy(mod_p)
    iv = model.select(*sk, F.col(mod_p).cast("double").alias("__p0"), F.col(var).alias("__v0"),
                      F.lead(F.col(mod_p).cast("double")).over(w).alias("__p1"),
                      F.lead(var).over(w).alias("__v1"))
    iv = iv.withColumn("__last", F.lead("__p1").over(Window.partitionBy(*sk).orderBy("__p0")).isNull()) \
           .where(F.col("__p1").isNotNull())
    o = obs.select(*sk, F.col(obs_p).cast("double").alias("__p")).distinct()
    cond = (F.col("__p0") <= F.col("__p")) & ((F.col("__p") < F.col("__p1")) |
                                               (F.col("__last") & (F.col("__p") == F.col("__p1"))))
    m = o.join(iv, sk).where(cond)
    val = F.col("__v0") + (F.col("__v1") - F.col("__v0")) * (F.col("__p") - F.col("__p0")) / (F.col("__p1") - F.col("__p0"))
    m = m.select(*sk, F.col("__p").alias(obs_p), val.alias(out))
    return obs.join(m, [*sk, obs_p], "left")


def profile_mean(df: DataFrame, level: str, values, time: str = "valid_time", press: str = "press",
                 keys=()) -> DataFrame:
    """Mean over soundings per level (and ``keys``), keeping the first
    sounding's pressure (``min_by`` -- a partial aggregate, no sort)."""
    values = [values] if isinstance(values, str) else list(values)
    return df.groupBy(*keys, level).agg(F.min_by(press, time).alias(press),
                                 *[F.avg(v).alias(v) for v in values])
