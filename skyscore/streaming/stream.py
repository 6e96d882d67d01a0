"""Structured Streaming forms of the pairing and window statistics.

The reference is batch only; these are the incremental equivalents:

* X1 ``stream_pair_nearest``: observation stream x static grid (stream-static
  joins; the static side is re-read per micro-batch, so a growing model store
  is picked up).
* X2 ``stream_window_stats``: tumbling-window single-pass metrics with a
  watermark; append mode emits a window once the watermark passes its end.
* X3 ``stream_pair_streams``: obs and model both streaming, inner join on
  cell and time with watermarks on both sides (bounded state); run to a table,
  the rows that may still match lie in files, not in a state store.
* X4 ``stream_dedup``: ``dropDuplicatesWithinWatermark``.

``run_to_table`` drives a query to completion with ``availableNow`` (all data
present, then stop) into the file sink and returns the result as a batch
DataFrame; output and checkpoint live under the shared
``spark.checkpoint.dir``, so a restarted driver resumes rather than recomputes.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import Ctx, resolve
from ..functions.numerics import pairwise_valid
from ..operators.pairing import grid_axes, indexed_grid, RegularAxis
from ..session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stream_window_stats(stream: DataFrame, obs: str, mod: str, freq: str = "3 hours",
                        watermark: str = "6 hours", metrics=("n", "mb", "rmse", "mae"),
                        time: str = "time", by=()) -> DataFrame:
    """Per window (and ``by``) single-pass metrics. Centred metrics need a
    second pass over a closed group and are rejected here."""
    resolved = resolve(metrics)
    bad = [r for r, m in resolved if m.centred]
    if bad:
        raise ValueError(f"centred metrics need the batch path: {bad}")
    s = stream.where(pairwise_valid(obs, mod)).withWatermark(time, watermark)
    ctx = Ctx(o=F.col(obs).cast("double"), m=F.col(mod).cast("double"))
    partials = {}
    for _, met in resolved:
        for k, v in met.aggs(ctx).items():
            partials.setdefault(k, v)
    agg = s.groupBy(F.window(time, freq).alias("__w"), *by).agg(*[v.alias(k) for k, v in partials.items()])
    return agg.select(F.col("__w.start").alias(time), *by,
                      *[met.final(F.col).cast(met.dtype).alias(raw) for raw, met in resolved])


def stream_pair_nearest(stream: DataFrame, grid: DataFrame, var, lat_axis: RegularAxis,
                        lon_axis: RegularAxis, lat="lat", lon="lon", time="time") -> DataFrame:
    """Each streamed observation takes its nearest static grid cell's
    value at its time (stream-static left outer join on integer indices).
    The axes are given explicitly: a streaming plan cannot infer them."""
    var = [var] if isinstance(var, str) else list(var)
    axes = grid_axes(grid, lat, lon, lat_axis, lon_axis)
    g = indexed_grid(grid, axes, var, lat, lon, time)
    la, lo = lat_axis, lon_axis
    i = F.floor((F.col(lat) - F.lit(float(la.first))) / F.lit(float(la.step)) + 0.5).cast("int")
    i = F.least(F.greatest(i, F.lit(0)), F.lit(la.n - 1))
    j = F.floor((F.col(lon) - F.lit(float(lo.first))) / F.lit(float(lo.step)) + 0.5).cast("int")
    j = F.pmod(j, F.lit(lo.n)) if lo.periodic else F.least(F.greatest(j, F.lit(0)), F.lit(lo.n - 1))
    keyed = stream.withColumn("__i", i).withColumn("__j", j)
    return keyed.join(g, [time, "__i", "__j"], "left").drop("__i", "__j")


def _pairs(o: DataFrame, m: DataFrame, keys, time: str, tolerance: str) -> DataFrame:
    """Inner join on ``keys`` and time; the model's time is called ``__mt``."""
    o, m = o.alias("o"), m.alias("m")
    cond = [F.col(f"o.{k}") == F.col(f"m.{k}") for k in keys]
    cond.append(F.col("m.__mt").between(F.col(f"o.{time}") - F.expr(f"INTERVAL {tolerance}"),
                                        F.col(f"o.{time}") + F.expr(f"INTERVAL {tolerance}")))
    return o.join(m, cond, "inner").drop(*[F.col(f"m.{k}") for k in keys])


@dataclass(frozen=True)
class StreamPairs:
    """Two streams to be paired (:func:`stream_pair_streams`). ``stream`` is
    Spark's stream-stream join, whose state holds every row of both sides that
    may still match; all methods of a DataFrame but ``select`` are its.
    :func:`run_to_table` keeps what has arrived as files instead."""
    obs: DataFrame
    model: DataFrame
    keys: tuple[str, ...]
    time: str
    watermarks: tuple[str, str]
    tolerance: str
    columns_wanted: tuple | None = None

    @property
    def stream(self) -> DataFrame:
        return self.pairs(self.obs.withWatermark(self.time, self.watermarks[0]),
                          self.model.withWatermark("__mt", self.watermarks[1]))

    def pairs(self, obs: DataFrame, model: DataFrame) -> DataFrame:
        d = _pairs(obs, model, self.keys, self.time, self.tolerance)
        return d if self.columns_wanted is None else d.select(*self.columns_wanted)

    def select(self, *cols):
        if self.columns_wanted is not None:
            return self.stream.select(*cols)
        return replace(self, columns_wanted=cols)

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.stream, name)


def stream_pair_streams(obs: DataFrame, model: DataFrame, keys, time: str = "time",
                        obs_watermark: str = "2 hours", model_watermark: str = "2 hours",
                        tolerance: str = "0 seconds") -> StreamPairs:
    """Stream-stream inner join on ``keys`` and time (within
    ``tolerance``); watermarks on both sides bound what is kept."""
    return StreamPairs(obs, model.withColumnRenamed(time, "__mt"), tuple(keys), time, (obs_watermark, model_watermark), tolerance)


def stream_dedup(stream: DataFrame, keys, time: str = "time", watermark: str = "1 hour") -> DataFrame:
    """Drop repeated records of the same key arriving within the watermark."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(keys))


def _run_pairs(p: StreamPairs, base: str) -> DataFrame:
    """Both streams as one query. Each micro-batch adds its rows to the table of
    what has arrived, under its own number, and writes the pairs with one of its
    rows on either side: a batch join, so sorted and spilled, not held in
    memory. As in Spark's join, rows behind the watermark (the lesser of the two
    sides', as the micro-batch before knew it) are late and dropped, and rows
    that no later one can match are not read again. A repeated micro-batch
    writes the same files again."""
    spark = p.obs.sparkSession
    o, m = F.struct(*[F.col(f"`{c}`") for c in p.obs.columns]), F.struct(*[F.col(f"`{c}`") for c in p.model.columns])
    otype, mtype = (d.select(s.alias("r")).schema["r"].dataType for d, s in ((p.obs, o), (p.model, m)))
    known = lambda d, t: d.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in (*p.keys, t))))
    both = known(p.obs, p.time).select(F.lit("o").alias("__side"), F.col(p.time).alias("__t"), o.alias("__o"),
                                       F.lit(None).cast(mtype).alias("__m")).unionByName(
        known(p.model, "__mt").select(F.lit("m").alias("__side"), F.col("__mt").alias("__t"),
                                      F.lit(None).cast(otype).alias("__o"), m.alias("__m")))
    schema = T.StructType([*both.schema.fields, T.StructField("__batch", T.LongType())])
    reach = F.expr(f"INTERVAL {p.tolerance}")

    def closed_before(arrived: DataFrame, number: int):
        """The watermark for a micro-batch; none until both sides have come."""
        ends = arrived.where(F.col("__batch") < number - 1).groupBy("__side").agg(F.max("__t").alias("t"))
        after = F.when(F.col("__side") == "o", F.col("t") - F.expr(f"INTERVAL {p.watermarks[0]}")).otherwise(
            F.col("t") - F.expr(f"INTERVAL {p.watermarks[1]}"))
        found = ends.agg(F.count(F.lit(1)).alias("n"), F.min(after).alias("w")).first()
        return found["w"] if found["n"] == 2 else None

    def write(rows: DataFrame, number: int) -> None:
        there = rows.sparkSession.read.schema(schema)
        closed = closed_before(there.parquet(os.path.join(base, "arrived")), number) if number > 1 else None
        if closed is not None:
            rows = rows.where(F.col("__t") > F.lit(closed))
        rows.write.mode("overwrite").partitionBy("__side").parquet(os.path.join(base, "arrived", f"__batch={number}"))
        arrived = there.parquet(os.path.join(base, "arrived")).where(F.col("__batch") <= number)
        if closed is not None:
            arrived = arrived.where(F.col("__t") + reach > F.lit(closed))
        obs, model = arrived.where("__side = 'o'"), arrived.where("__side = 'm'")
        fresh = F.col("__batch") == number
        out = p.pairs(obs.where(fresh).select("__o.*"), model.select("__m.*"))
        if number:
            out = out.unionByName(p.pairs(obs.where(~fresh).select("__o.*"), model.where(fresh).select("__m.*")))
        out.write.mode("overwrite").parquet(os.path.join(base, "out", f"__batch={number}"))

    result = p.pairs(p.obs, p.model).schema
    # a stream without any file has a result, too
    spark.createDataFrame([], result).write.mode("ignore").parquet(os.path.join(base, "out", "__batch=-1"))
    q = (both.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(base, "checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    found = spark.read.schema(T.StructType([*result.fields, T.StructField("__batch", T.LongType())]))
    return found.parquet(os.path.join(base, "out")).drop("__batch")


def run_to_table(df: DataFrame | StreamPairs, name: str | None = None, output_mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame to completion (``availableNow``) and return
    its output as a batch DataFrame. The output goes to the exactly-once
    Parquet file sink under the shared ``spark.checkpoint.dir`` (nothing is
    gathered on the driver), next to the query's checkpoint, so a restarted
    driver resumes the same query. Two paired streams run by :func:`_run_pairs`,
    in the same places."""
    if isinstance(df, StreamPairs):
        name = name or f"stream_{uuid.uuid4().hex[:12]}"
        return _run_pairs(df, os.path.join(ensure_checkpoint_dir(df.obs.sparkSession), "streams", name))
    spark = df.sparkSession
    name = name or f"stream_{uuid.uuid4().hex[:12]}"
    base = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    q = (df.writeStream.format("parquet").outputMode(output_mode)
           .option("path", os.path.join(base, "out"))
           .option("checkpointLocation", os.path.join(base, "checkpoint"))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    return spark.read.schema(df.schema).parquet(os.path.join(base, "out"))


def run_to_latest(df: DataFrame, keys, name: str | None = None) -> DataFrame:
    """Run a streaming aggregate over a bounded input to its end and return
    **every** group as a batch DataFrame, also those whose window the watermark
    has not closed: update mode gives a group's row whenever a micro-batch
    changed it, each micro-batch writes its rows under its own number (a
    repeated one writes the same files again), and the row of the last number
    counts. Nothing is gathered on the driver."""
    spark = df.sparkSession
    base = os.path.join(ensure_checkpoint_dir(spark), "streams", name or f"stream_{uuid.uuid4().hex[:12]}")

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(os.path.join(base, "out", f"__batch={number}"))
    q = (df.writeStream.outputMode("update").foreachBatch(write)
           .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    out = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__batch", T.LongType())])).parquet(os.path.join(base, "out"))
    rest = [c for c in df.columns if c not in keys]
    last = out.groupBy(*keys).agg(F.max(F.struct("__batch", *rest)).alias("__last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__last.{c}").alias(c) for c in df.columns])


def run_to_files(df: DataFrame, path: str, fmt: str = "parquet", output_mode: str = "append") -> str:
    """Same, into files (exactly-once file sink) for outputs of any size."""
    spark = df.sparkSession
    ck = os.path.join(ensure_checkpoint_dir(spark), "streams", uuid.uuid4().hex[:12])
    q = (df.writeStream.format(fmt).outputMode(output_mode).option("path", path)
           .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return path
