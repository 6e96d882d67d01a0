"""Sharding by a Hilbert curve over several metadata dimensions.

Dimensions are quantised, rows sorted by curve index, and the order cut into
runs of equal row counts, so a shard covers a compact region of every
dimension and its minima and maxima prune files. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, ranked, salts_for, table, written

BITS = 4


def hilbert_index(dims: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell with coordinates ``dims`` (each
    0 .. 2**bits - 1): the transpose form of the curve, undone bit plane by bit
    plane as a fold over the planes. ``len(dims) * bits`` must stay under 63."""
    n = len(dims)
    if not 2 <= n or n * bits > 62:
        raise ValueError("2 dimensions at least, 62 bits at most")
    x = F.array(*[d.cast("long") for d in dims])
    steps = [(q, i) for q in range(bits - 1, 0, -1) for i in range(n)]
    plan = F.array(*[F.struct(F.lit(1 << q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps]) \
        if steps else F.array().cast("array<struct<q:bigint,i:int>>")

    def step(a, s):
        p = s["q"] - 1
        mine, first = F.get(a, s["i"]), F.get(a, F.lit(0))
        swap = first.bitwiseXOR(mine).bitwiseAND(p)
        set_ = mine.bitwiseAND(s["q"]) != 0
        return F.transform(a, lambda v, j: F.when(
            set_, F.when(j == 0, v.bitwiseXOR(p)).otherwise(v)).otherwise(
            F.when(j == 0, F.when(s["i"] == 0, v).otherwise(v.bitwiseXOR(swap)))
            .when(j == s["i"], v.bitwiseXOR(swap)).otherwise(v)))

    # Gray code: a running exclusive or along the coordinates; then the last
    # coordinate's planes decide a correction of them all
    zero = F.array(F.lit(0).cast("long"))
    planes = F.array(*[F.lit(1 << q).cast("long") for q in range(bits - 1, 0, -1)]) if bits > 1 \
        else F.array().cast("array<bigint>")
    order = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, -1, -1) for i in range(n)])

    def gray(y):
        return F.slice(F.aggregate(y, zero, lambda acc, v: F.concat(
            acc, F.array(F.element_at(acc, -1).bitwiseXOR(v)))), 2, n)

    def fix(g):
        return let(F.aggregate(planes, F.lit(0).cast("long"), lambda acc, q: F.when(
            F.element_at(g, -1).bitwiseAND(q) != 0, acc.bitwiseXOR(q - 1)).otherwise(acc)),
            lambda t: F.transform(g, lambda v: v.bitwiseXOR(t)))

    def interleave(z):
        return F.aggregate(order, F.lit(0).cast("long"), lambda acc, s: (acc * 2).bitwiseOR(
            F.when(F.get(z, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0)))

    return let(gray(F.aggregate(plan, x, step)), lambda g: let(fix(g), interleave))


def value_cuts(df: DataFrame, column: str, cells: int) -> list:
    """Up to ``cells - 1`` values that cut the ordered values of ``column`` into
    steps of about equal row counts: a value's step is where the middle of its
    rows falls. One row a distinct value is sorted by range and counted in two
    levels (inside a range, then over the ranges); only the cuts come to the
    driver."""
    n = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    d = written(n.orderBy("v").withColumn("piece", F.spark_partition_id()), "values")
    ahead = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (d.groupBy("piece").agg(F.sum("n").alias("m"))
              .select(F.col("piece").alias("_piece"), F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("ahead"),
                      F.sum("m").over(Window.partitionBy()).alias("all")))
    inside = Window.partitionBy("piece").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(pieces, F.col("piece") == F.col("_piece"))
    d = d.withColumn("step", F.expr(f"((2 * (ahead + before) + n) * {cells}) div (2 * all)"))
    return sorted(r["v"] for r in d.groupBy("step").agg(F.min("v").alias("v")).collect())[1:]


def quantise(df: DataFrame, columns: list[str], bits: int = BITS) -> list[Column]:
    """A 0 .. 2**bits - 1 coordinate for each column, that rises with its
    values: steps of about equal row counts, cut between the quantiles of all
    rows for numbers, at values of :func:`value_cuts` for other types (text
    form of arrays, maps and the like). 2**bits - 1 cuts a column come to the
    driver. Null: 0."""
    cells = 1 << bits
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in columns if isinstance(kinds[c], T.NumericType)]
    cuts = {}
    if numbers:
        at = [i / cells for i in range(1, cells)]
        row = df.agg(*[F.percentile_approx(c, at, 1000).alias(str(i)) for i, c in enumerate(numbers)]).first()
        cuts = {c: sorted(set(row[str(i)] or [])) for i, c in enumerate(numbers)}
    out = []
    for c in columns:
        if c in cuts:
            step = sum([(F.col(c) > F.lit(v)).cast("int") for v in cuts[c]], F.lit(0))
        else:
            plain = isinstance(kinds[c], (T.StringType, T.DateType, T.TimestampType, T.BooleanType))
            value = F.col(c) if plain else F.col(c).cast("string")
            step = sum([(value >= F.lit(v)).cast("int") for v in value_cuts(df.select(value.alias(c)), c, cells)], F.lit(0))
        out.append(F.when(F.col(c).isNull(), 0).otherwise(step))
    return out


def shard(df: DataFrame, dims: list[str], shards: int, tie: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve`` (index of the row's cell), ``shard`` and ``slot``.

    Rows are ordered by (curve, hash of ``tie``, ``tie``) and cut into
    ``shards`` runs whose counts are at most one apart; ``slot`` counts from 0
    along the curve inside a shard. A cell of any size is split: ranks are
    counted per (cell, hash bucket) and summed up the curve in two levels.
    Repeated rows have slots of their own; no rows give no rows.
    """
    n = len(dims)
    d = df.withColumn("curve", hilbert_index(quantise(df, dims, bits), bits))
    salt = F.xxhash64(*[F.col(c) for c in tie])
    d = written(d.withColumn("_h", salt), "curve")
    d = ranked(d, ["curve"], ["_h", *tie], F.shiftrightunsigned(F.col("_h"), 1), "_rank", salts_for(d.count()))
    # rows before each cell: the cells' counts, first within a coarse stretch of
    # the curve, then over the (at most 2**bits) stretches
    low = (n - 1) * bits
    cells = d.groupBy("curve").agg(F.count(F.lit(1)).alias("_n")).withColumn("_top", F.shiftright("curve", low))
    inner = Window.partitionBy("_top").orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_top2").rowsBetween(Window.unboundedPreceding, -1)
    tops = (cells.groupBy(F.col("_top").alias("_top2")).agg(F.sum("_n").alias("_m"))
            .withColumn("_tbase", F.coalesce(F.sum("_m").over(outer), F.lit(0)))
            .withColumn("_all", F.sum("_m").over(Window.partitionBy())))
    cells = (cells.withColumn("_cbase", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
             .join(tops, F.col("_top") == F.col("_top2"))
             .select(F.col("curve").alias("_curve"), (F.col("_cbase") + F.col("_tbase")).alias("_before"), "_all"))
    d = d.join(cells, F.col("curve") == F.col("_curve")).withColumn("_pos", F.col("_before") + F.col("_rank"))
    # integer arithmetic: shard s holds positions ceil(s n / k) .. ceil((s + 1) n / k) - 1
    d = d.withColumn("shard", F.expr(f"int((_pos * {shards}) div _all)"))
    first = F.expr(f"(shard * _all + {shards} - 1) div {shards}")
    return d.withColumn("slot", (F.col("_pos") - first).cast("long")).drop(
        "_h", "_rank", "_curve", "_before", "_all", "_pos")


def shard_ranges(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Zone map: row count, least and greatest value of each column per shard."""
    aggs = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *aggs)


SHARDS = 8


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a curve over (lang, source, size), law ``rows``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = shard(docs, ["lang", "source", "size"], SHARDS, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "curve")
