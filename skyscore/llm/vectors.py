"""Helpers of the vector operators: rows that take part, blocks of rows in
Parquet with a zone map each, chunks of queries, and the choice of the blocks
that a chunk must read.

A *block* is one Parquet row: ``bid, w`` (components of its vectors), ``n``,
``ids``, ``xs`` and more columns as packed arrays, and ``zone`` (least and
greatest value of each dimension, float64). A *chunk* is one row with up to a
fixed number of queries: ``cid, w, n, ids, xs`` and more. Zones are packed into
pages and chunks meet every page in a square (an equi join on its cells), so
that the choice moves no vectors of the searched rows; only chosen chunks go to
a group of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: zones in one page
PAGE = 64
#: components of the vectors in one group of blocks
GROUP = 1 << 22


def whole(vector: str) -> Column:
    """True for a vector that is not null and holds neither null nor
    non-finite components."""
    bad = F.exists(F.col(vector), lambda v: v.isNull() | F.isnan(v.cast("double"))
                   | (F.abs(v.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """Rows of equal length of a list column as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)


def runs(batches: Iterator[pa.RecordBatch], vector: str, per: int) -> Iterator[tuple[int, pa.Table]]:
    """Consecutive rows whose vectors have equal lengths, at most ``per`` at a
    time, with that length."""
    held, size, width = [], 0, None
    for b in batches:
        lengths = b.column(b.schema.get_field_index(vector)).value_lengths().to_numpy(zero_copy_only=False)
        at = 0
        while at < len(lengths):
            if size and (size == per or lengths[at] != width):
                yield width, pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            width = int(lengths[at])
            end = at + int(np.argmax(np.append(lengths[at:at + per - size] != width, True)))
            held.append(b.slice(at, end - at))
            size, at = size + end - at, end
    if size:
        yield width, pa.Table.from_batches(held).combine_chunks()


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches, one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}


def block_number(partition: int, number: int) -> int:
    return (partition << 32) + number


def pages(blocks: DataFrame) -> DataFrame:
    """``page, w, bids, zones``: the zone maps of up to PAGE blocks a row."""

    def run(batches):
        from pyspark import TaskContext
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def out(w):
            nonlocal made
            found = held.pop(w)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([block_number(part, made)], pa.int64()), pa.array([w], pa.int32()),
                 pa.array([np.array([r["bid"] for r in found], np.int64).tobytes()], pa.binary()),
                 pa.array([b"".join(r["zone"] for r in found)], pa.binary())], ["page", "w", "bids", "zones"])
        for r in rows(batches):
            held.setdefault(r["w"], []).append(r)
            if len(held[r["w"]]) == PAGE:
                yield out(r["w"])
        for w in list(held):
            yield out(w)

    return blocks.select("bid", "w", "zone").mapInArrow(run, "page long, w int, bids binary, zones binary")


def choose(chunks: DataFrame, zone_pages: DataFrame, needs: Callable[[dict, np.ndarray], np.ndarray]) -> DataFrame:
    """``cid, bid``: the blocks that a chunk must read. ``needs(chunk, zones)``
    gets a page's zones (blocks, 2, dimensions: least, greatest) and says for
    each block whether one of the chunk's queries may find something there.

    Chunks and pages meet in a square of about 2 x the shuffle partitions: each
    side is repeated for the other's part of the square only. Spark knows the
    size of what is repeated as that of the compressed file it comes from, so
    it is kept from broadcasting it through the driver."""
    spark = chunks.sparkSession
    side = math.isqrt(2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1) + 1

    def spread(d: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return d.withColumn(own, F.pmod(F.xxhash64(key), F.lit(side)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
    laned = spread(zone_pages, "page", "_z", "_c").drop("page").withColumnRenamed("w", "_w")
    met = spread(chunks, "cid", "_c", "_z").join(laned.hint("merge"), ["_c", "_z"]).filter("w = _w")

    def run(batches):
        for r in rows(batches):
            bids = np.frombuffer(r["bids"], np.int64)
            chosen = bids[needs(r, np.frombuffer(r["zones"]).reshape(len(bids), 2, -1))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(chosen), r["cid"])), pa.array(chosen)], ["cid", "bid"])

    return met.mapInArrow(run, "cid long, bid long")


def group_bits(blocks: DataFrame) -> int:
    """Blocks whose numbers differ in so many last bits only are searched
    together: as many as leave each shuffle partition a group, and no more than
    ``GROUP`` components a group."""
    n, most = blocks.agg(F.count(F.lit(1)), F.max(F.col("n").cast("long") * F.col("w"))).first()
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(n // parts, GROUP // (most or 1))).bit_length() - 1


def scan(pairs: DataFrame, chunks: DataFrame, blocks: DataFrame, kernel, schema: str, load=lambda b: b) -> DataFrame:
    """``kernel(chunk, load(block))`` over every pair of a chunk and a block
    (their columns); it returns the arrays of one Arrow batch.

    A chunk goes once to each group of blocks that it must read. A task holds
    one group, each block loaded once, and the group's chunks pass by; neither
    side goes through the driver."""
    spark = pairs.sparkSession
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.shiftright(F.col("bid") - 1, group_bits(blocks)).alias("_group")  # numbers begin at 1
    asked = pairs.groupBy("cid", group).agg(F.collect_list("bid").alias("_bids")).join(chunks.hint("merge"), "cid")
    asked = asked.select("_group", "_bids", F.struct(*chunks.columns).alias("_chunk"))
    held = blocks.select(group, F.struct(*[c for c in blocks.columns if c != "zone"]).alias("_block"))
    d = held.unionByName(asked, allowMissingColumns=True).repartition(tasks, "_group").sortWithinPartitions(
        "_group", F.col("_block").isNull())

    def run(batches):
        at, loaded = None, {}
        for r in rows(batches):
            if r["_group"] != at:
                at, loaded = r["_group"], {}
            if r["_block"] is not None:
                loaded[r["_block"]["bid"]] = load(r["_block"])
            else:
                for bid in r["_bids"]:
                    yield from kernel(r["_chunk"], loaded[bid])

    return d.mapInArrow(run, schema)
