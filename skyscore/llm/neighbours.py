"""Approximate nearest neighbours by collision counting.

Vectors of length one are projected on ``PROJECTIONS`` random directions; a
block keeps, for each direction alone, its values in order (a sorted array). A
query opens a window of half width ``REACH * R`` around its own value in every
array. A vector at distance R or less falls into a window with probability
``erf(REACH / sqrt 2)`` or more, so it collides in ``THRESHOLD`` windows or more
with probability 1 - MISS; vectors that do are verified on the original
vectors. R starts small and grows (virtual rehashing: the same arrays, wider
windows, only the newly covered ends are counted) until the fifth best
distance verified is R or less. A query first searches its own block; what it
finds there bounds R in all others, and a block whose value ranges meet too few
of the query's windows is not read. The result is exact but for missed
neighbours (tests measure the recall); scores are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .vectors import block_number, choose, matrix, pages, rows, runs, scan, whole

PROJECTIONS = 64
#: half width of a window over the distance that it is for
REACH = 1.0
#: chance of one true neighbour to collide too seldom, at most
MISS = 0.005
#: R grows by this
GROWTH = 1.2
#: rows of a block, queries of a chunk
BLOCK, CHUNK = 4096, 128
SEED = 11


def threshold(projections: int = PROJECTIONS, reach: float = REACH, miss: float = MISS) -> int:
    """Greatest number of collisions that a vector within R reaches with
    probability 1 - ``miss``: a quantile of the binomial distribution."""
    p, below = math.erf(reach / math.sqrt(2)), 0.0
    for k in range(projections + 1):
        below += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if below > miss:
            return k
    return projections


THRESHOLD = threshold()


def directions(w: int) -> np.ndarray:
    """Random directions for vectors of w components, the same in every task."""
    return np.random.default_rng([SEED, w]).standard_normal((w, PROJECTIONS))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows brought to length one; scaled by a power of two first, so that no
    square overflows or vanishes."""
    e = np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1]
    x = np.ldexp(x, -e)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of a vector and each row, in double precision; a row's result
    does not depend on its place."""
    q = np.ldexp(q, -np.frexp(np.abs(q).max())[1])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def packed(x: np.ndarray) -> bytes:
    """A matrix in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return (single if np.array_equal(single, x) else np.ascontiguousarray(x)).tobytes()


def unpacked(r: dict) -> np.ndarray:
    """The vectors of a block or a chunk in double precision."""
    kind = np.float32 if len(r["xs"]) == 4 * r["n"] * r["w"] else np.float64
    return np.frombuffer(r["xs"], kind).reshape(r["n"], -1).astype(float)


def _cells(batches):
    """Rows with the signs of their first projections, so that near rows share
    a block more often."""
    for w, t in runs(batches, "x", BLOCK):
        p = unit(matrix(t.column("x").chunk(0), float)) @ directions(w)[:, :8]
        cell = (p > 0) @ (1 << np.arange(8))
        yield pa.RecordBatch.from_arrays([t.column("vec_id").chunk(0), t.column("x").chunk(0), pa.array(cell)],
                                         ["vec_id", "x", "cell"])


def _block_rows(batches):
    from pyspark import TaskContext
    part, made, last = TaskContext.get().partitionId(), 0, None
    for w, t in runs(batches, "x", BLOCK):
        ids, x = t.column("vec_id").chunk(0).to_numpy(), matrix(t.column("x").chunk(0), float)
        same = np.concatenate(([last is not None and last[0] == ids[0] and np.array_equal(last[1], x[0])],
                               (ids[1:] == ids[:-1]) & (x[1:] == x[:-1]).all(axis=1)))
        last = ids[-1], x[-1]
        ids, x = ids[~same], x[~same]
        if not len(ids):
            continue
        made += 1
        p = (unit(x) @ directions(w)).T
        order = np.argsort(p, axis=1, kind="stable").astype(np.uint16)
        p = np.take_along_axis(p, order.astype(np.int64), axis=1)
        zone = np.concatenate((p[:, 0], p[:, -1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([block_number(part, made)], pa.int64()), pa.array([w], pa.int32()), pa.array([len(ids)], pa.int32()),
             *[pa.array([a], pa.binary()) for a in (ids.tobytes(), packed(x), order.tobytes(), zone.tobytes())]],
            ["bid", "w", "n", "ids", "xs", "orders", "zone"])


class Arrays:
    """The sorted arrays of one block; their values are projected again, by
    the same product that gave their order."""

    def __init__(self, r: dict):
        self.n = r["n"]
        self.ids = np.frombuffer(r["ids"], np.int64)
        self.x = unpacked(r)
        self.units = unit(self.x)
        self.orders = np.frombuffer(r["orders"], np.uint16).reshape(-1, self.n)
        p = (self.units @ directions(r["w"])).T
        self.values = np.take_along_axis(p, self.orders.astype(np.int64), axis=1)

    def search(self, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int):
        """For each query (its id and vector, and a distance that k others are
        known to keep): places of the rows verified that may be among its k
        nearest. Rows with a query's id are its own."""
        units = unit(q)
        at = units @ directions(q.shape[1])
        radius = np.where(np.isfinite(bound), bound / GROWTH ** 2, 0.4)
        m, nq = len(self.values), len(q)
        low = np.stack([np.searchsorted(self.values[j], at[:, j]) for j in range(m)])
        high = low.copy()
        hits = np.zeros((nq, self.n), np.uint8)
        known = [np.zeros(0, np.int64)] * nq
        far = [np.zeros(0)] * nq
        kth = bound.copy()
        todo = np.arange(nq)
        while len(todo):
            # at R = 2 no vector is farther: the windows are the whole arrays
            reach = np.where(radius[todo] >= 2, np.inf, REACH * radius[todo] * (1 + 1e-12))
            lo = np.stack([np.searchsorted(self.values[j], at[todo, j] - reach) for j in range(m)])
            hi = np.stack([np.searchsorted(self.values[j], at[todo, j] + reach, "right") for j in range(m)])
            # a row collides once in a window: with too few that hold any row none collides enough
            full = (hi > lo).sum(axis=0) >= THRESHOLD
            open_ = []
            for c, i in enumerate(todo.tolist()):
                if full[c]:
                    ends = zip(*(a.tolist() for a in (lo[:, c], low[:, i], high[:, i], hi[:, c])))
                    new = [self.orders[j, a:b] for j, (p, q, r, s) in enumerate(ends) for a, b in ((p, q), (r, s)) if b > a]
                    low[:, i], high[:, i] = lo[:, c], hi[:, c]
                    if new:
                        before = hits[i] >= THRESHOLD
                        hits[i] += np.bincount(np.concatenate(new), minlength=self.n).astype(np.uint8)
                        fresh = np.flatnonzero((hits[i] >= THRESHOLD) & ~before & (self.ids != ids[i]))
                        gap = self.units[fresh] - units[i]
                        d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                        near = d <= kth[i] * (1 + 1e-9) + 1e-9
                        known[i], far[i] = np.append(known[i], fresh[near]), np.append(far[i], d[near])
                        if len(far[i]) >= k:
                            kth[i] = min(kth[i], np.partition(far[i], k - 1)[k - 1])
                if radius[i] < 2 and kth[i] > radius[i]:
                    radius[i] = radius[i] * GROWTH if kth[i] > radius[i] * GROWTH else kth[i]
                    open_.append(c)
            todo = todo[open_]
        return [a[d <= t * (1 + 1e-9) + 1e-9] for a, d, t in zip(known, far, kth)], kth


def _queries(every: int, k: int):
    """Chunks of the queries of consecutive blocks with the distance of the
    k-th nearest in their own block (infinite where it has fewer)."""
    def run(batches):
        held, count, width = [], 0, None

        def out():
            key, ids, xs, kth = (np.concatenate(c) for c in zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(key[0])], pa.int64()), pa.array([width], pa.int32()), pa.array([len(ids)], pa.int32()),
                 *[pa.array([a], pa.binary()) for a in (ids.tobytes(), packed(xs), key.tobytes(), kth.tobytes())]],
                ["cid", "w", "n", "ids", "xs", "keys", "kth"])
        for r in rows(batches):
            b = Arrays(r)
            mine = np.flatnonzero(b.ids % every == 0)
            for s in range(0, len(mine), CHUNK):
                i = mine[s:s + CHUNK]
                if held and (count + len(i) > CHUNK or r["w"] != width):
                    yield out()
                    held, count = [], 0
                kth = b.search(b.ids[i], b.x[i], np.full(len(i), np.inf), k)[1]
                # BLOCK is 2**12: a key names block and place
                held.append(((r["bid"] << 12) + i, b.ids[i], b.x[i], kth))
                count, width = count + len(i), r["w"]
        if held:
            yield out()
    return run


def _may_collide(r, zones):
    """Blocks whose value ranges meet THRESHOLD windows of a query or more."""
    q, kth = unpacked(r), np.frombuffer(r["kth"])
    at, reach = unit(q) @ directions(r["w"]), np.where(kth >= 2, np.inf, REACH * kth * (1 + 1e-12))[:, None]
    low, high = zones[:, 0], zones[:, 1]
    out = np.zeros(len(zones), bool)
    for a, t in zip(at, reach):
        out |= ((low <= a + t) & (high >= a - t)).sum(axis=1) >= THRESHOLD
        if out.all():
            break
    return out


def _found(k: int):
    def kernel(r, b: Arrays):
        ids, keys, q = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["keys"], np.int64), unpacked(r)
        places, _ = b.search(ids, q, np.frombuffer(r["kth"]), k)
        scores = [cosines(v, b.x[p]) for v, p in zip(q, places)]
        n = [len(p) for p in places]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(keys, n)), pa.array(np.repeat(ids, n)), pa.array(b.ids[np.concatenate(places)]),
             pa.array(np.concatenate(scores))], ["key", "query_id", "vec_id", "score"])
    return kernel


def nearest(df: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``df`` (vec_id,
    embedding; further columns are ignored) with a vec_id divisible by
    ``every`` the ``k`` rows of greatest cosine found, nearest first, ties by
    smaller vec_id.

    Vectors that are null, empty or zero, or hold null or non-finite
    components, and rows without a vec_id take no part. Vectors meet vectors of
    their own length only. Repeated rows count once; other rows with the
    query's vec_id are not candidates to it. Fewer rows than ``k``: all of
    them. No rows give no rows. Every row is in the index; nothing is fitted.
    """
    d = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("x"))
    d = d.filter(F.col("vec_id").isNotNull() & whole("x"))
    d = d.withColumn("x", F.transform("x", lambda c: c.cast("double"))).filter(F.exists("x", lambda c: c != 0))
    d = d.mapInArrow(_cells, "vec_id long, x array<double>, cell long").withColumn("_w", F.size("x"))
    d = d.repartitionByRange("_w", "cell", "vec_id", F.xxhash64("x")).sortWithinPartitions("_w", "cell", "vec_id", F.xxhash64("x"), "x")
    blocks = written(d.select("vec_id", "x").mapInArrow(
        _block_rows, "bid long, w int, n int, ids binary, xs binary, orders binary, zone binary"), "sorted-arrays")
    chunks = written(blocks.select("bid", "w", "n", "ids", "xs", "orders").mapInArrow(
        _queries(every, k), "cid long, w int, n int, ids binary, xs binary, keys binary, kth binary"), "queries")
    pairs = choose(chunks, pages(blocks), _may_collide)
    found = scan(pairs, chunks, blocks, _found(k), "key long, query_id long, vec_id long, score double", Arrays)
    first = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
