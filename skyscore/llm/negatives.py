"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are sorted along a Hilbert curve over their most varied components
and written as Parquet blocks, each with the least and greatest value of every
dimension. Interval arithmetic over a zone bounds the inner product of an anchor
with anything in the block. A block is read for an anchor only if its upper
bound reaches the anchor's fifth best score of the same label so far (positives),
or if its bounds meet the window that a positive leaves for negatives and reach
that window's tenth best so far. What is known so far comes from the anchor's
own block, whose rows lie near it on the curve.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written
from .shard import hilbert_index
from .vectors import block_number, choose, matrix, pages, runs, scan, whole

#: rows of a block, anchors of a chunk
BLOCK, CHUNK = 512, 256
#: dimensions of the curve and bits of each
CURVE_DIMS, CURVE_BITS = 4, 3
#: stands for a null id: after all others
NO_ID = (1 << 63) - 1
NONE = -(1 << 63)


def _spread(batches):
    """Per dimension: count, sum and sum of squares of this task's rows."""
    held: dict = {}
    for w, t in runs(batches, "x", 4096):
        x = matrix(t.column("x").chunk(0), float)
        n, s, q = held.get(w, (0, 0.0, 0.0))
        held[w] = n + len(x), s + x.sum(axis=0), q + (x * x).sum(axis=0)
    for w, (n, s, q) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(w, dtype=np.int32)), pa.array(np.full(w, n)),
                                          pa.array(s), pa.array(q)], ["i", "n", "s", "q"])


def _block_rows(batches):
    """Blocks of sorted rows; a row that repeats the one before it goes."""
    from pyspark import TaskContext
    part, made, last = TaskContext.get().partitionId(), 0, None
    for w, t in runs(batches, "x", BLOCK):
        ids, labels = (t.column(c).chunk(0).to_numpy() for c in ("vec_id", "label"))
        x = matrix(t.column("x").chunk(0), np.int64)
        rows = np.column_stack((ids, labels, x))
        same = np.concatenate(([last is not None and np.array_equal(last, rows[0])], (rows[1:] == rows[:-1]).all(axis=1)))
        last = rows[-1]
        ids, labels, x = ids[~same], labels[~same], x[~same]
        if not len(ids):
            continue
        made += 1
        zone = np.concatenate((x.min(axis=0), x.max(axis=0))).astype(float)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block_number(part, made)], pa.int64()), pa.array([w], pa.int32()), pa.array([len(ids)], pa.int32()),
             *[pa.array([a.tobytes()], pa.binary()) for a in (ids, labels, x, zone)]],
            ["bid", "w", "n", "ids", "labels", "xs", "zone"])


def _prepared(df: DataFrame) -> DataFrame:
    """``vec_id, label, x`` of the rows that take part."""
    x = F.transform("_v", lambda c: F.floor(256 * c.cast("double")))
    d = df.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
                  F.col("label").cast("long").alias("label"), F.col("embedding").alias("_v"))
    d = d.filter(F.col("label").isNotNull() & whole("_v") & (F.size("_v") > 0))
    # nine times a product of two such vectors fits a long
    d = d.filter(~F.exists("_v", lambda c: F.abs(256 * c.cast("double")) + 1 > F.sqrt(F.lit(2.0 ** 59) / F.size("_v"))))
    return d.select("vec_id", "label", F.transform(x, lambda c: c.cast("long")).alias("x"))


def _steps(d: DataFrame, columns: list[str]) -> list[Column]:
    """Equal steps of the values between the outer quantiles of each column: a
    bound on an inner product follows the width of a zone, not its count."""
    cuts = d.agg(*[F.percentile_approx(c, [0.005, 0.995], 1000).alias(c) for c in columns]).first()
    top, out = (1 << CURVE_BITS) - 1, []
    for c in columns:
        low, high = cuts[c] or (0, 0)
        step = F.floor((F.col(c) - low) * ((top + 1) / max(high - low, 1)))
        out.append(F.least(F.greatest(step, F.lit(0)), F.lit(top)))
    return out


def build(rows: DataFrame) -> DataFrame:
    """Written blocks of ``vec_id, label, x``, in the order of the curve."""
    rows = rows.withColumn("_w", F.size("x"))
    spread = (rows.select("x").mapInArrow(_spread, "i int, n long, s double, q double").groupBy("i")
              .agg((F.sum("q") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), 2)).alias("v")))
    dims = [r["i"] for r in spread.orderBy(F.desc("v"), "i").limit(CURVE_DIMS).collect()]
    dims = (dims * CURVE_DIMS)[:CURVE_DIMS] or [0] * CURVE_DIMS
    named = [f"_d{k}" for k in range(CURVE_DIMS)]
    d = rows.withColumns({n: F.coalesce(F.get("x", F.lit(i)), F.lit(0)) for n, i in zip(named, dims)})
    d = d.withColumn("_curve", hilbert_index(_steps(d, named), CURVE_BITS)).drop(*named)
    order = ["_w", "_curve", "vec_id", F.xxhash64("x"), "x", "label"]
    d = d.repartitionByRange("_w", "_curve", "vec_id", F.xxhash64("x")).sortWithinPartitions(*order)
    return written(d.select("vec_id", "label", "x").mapInArrow(
        _block_rows, "bid long, w int, n int, ids binary, labels binary, xs binary, zone binary"), "negative-blocks")


# --- kernels ---------------------------------------------------------------------


def _unpacked(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
    return ids, labels, np.frombuffer(r["xs"], np.int64).reshape(len(ids), -1)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    return a @ x.T


def leading(scores: np.ndarray, ok: np.ndarray, k: int, least: np.ndarray):
    """Row and column of the ``k`` greatest scores of each row (and of those
    equal to the last of them) where ``ok``, from ``least`` of the row on."""
    s = np.where(ok & (scores >= least[:, None]), scores, NONE)
    if s.shape[1] > k:
        bar = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
        s = np.where(s >= bar[:, None], s, NONE)
    return np.nonzero(s > NONE)


def _kth(scores: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest score of each row where ``ok``; NONE if there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NONE)
    s = np.where(ok, scores, NONE)
    return np.partition(s, s.shape[1] - k, axis=1)[:, -k]


def bounds(a: np.ndarray, zones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: least and greatest inner product of each anchor
    with a vector in each zone, widened by the rounding of doubles."""
    up, down = np.maximum(a, 0).astype(float), np.minimum(a, 0).astype(float)
    low, high = zones[:, 0], zones[:, 1]
    slack = 1e-12 * (np.abs(a).astype(float) @ np.abs(zones).max(axis=1).T) + 1
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def _anchors(positives: int, every: int):
    """Chunks of the anchors of consecutive blocks, each with its own block
    (``home``) and its ``positives``-th best score there (``least``)."""
    def run(batches):
        from .vectors import rows
        held, count, width = [], 0, None

        def out():
            key, ids, labels, xs, least = (np.concatenate(c) for c in zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(key[0])], pa.int64()), pa.array([width], pa.int32()), pa.array([len(ids)], pa.int32()),
                 *[pa.array([a.tobytes()], pa.binary()) for a in (ids, labels, xs, key, least)]],
                ["cid", "w", "n", "ids", "labels", "xs", "keys", "least"])
        for r in rows(batches):
            ids, labels, x = _unpacked(r)
            mine = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
            if not len(mine):
                continue
            if held and (count + len(mine) > CHUNK or r["w"] != width):
                yield out()
                held, count = [], 0
            s = products(x[mine], x)
            ok = (labels[None, :] == labels[mine][:, None]) & (ids[None, :] != ids[mine][:, None])
            # BLOCK is under 2**10, so a key names block and place
            held.append(((r["bid"] << 10) + mine, ids[mine], labels[mine], x[mine], _kth(s, ok, positives)))
            count, width = count + len(mine), r["w"]
        if held:
            yield out()
    return run


def _positive_rows(k: int):
    def kernel(r, block):
        ids, labels, a = _unpacked(r)
        bids, blabels, x = block
        s = products(a, x)
        ok = (blabels[None, :] == labels[:, None]) & (bids[None, :] != ids[:, None])
        i, j = leading(s, ok, k, np.frombuffer(r["least"], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), r["cid"])), pa.array(np.frombuffer(r["keys"], np.int64)[i]),
                                          pa.array(ids[i]), pa.array(bids[j]), pa.array(s[i, j])],
                                         ["cid", "key", "anchor_id", "positive_id", "positive_score"])
    return kernel


def _windows(r: dict):
    """Per wanted list of the chunk: the anchor's place, its rank, the
    positive's id and score, and the least score worth reporting."""
    place = {k: i for i, k in enumerate(np.frombuffer(r["keys"], np.int64).tolist())}
    w = r["wanted"]
    return (np.array([place[x["key"]] for x in w], np.int64), np.array([x["positive_id"] for x in w], np.int64),
            np.array([x["positive_score"] for x in w], np.int64), np.array([x["least"] for x in w], np.int64))


def _inside(score, positive):
    """30 p <= 100 s <= 90 p in whole numbers that cannot overflow."""
    low = -((-3 * positive) // 10)  # ceiling of 3 p / 10
    return (score >= low) & (score <= 9 * positive // 10)


def _negative_rows(k: int):
    def kernel(r, block):
        ids, labels, a = _unpacked(r)
        bids, blabels, x = block
        at, pid, p, least = _windows(r)
        scores = products(a, x)
        keys = np.frombuffer(r["keys"], np.int64)
        for lo in range(0, len(at), CHUNK):
            c = slice(lo, lo + CHUNK)
            s = scores[at[c]]
            ok = _inside(s, p[c][:, None]) & (blabels[None, :] != labels[at[c]][:, None])
            i, j = leading(s, ok, k, least[c])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), r["cid"])), pa.array(keys[at[c][i]]), pa.array(ids[at[c][i]]), pa.array(pid[c][i]),
                 pa.array(p[c][i]), pa.array(bids[j]), pa.array(s[i, j])],
                ["cid", "key", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return kernel


def _may_hold_positive(r, zones):
    _, _, a = _unpacked(r)
    high = bounds(a, zones)[1]
    return (high >= np.frombuffer(r["least"], np.int64).astype(float)[:, None]).any(axis=0)


def _may_hold_negative(r, zones):
    at, _, p, least = _windows(r)
    if not len(at):
        return np.zeros(len(zones), bool)
    low, high = (b[at] for b in bounds(_unpacked(r)[2], zones))
    p, least = p.astype(float)[:, None], least.astype(float)[:, None]
    return ((high >= np.maximum(0.3 * p, least)) & (low <= 0.9 * p)).any(axis=0)


def mine(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for ``df`` (vec_id, label, embedding; further columns are
    ignored).

    Vectors become whole numbers (``floor(256 * c)``), a score is an inner
    product. Anchors: rows with a vec_id divisible by ``every``. An anchor's
    positives are its first ``positives`` other rows of the same label, greater
    scores first, ties by smaller vec_id; for each of them the first
    ``negatives`` rows of other labels with
    ``30 * positive_score <= 100 * negative_score <= 90 * positive_score``.
    Fewer are returned where there are fewer.

    Rows with a null label, a null or empty vector, or a null or non-finite
    component take no part, nor do rows whose components are so great that a
    score might not fit a long. Vectors meet vectors of their own length only.
    A null vec_id is no anchor, comes after all others and stays null. Repeated
    rows count once; rows that share a vec_id only are rows of their own, and
    not "other rows" to an anchor of that id. No rows give no rows.
    """
    blocks = build(_prepared(df))
    binary = "ids binary, labels binary, xs binary"
    chunks = written(blocks.select("bid", "w", "n", "ids", "labels", "xs").mapInArrow(
        _anchors(positives, every), f"cid long, w int, n int, {binary}, keys binary, least binary"), "anchors")
    zones = written(pages(blocks), "zones")
    found = scan(choose(chunks, zones, _may_hold_positive), chunks, blocks, _positive_rows(positives),
                 "cid long, key long, anchor_id long, positive_id long, positive_score long", _unpacked)
    first = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id")
    pos = written(found.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= positives), "positives")

    def with_windows(wanted: DataFrame) -> DataFrame:
        # at most CHUNK * positives lists a chunk
        w = wanted.groupBy(F.col("cid").alias("_c")).agg(
            F.collect_list(F.struct("key", "positive_id", "positive_score", "least")).alias("wanted"))
        return chunks.drop("least").join(w, F.col("cid") == F.col("_c")).drop("_c")

    schema = ("cid long, key long, anchor_id long, positive_id long, positive_score long, negative_id long, "
              "negative_score long")
    best = Window.partitionBy("key", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")

    def ranked(d: DataFrame) -> DataFrame:
        return d.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)

    wanted = pos.select("cid", "key", "positive_id", "positive_score", F.lit(NONE).alias("least")).distinct()
    at_home = wanted.select("cid", F.shiftright("key", 10).alias("bid")).distinct()
    home = ranked(scan(at_home, with_windows(wanted), blocks, _negative_rows(negatives), schema, _unpacked))
    # other anchors' blocks are read on the way: a list's least counts its own block or more
    tenth = home.filter(F.col("rank") == negatives).select(
        F.col("key").alias("_k"), F.col("positive_id").alias("_p"), F.col("positive_score").alias("_s"),
        F.col("negative_score").alias("_least"))
    wanted = wanted.drop("least").join(tenth, (F.col("key") == F.col("_k")) & (F.col("positive_id") == F.col("_p")) & (
        F.col("positive_score") == F.col("_s")), "left").select(
        "cid", "key", "positive_id", "positive_score", F.coalesce("_least", F.lit(NONE)).alias("least"))
    asked = written(with_windows(wanted), "windows")
    out = ranked(scan(choose(asked, zones, _may_hold_negative), asked, blocks, _negative_rows(negatives), schema, _unpacked))

    def named(c):
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return out.select("anchor_id", named("positive_id"), F.col("rank").cast("int").alias("rank"), named("negative_id"),
                      "positive_score", "negative_score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose vec_id is divisible by 7 move on by one, modulo 10."""
    d = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(d.withColumn("label", moved))


SQL12 = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same,
    CAST(list_inner_product(a.x, c.x) AS BIGINT) AS s
    FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.x) = len(c.x)),
p AS (SELECT a, c, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.s DESC, n.c) AS INTEGER) AS rank,
    n.c AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
QUALIFY row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.s DESC, n.c) <= 10
"""
