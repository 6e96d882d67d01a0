"""Helpers shared by the corpus operators: tables written to the shared
folder, exact distributed ranks, and word hashing in numpy."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyscore.session import ensure_checkpoint_dir, table_path

#: ASCII white space, as Java / RE2 / Spark regular expressions read it
SPACE = r"[\x20\x09-\x0D]"


#: bytes of a batch that goes to a Python worker
BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Keeps what goes to a Python worker at once to ``BATCH_BYTES`` where the
    session does not say otherwise: a batch of texts or vectors is there several
    times over (in the JVM, in Arrow, as Python objects). Rows larger than that
    go alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder (``spark.checkpoint.dir``)
    and read back: computed once, and not lost with an executor."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def salts_for(rows: int) -> int:
    """Salts for :func:`ranked` over ``rows`` rows: one more for every 500,000,
    so that a group that holds a third of them is some 170,000 rows a task at
    any size."""
    return max(256, rows // 500_000)


def ranked(df: DataFrame, group: list[str], order: list[str], salt: Column, out: str,
           salts: int = 256) -> DataFrame:
    """Exact 0-based rank (column ``out``, BIGINT) of each row within ``group``
    by (salt bucket, ``order``), without putting a group into one task.

    ``salt`` is an integer expression; its value modulo ``salts`` splits a
    group. Rows are numbered inside (group, salt) and shifted by the prefix
    sum of the group's salt counts (``salts`` rows a group). ``group`` columns
    and ``salt`` must not be null.
    """
    d = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    keys = [*group, "_salt"]
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_base"))
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    return (d.join(base, on).withColumn(out, F.col("_base") + F.col("_rn") - 1)
            .drop("_salt", "_rn", "_base", *[f"_k{i}" for i in range(len(keys))]))


# --- word hashing -----------------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_POW: list = [None, None]
CHUNK = 1 << 20


def _powers(n: int):
    """P**i and P**-i for i < n (kept for the life of the worker)."""
    if _POW[0] is None or len(_POW[0]) < n:
        n = max(n, 2 * CHUNK)
        up, down = np.full(n, _P), np.full(n, np.uint64(pow(int(_P), -1, 1 << 64)))
        up[0] = down[0] = 1
        _POW[0], _POW[1] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POW


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    y = x >> np.uint64(30)  # a new array, changed in place
    y ^= x
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


def word_bounds(data: np.ndarray, is_word: np.ndarray):
    """Start and end offsets of the runs of bytes that ``is_word`` (256 flags)
    accepts."""
    inside = is_word[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edge = np.concatenate(([0] if len(inside) and inside[0] else [], edge,
                           [len(inside)] if len(inside) and inside[-1] else [])).astype(np.int64)
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each byte span, mixed with its length."""
    up, down = _powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, np.uint64)
    x = data.astype(np.uint64)
    x += np.uint64(1)
    x *= up[:len(data)]
    np.cumsum(x, out=acc[1:])
    h = (acc[ends] - acc[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _Q)


def word_hashes(data: bytes, is_word: np.ndarray) -> np.ndarray:
    """Hashes of the words of one whole text, in order, read in pieces of about
    ``CHUNK`` bytes that end between words."""
    if len(data) <= CHUNK:
        a = np.frombuffer(data, np.uint8)
        return span_hashes(a, *word_bounds(a, is_word))
    a, out, i = np.frombuffer(data, np.uint8), [], 0
    while i < len(a):
        j = min(i + CHUNK, len(a))
        while j < len(a):  # up to the next byte between words
            gap = np.flatnonzero(~is_word[a[j:j + CHUNK]])
            if len(gap):
                j += int(gap[0])
                break
            j = min(j + CHUNK, len(a))
        out.append(span_hashes(a[i:j], *word_bounds(a[i:j], is_word)))
        i = j
    return np.concatenate(out)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word windows; fewer words: the whole sequence as
    one; no words: none."""
    if len(words) == 0:
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h *= _P
        h += words[i:i + n]
    return mix(h)


BLANKS = np.ones(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = False
