"""Sequence packing by non-negative least squares.

Documents are cut into full windows and one remainder. Combinations of up to
three remainder lengths that fill a window are enumerated, the repeat counts
that best use up the length histogram are solved by non-negative least squares
and rounded, and what is left is packed greedily, longest first. The histogram
(lengths in steps of ``STEP``: at most ``WINDOW / STEP + 1`` numbers) is all
that reaches the driver, and the plan is as small; documents find their places
by their exact rank among the documents of their length.

Greedy combinations that would leave much of a window empty are cut instead:
their remainders split into parts of 1024, 512, ... 64 tokens and a rest, which
fill windows exactly.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ranked, table, written
from .tokenise import encoder

WINDOW = 2048
STEP = 8
END = 1
#: greedy combinations that fill less of a window are cut into parts
CUT_BELOW = 0.98
PARTS = (1024, 512, 256, 128, 64)
FULL = WINDOW // STEP + 1  # unit of a full window
#: units of the parts start here: one for each of PARTS, then rests of 1..8 steps
PART0 = 1000


def part_lengths(n: int) -> list[int]:
    """Lengths of the parts of a remainder: for each of PARTS its length or 0,
    then the rest."""
    return [p if n & p else 0 for p in PARTS] + [n % PARTS[-1]]


def _piece_rows(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for b in batches:
        ids_of = enc.encode(b.column("text").to_pylist())
        which, start, length, crc, total, crcs, held = [], [], [], [], [], [], []
        for row, ids in enumerate(ids_of):
            ids = np.append(ids, np.uint32(END)).astype("<u4")
            for a in range(0, len(ids), WINDOW):
                piece = ids[a:a + WINDOW]
                which.append(row)
                start.append(a)
                length.append(len(piece))
                crc.append(zlib.crc32(piece))
                total.append(len(ids))
                held.append(piece.tobytes() if with_ids else None)
                if len(piece) < WINDOW:
                    cuts = np.cumsum([0, *part_lengths(len(piece))])
                    crcs.append([zlib.crc32(piece[x:y]) for x, y in zip(cuts[:-1], cuts[1:])])
                else:
                    crcs.append([])
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(which, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)],
             pa.array(crcs, pa.list_(pa.int64())), pa.array(held, pa.binary())],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part_crcs", "ids"])


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 of least |a x - b|: the active-set method (one more column gets
    positive at a time, while its gradient says so)."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[on] = -np.inf
        j = int(np.argmax(w)) if len(w) else 0
        if not len(w) or w[j] <= 1e-9:
            break
        on[j] = True
        while True:
            s = np.zeros_like(x)
            s[on] = np.linalg.lstsq(a[:, on].T @ a[:, on], a[:, on].T @ b, rcond=None)[0]
            bad = on & (s <= 0)
            if not bad.any():
                break
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300))
            x = np.where(on, x + step * (s - x), 0)
            on &= x > 1e-12
            x[~on] = 0
            if not on.any():
                s = x
                break
        x = s
    return x


def combinations(units: list[int], full: int) -> list[tuple[int, ...]]:
    """Up to three of ``units`` (repeats allowed), longest first, that add up to
    ``full``."""
    have, out = set(units), []
    out += [(full,)] if full in have else []
    out += [(u, full - u) for u in units if full - u in have and u >= full - u]
    out += [(u, v, full - u - v) for u in units for v in units
            if u >= v >= full - u - v > 0 and full - u - v in have]
    return out


def greedy(left: Counter, size: dict[int, int], full: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, then the longest that still fits; each combination is
    repeated while its units last. Uses up ``left``."""
    out = []
    order = sorted((u for u in left if left[u] > 0), key=lambda u: (-size[u], u))
    while any(left[u] > 0 for u in order):
        room, mine = full, Counter()
        for u in order:
            k = min(room // size[u], left[u])
            if k > 0:
                mine[u] += k
                room -= k * size[u]
        times = min(left[u] // k for u, k in mine.items())
        for u, k in mine.items():
            left[u] -= k * times
        out.append((tuple(mine.elements()), times))
        order = [u for u in order if left[u] > 0]
    return out


def solve(histogram: dict[int, int], window: int = WINDOW, step: int = STEP):
    """(combinations to use whole, combinations to cut), each a list of
    (units, repeats), that use up ``histogram`` (unit: count). A remainder of n
    tokens has unit n // step + 1, the steps that hold it for sure."""
    full = window // step
    left = Counter({u: n for u, n in histogram.items() if n})
    plan = [((FULL,), left.pop(FULL))] if left.get(FULL) else []
    units = sorted(left, reverse=True)
    combos = combinations(units, full)
    if combos:
        a = np.zeros((len(units), len(combos)))
        for j, c in enumerate(combos):
            for u in c:
                a[units.index(u), j] += 1
        b = np.array([left[u] for u in units], float)
        x = nnls(a, b / b.max()) * b.max()
        for j in sorted(range(len(combos)), key=lambda j: (-x[j], j)):
            need = Counter(combos[j])
            times = min([int(x[j] + 0.5), *[left[u] // k for u, k in need.items()]])
            if times > 0:
                plan.append((combos[j], times))
                left.subtract({u: k * times for u, k in need.items()})
    rest = greedy(left, {u: u for u in units}, full)
    cut = [(c, n) for c, n in rest if sum(c) < CUT_BELOW * full]
    return plan + [(c, n) for c, n in rest if sum(c) >= CUT_BELOW * full], cut


def part_units(unit: int) -> list[int]:
    """Units of the parts of a remainder of ``unit``: PART0 + place in PARTS, or
    PART0 + 10 + steps of the rest."""
    n = (unit - 1) * STEP
    return [PART0 + i for i, p in enumerate(PARTS) if n & p] + [PART0 + 10 + n % PARTS[-1] // STEP + 1]


def solve_parts(cut: list[tuple[tuple[int, ...], int]]) -> list[tuple[tuple[int, ...], int]]:
    left: Counter = Counter()
    for units, times in cut:
        for u in units:
            for p in part_units(u):
                left[p] += times
    size = {p: PARTS[p - PART0] // STEP if p < PART0 + 10 else p - PART0 - 10 for p in left}
    return greedy(left, size, WINDOW // STEP)


class Places:
    """Which ranks of a unit go where: ``sequence`` and ``slot``, or -1 for a
    rank whose piece is cut."""

    def __init__(self, plan, first: int = 0, cut=()):
        used: Counter = Counter()
        rows = []
        for units, times in plan:
            for slot, u in enumerate(units):
                rows.append((u, used[u], first, slot))
                used[u] += times
            first += times
        for units, times in cut:
            for u in units:
                rows.append((u, used[u], -1, 0))
                used[u] += times
        self.end = first
        rows.sort()
        self.key = np.array([(u << 44) + lo for u, lo, _, _ in rows], np.int64)
        self.lo, self.first, self.slot = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))

    def find(self, unit: np.ndarray, rank: np.ndarray):
        i = np.searchsorted(self.key, (unit << 44) + rank, side="right") - 1
        seq = np.where(self.first[i] < 0, -1, self.first[i] + rank - self.lo[i])
        return seq, self.slot[i]


def _place(df: DataFrame, places: Places) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(places)

    @F.pandas_udf("sequence_id long, slot long")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for unit, rank in parts:
            seq, slot = held.value.find(unit.to_numpy(np.int64), rank.to_numpy(np.int64))
            yield pd.DataFrame({"sequence_id": seq, "slot": slot})

    order = ["doc_id", "start", "ids_crc32"]
    d = ranked(df, ["unit"], order, F.xxhash64(*order), "rank")
    return d.withColumn("_p", run("unit", "rank")).select(
        *df.columns, F.col("_p.sequence_id").alias("sequence_id"), F.col("_p.slot").alias("slot"))


def _explode_parts(d: DataFrame) -> DataFrame:
    """The parts of remainders, with their units; parts without tokens go."""
    n = F.col("length")
    bits = [F.when(n.bitwiseAND(p) != 0, p).otherwise(0) for p in PARTS]
    rest = n % PARTS[-1]
    rows, at = [], F.lit(0)
    for i, (size, unit) in enumerate([*zip(bits, [F.lit(PART0 + i) for i in range(len(PARTS))]),
                                      (rest, F.expr(f"{PART0 + 10} + length % {PARTS[-1]} div {STEP} + 1"))]):
        rows.append(F.struct((F.col("start") + at).alias("start"), size.cast("long").alias("length"),
                             F.get("part_crcs", F.lit(i)).alias("crc"), unit.cast("long").alias("unit"),
                             at.cast("int").alias("at")))
        at = at + size
    return (d.withColumn("_p", F.explode(F.filter(F.array(*rows), lambda r: r["length"] > 0)))
            .select("doc_id", F.col("_p.start").alias("start"), F.col("_p.length").alias("length"),
                    F.col("_p.crc").alias("ids_crc32"), "doc_tokens", F.col("_p.unit").alias("unit"),
                    F.substring("ids", F.col("_p.at") * 4 + 1, (F.col("_p.length") * 4).cast("int")).alias("ids")))


def pack(df: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (and ``ids``, little-endian uint32, if asked for).

    ``df``: doc_id, text; further columns are ignored. A document's ids are
    those of the tokenizer at ``path`` and END, so a null or empty text has one
    id. A piece is a full window, a remainder, or a part of a remainder; every
    id is in one piece and a sequence has at most WINDOW ids. Repeated rows are
    packed each; no rows give no rows.
    """
    docs = df.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.mapInArrow(lambda b: _piece_rows(b, path, with_ids), (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part_crcs array<long>, ids binary"))
    pieces = written(pieces.withColumn("unit", F.expr(f"length div {STEP} + 1")), "pieces")
    # the length of a window is a multiple of STEP, so a full one has a unit of its own
    histogram = {r["unit"]: r["n"] for r in pieces.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, cut = solve(histogram)
    places = Places(plan, 0, cut)
    placed = _place(pieces, places)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "slot"]
    out = placed
    if cut:
        placed = written(placed, "placed")
        out = placed.filter("sequence_id >= 0")
        parts = _explode_parts(placed.filter("sequence_id < 0"))
        out = out.select(columns).unionByName(_place(parts, Places(solve_parts(cut), places.end)).select(columns))
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                      *(["ids"] if with_ids else []))


def sequences(pieces: DataFrame, pad: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the pieces of :func:`pack` (with ids) put
    together. A sequence is padded to WINDOW ids unless its length is a power
    of two; it holds at most WINDOW ids, so nothing large meets in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw in b.column("ids").to_pylist():
                ids = np.frombuffer(b"".join(raw), "<u4")
                n = len(ids)
                out.append((ids if n & (n - 1) == 0 else np.pad(ids, (0, WINDOW - n), constant_values=pad)).tolist())
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("n_tokens"),
                                              pa.array(out, pa.list_(pa.int32()))], ["sequence_id", "n_tokens", "ids"])

    d = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]).alias("ids"))
    return d.mapInArrow(run, "sequence_id long, n_tokens long, ids array<int>")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
