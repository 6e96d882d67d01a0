"""Embedding whitening by QDWH spectral divide and conquer.

Sums and products of the distinct integer vectors are added up exactly on the
executors; the covariance (components x components, whatever the number of
rows) comes to the driver, where the dynamically weighted Halley iteration
(QDWH) gives the polar factor of the shifted covariance. That factor is the
matrix sign, so half of it and the identity is the projector onto the
eigenvectors above the shift. Bases of both sides split the problem in two, and
each part is split again until single components are left. The leading
components go to the tasks (components x kept components numbers) and every row
is projected there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .vectors import matrix, runs, whole

KEPT = 4
#: rows whose products are added up at once
BATCH = 4096

# --- spectral divide and conquer ---------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a symmetric matrix by QDWH: Halley steps whose
    weights follow the lower bound of the singular values, each by a QR
    decomposition; cubic in the end, six steps or so from any start."""
    n = len(a)
    size = np.linalg.norm(a, 1)  # no less than the spectral norm
    if size == 0:
        return np.eye(n)
    x = a / size
    try:
        low = 1 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(x), 1))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, np.finfo(float).eps))
    for _ in range(60):
        s = low * low
        d = np.cbrt(4 * (1 - s) / (s * s))
        p = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - s) / (s * np.sqrt(1 + d))))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        z = np.linalg.qr(np.vstack((np.sqrt(r) * x, np.eye(n))))[0]
        new = (q / r) * x + (p - q / r) / np.sqrt(r) * (z[:n] @ z[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (p + q * s) / (1 + r * s))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 1e-15 and moved < 1e-12 * np.sqrt(n):
            break
    return x


def _sides(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of the rest: its columns
    picked greatest remainder first, then orthogonalised twice."""
    n, left, chosen = len(projector), projector.copy(), []
    for _ in range(rank):
        k = int(np.argmax(np.einsum("ij,ij->j", left, left)))
        v = left[:, k] / np.linalg.norm(left[:, k])
        chosen.append(k)
        left = left - np.outer(v, v @ left)
    q = np.linalg.qr(projector[:, chosen], mode="complete")[0]
    # one step of subspace iteration takes the rounding of the picked columns out
    top = np.linalg.qr(projector @ q[:, :rank])[0]
    rest = q[:, rank:] - top @ (top.T @ q[:, rank:])
    return top, np.linalg.qr(rest)[0] if n > rank else rest


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric
    matrix. Equal eigenvalues leave the choice of a basis of their space."""
    n = len(a)
    scale = np.abs(a).max(initial=0.0)

    def split(basis: np.ndarray) -> list[tuple[float, np.ndarray]]:
        h = basis.T @ a @ basis
        h = (h + h.T) / 2
        k = len(h)
        mean = np.trace(h) / k
        if k == 1 or np.linalg.norm(h - mean * np.eye(k)) <= 4 * np.finfo(float).eps * k * scale:
            return [(float(h[i, i]), basis[:, i]) for i in range(k)]
        # a shift with eigenvalues on both sides: the median of the diagonal cuts
        # about half way; from there the bounds of the spectrum close in
        radius = np.abs(h).sum(axis=1) - np.abs(np.diag(h))
        low, high = float((np.diag(h) - radius).min()), float((np.diag(h) + radius).max())
        low, high = low - 0.01 * (high - low), high + 0.01 * (high - low)
        shift = float(np.median(np.diag(h)))
        for _ in range(100):
            u = polar(h - shift * np.eye(k))
            rank = int(np.rint((np.trace(u) + k) / 2))
            if np.linalg.norm(u @ u - np.eye(k)) > 1e-8:  # the shift meets an eigenvalue
                shift += 0.1 * (high - shift)
            elif rank == 0:
                high, shift = shift, (low + shift) / 2
            elif rank == k:
                low, shift = shift, (shift + high) / 2
            else:
                break
        else:
            raise ArithmeticError("no shift divides the spectrum")
        top, rest = _sides((u + np.eye(k)) / 2, rank)
        return split(basis @ top) + split(basis @ rest)

    if not n:
        return np.zeros(0), np.zeros((0, 0))
    found = split(np.eye(n))
    v = np.column_stack([x for _, x in found])
    v = np.linalg.qr(v)[0]
    # quotients with the vectors as they are, then one step of first order in the remaining coupling
    h = v.T @ a @ v
    e = np.diag(h).copy()
    gap = e[None, :] - e[:, None]
    couple = np.where(np.abs(gap) > 1e-6 * scale, h / np.where(gap == 0, 1, gap), 0)
    v = np.linalg.qr(v + v @ couple)[0]
    e = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


# --- exact sums ----------------------------------------------------------------


def _integers(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_x", F.transform(vector, lambda c: F.floor(256 * c.cast("double")).cast("long")))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``w, i, j, total``: over this task's vectors of w components, the count
    (-1, -1), the sums (i, -1) and the products (i, j), i <= j, as text."""
    held: dict = {}
    for w, t in runs(batches, "_x", BATCH):
        x = matrix(t.column("_x").chunk(0), np.int64)
        most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if most * most * len(x) < 1 << 53:  # whole numbers that a double holds
            f = x.astype(float)
            g = (f.T @ f).astype(np.int64).astype(object)
        elif most * most * len(x) < 1 << 62:
            g = (x.T @ x).astype(object)
        else:
            g = x.T.astype(object) @ x.astype(object)
        s = x.astype(object).sum(axis=0) if most * len(x) >= 1 << 62 else x.sum(axis=0).astype(object)
        n0, s0, g0 = held.get(w, (0, 0, 0))
        held[w] = n0 + len(x), s0 + s, g0 + g
    for w, (n, s, g) in held.items():
        i, j = np.triu_indices(w)
        at = np.arange(w)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(1 + w + len(i), w, np.int32)),
            pa.array(np.concatenate(([-1], at, i)).astype(np.int32)),
            pa.array(np.concatenate(([-1], np.full(w, -1), j)).astype(np.int32)),
            pa.array([str(v) for v in (n, *s, *g[i, j])])], ["w", "i", "j", "total"])


class Fit:
    """Count, sums, components, eigenvalues and shares of one vector length."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, kept: int):
        self.n, self.sums = n, sums
        e, v = components(covariance)
        trace = float(np.trace(covariance))
        # an eigenvalue that rounding alone can make is none
        live = e > 1e-12 * max(trace, 0.0)
        self.kept = min(kept, len(e))
        self.values, self.vectors = np.where(live, e, 0.0)[:self.kept], v[:, :self.kept]
        self.explained = self.values / trace if trace > 0 else np.zeros(self.kept)
        self.error = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors; NaN for components without
        variance."""
        mean = np.array([s / self.n for s in self.sums])
        scale = np.where(self.values > 0, np.sqrt(np.where(self.values > 0, self.values, 1)), np.nan)
        return (x - mean) @ self.vectors / scale


def fit(distinct: DataFrame, kept: int = KEPT) -> dict[int, Fit]:
    """The fit of each vector length in ``distinct`` (column ``_x``). The driver
    gets components * (components + 3) / 2 + 1 sums a length, added up by key
    on the executors; the products are centred in whole numbers."""
    totals = (distinct.mapInArrow(_sums, "w int, i int, j int, total string")
              .groupBy("w", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    held: dict = {}
    for r in totals:
        held.setdefault(r["w"], {})[r["i"], r["j"]] = int(r["total"])
    out = {}
    for w, t in held.items():
        n, s = t[-1, -1], [t[i, -1] for i in range(w)]
        v = np.zeros((w, w))
        for i in range(w):
            for j in range(i, w):
                v[i, j] = v[j, i] = (n * t[i, j] - s[i] * s[j]) / (n * n)
        out[w] = Fit(n, s, v, kept)
    return out


def _identity_errors(distinct: DataFrame, fits: dict[int, Fit]) -> None:
    """Sets each fit's ``error``: covariance of the whitened fit list against
    the identity. Sums of whitened values and products, by key."""
    def run(batches):
        held: dict = {}
        for w, t in runs(batches, "_x", BATCH):
            y = np.nan_to_num(fits[w].project(matrix(t.column("_x").chunk(0), np.int64).astype(float)))
            s0, g0 = held.get(w, (0.0, 0.0))
            held[w] = s0 + y.sum(axis=0), g0 + y.T @ y
        for w, (s, g) in held.items():
            i, j = np.triu_indices(len(s))
            at = np.arange(len(s))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(s) + len(i), w, np.int32)), pa.array(np.concatenate((at, i)).astype(np.int32)),
                pa.array(np.concatenate((np.full(len(s), -1), j)).astype(np.int32)),
                pa.array(np.concatenate((s, g[i, j])))], ["w", "i", "j", "total"])
    rows = (distinct.mapInArrow(run, "w int, i int, j int, total double")
            .groupBy("w", "i", "j").agg(F.sum("total").alias("total")).collect())
    at = {(r["w"], r["i"], r["j"]): r["total"] for r in rows}
    for w, f in fits.items():
        live = [k for k in range(f.kept) if f.values[k] > 0]
        gaps = [abs(at[w, i, j] / f.n - at[w, i, -1] / f.n * at[w, j, -1] / f.n - (i == j))
                for i in live for j in live if i <= j]
        f.error = max(gaps, default=0.0)


def whiten(df: DataFrame, ident: str = "vec_id", vector: str = "embedding", kept: int = KEPT) -> DataFrame:
    """``ident, component, n, deviation, whitened, explained, identity_error``:
    a row for each row of ``df`` with a whole vector and each of its ``kept``
    leading components.

    Vectors become whole numbers (``floor(256 * c)``); the fit list is each of
    them once. Rows whose vector is null or holds null or non-finite entries
    are left out, repeated rows and null ids stay; further columns are ignored.
    Each vector length has a fit of its own; fewer components than ``kept``
    give fewer rows, empty vectors none. A component without variance (all
    vectors equal, or more components than vectors span) has a null
    ``whitened`` and an ``explained`` of 0 and does not count in
    ``identity_error``. Entries of 2**54 or more do not fit a long times 256:
    such rows are left out. A deviation beyond a long is null. No rows give no
    rows.
    """
    kind = df.schema[ident].dataType.simpleString()
    d = df.select(F.col(ident).alias("_id"), F.col(vector).alias("_v")).filter(whole("_v")).filter(
        ~F.exists("_v", lambda c: F.abs(c.cast("double")) >= float(1 << 54)))
    d = written(_integers(d, "_v").select("_id", "_x").filter(F.size("_x") > 0), "integers")
    distinct = written(d.select("_x").distinct().withColumn("_w", F.size("_x")), "fit-list")
    fits = fit(distinct.select("_x"), kept)
    _identity_errors(distinct.select("_x"), fits)

    def run(batches):
        for w, t in runs(batches, "_x", BATCH):
            f = fits[w]
            x = matrix(t.column("_x").chunk(0), np.int64)
            y = f.project(x.astype(float))
            most = f.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, f.sums))
            if most * most * w < 1 << 63:
                gap = f.n * x - np.array(f.sums, np.int64)
                far = pa.array((gap * gap).sum(axis=1))
            else:
                gap = f.n * x.astype(object) - np.array(f.sums, object)
                far = pa.array([int(v) if v < 1 << 63 else None for v in (gap * gap).sum(axis=1)], pa.int64())
            for k in range(f.kept):
                yield pa.RecordBatch.from_arrays([
                    t.column("_id").chunk(0), pa.array(np.full(len(x), k + 1, np.int32)), pa.array(np.full(len(x), f.n)), far,
                    pa.array(y[:, k], mask=np.isnan(y[:, k])), pa.array(np.full(len(x), f.explained[k])),
                    pa.array(np.full(len(x), f.error))],
                    [ident, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return d.mapInArrow(run, f"{ident} {kind}, component int, n long, deviation long, whitened double, "
                             "explained double, identity_error double")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
