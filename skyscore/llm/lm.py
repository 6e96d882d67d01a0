"""Masked pseudo-likelihood. The registered query scores BPE tokens by the
window network of ``token_lm``; the rest of this module is a smaller relative
that nothing registers: a window network over characters predicts every
token of a document from both sides; the summed conditional log-probabilities
score the document.

Characters fall into ``V`` classes by a fixed rule. The network sees one token
on either side, so the corpus is summed up whole by its counts of (left,
token, right): executors count over all documents, and the network is trained
in numpy on these counts (at most V**3 numbers, of which natural text fills a
few per cent). It has then V**2 contexts, whose predictions are tabulated once
and looked up for every token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import token_lm
from .common import table, written
from .pack import tokenizer_path

V = 128
EDGE = 127  # before the first and after the last token
DIM, HIDDEN, STEPS, RATE, SEED = 12, 48, 240, 0.02, 7


def _classes() -> np.ndarray:
    """Class of each code point below 256 * 256: ASCII letters in lower case,
    digits as one class, blanks as one; other code points by remainder."""
    c = np.arange(1 << 16)
    out = 96 + c % 31
    ascii_ = (c >= 32) & (c < 127)
    out[ascii_] = c[ascii_] - 32
    out[65:91] = np.arange(97, 123) - 32
    out[48:58] = 16
    out[:32] = 95
    out[[9, 10, 11, 12, 13]] = 0
    out[127] = 95
    return out


CLASS = _classes()


def tokens(text: str | None) -> np.ndarray:
    """Token classes of a whole text; null: none."""
    if not text:
        return np.zeros(0, np.int64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return CLASS[c & 0xFFFF]


def codes(t: np.ndarray) -> np.ndarray:
    """(left, right, token) of every place as one number."""
    x = np.concatenate(([EDGE], t, [EDGE]))
    return (x[:-2] * V + x[2:]) * V + t


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(V ** 3, np.int64)
    for b in batches:
        held, size = [], 0
        for t in b.column(0):
            c = codes(tokens(t.as_py()))
            held.append(c)
            size += len(c)
            if size > 1 << 20:
                n += np.bincount(np.concatenate(held), minlength=V ** 3)
                held, size = [], 0
        if size:
            n += np.bincount(np.concatenate(held), minlength=V ** 3)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["code", "n"])


def counts(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Codes that occur in ``docs``, ascending, and how often: V**3 at most."""
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_counts, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n")).toPandas().sort_values("code")
    return rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def train(code: np.ndarray, n: np.ndarray, steps: int = STEPS, seed: int = SEED) -> np.ndarray:
    """Table (V, V, V) of log p(token | left, right) by a network of token
    embeddings, one tanh layer and a softmax, fitted by full-batch Adam to the
    counts. No counts: the untrained network."""
    rng = np.random.default_rng(seed)
    par = [rng.normal(0, 0.3, (V, DIM)), rng.normal(0, 0.3, (V, DIM)),
           rng.normal(0, (2 * DIM) ** -0.5, (2 * DIM, HIDDEN)), np.zeros(HIDDEN),
           rng.normal(0, HIDDEN ** -0.5, (HIDDEN, V)), np.zeros(V)]
    par = [p.astype(np.float32) for p in par]
    context, place = np.unique(code // V, return_inverse=True)
    left, right = context // V, context % V
    want = np.zeros((len(context), V), np.float32)
    want[place, code % V] = n / max(1, n.sum())
    mass = want.sum(axis=1, keepdims=True)
    first, second = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    if len(code):
        base = np.bincount(code % V, weights=n, minlength=V)
        par[5] = np.log((base + 1) / (base.sum() + V)).astype(np.float32)
    for step in range(steps if len(code) else 0):
        x = np.concatenate((par[0][left], par[1][right]), axis=1)
        h = np.tanh(x @ par[2] + par[3])
        logits = h @ par[4] + par[5]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = p * mass - want
        dh = (d @ par[4].T) * (1 - h * h)
        dx = dh @ par[2].T
        gl, gr = np.zeros_like(par[0]), np.zeros_like(par[1])
        np.add.at(gl, left, dx[:, :DIM])
        np.add.at(gr, right, dx[:, DIM:])
        rate = RATE * (1 - step / steps)
        for i, g in enumerate([gl, gr, x.T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0)]):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            par[i] = par[i] - rate * (first[i] / (1 - 0.9 ** (step + 1))) / (
                np.sqrt(second[i] / (1 - 0.999 ** (step + 1))) + 1e-8)
    return log_table(par)


def log_table(par: list[np.ndarray]) -> np.ndarray:
    out = np.empty((V, V, V), np.float32)
    for a in range(V):
        x = np.concatenate((np.repeat(par[0][a:a + 1], V, axis=0), par[1]), axis=1)
        logits = np.tanh(x @ par[2] + par[3]) @ par[4] + par[5]
        top = logits.max(axis=1, keepdims=True)
        out[a] = logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
    return out


def _scores(texts, log_p: np.ndarray) -> list[tuple[int, float]]:
    flat = log_p.reshape(-1)
    return [(len(t), float(flat[codes(t)].sum(dtype=np.float64))) for t in map(tokens, texts)]


def score(df: DataFrame, log_p: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``pll`` (sum of log p of every token given its
    neighbours) and ``mean_pll`` (per token). Null or empty texts: 0, 0.0 and a
    null mean. Columns of these names are replaced. The table shipped to the
    tasks has V**3 numbers (8 MB)."""
    held = df.sparkSession.sparkContext.broadcast(log_p)

    @F.pandas_udf("n_tokens long, pll double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame(_scores(texts, held.value), columns=["n_tokens", "pll"])

    d = df.drop("n_tokens", "pll", "mean_pll").withColumn("_s", run(F.col(text)))
    return d.withColumns({"n_tokens": F.col("_s.n_tokens"), "pll": F.col("_s.pll"), "mean_pll": F.when(
        F.col("_s.n_tokens") > 0, F.col("_s.pll") / F.col("_s.n_tokens"))}).drop("_s")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the token network (``token_lm``) trained on all
    documents: ``score`` is the mean log p of its tokens given the window on
    both sides, ``pll`` their sum. Null and empty texts have no tokens and a
    null score; no documents give no rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = written(token_lm.with_ids(docs, tokenizer_path()), "tokens")
    return token_lm.score(rows, token_lm.train(rows)).select(
        "doc_id", F.col("mean_bpe_pll").alias("score"), F.col("bpe_pll").alias("pll"), F.col("n_bpe").alias("n_tokens"))
