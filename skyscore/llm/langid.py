"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (FTRL-Proximal)
under elastic-net penalties, then temperature calibration.

Document frequencies are counted over all training documents on the executors
(``DIMS`` numbers come back). The weights are fitted on the driver on a sample
of at most about ``SAMPLE`` labelled documents, the same number from each
language where there are so many; a part of it is set aside for the
temperature. Any number of languages may occur; those of the sample are learned.
Only dimensions of the sample are trained, and only those with a weight left by
the penalties are shipped to the tasks. Features are always those of whole texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

DIMS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE = 2000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram numbers of a whole text, ascending, and their counts. Case
    is folded; runs of other characters than letters are one blank."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a blank after each run of letters
    x = np.concatenate(([32], np.where(letter, c, 32)[keep], [32])).astype(np.uint64)
    out = []
    for n in ORDERS:
        if len(x) >= n:
            h = np.full(len(x) - n + 1, np.uint64(n))
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + x[i:len(x) - n + 1 + i]
            out.append((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - DIMS.bit_length() + 1))
    counts = np.bincount(np.concatenate(out).astype(np.int64), minlength=DIMS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _texts(b: pa.RecordBatch, name: str = "text"):
    return (v.as_py() for v in b.column(b.schema.get_field_index(name)))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(DIMS + 1, np.int64), 0
    for b in batches:
        for t in _texts(b):
            df[ngrams(t)[0]] += 1
            n += 1
    df[DIMS] = n
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["dim", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        grams = [ngrams(t) for t in _texts(b)]
        yield pa.RecordBatch.from_arrays(
            [b.column("lang"), b.column("at"), pa.array([g[0].astype(np.int32).tobytes() for g in grams], pa.binary()),
             pa.array([g[1].astype(np.int32).tobytes() for g in grams], pa.binary())], ["lang", "at", "dims", "counts"])


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row of one weight a language for each dimension that has any
    place: np.ndarray  # dimension to its row; the last row is of zeros
    temperature: float = 1.0

    def vector(self, dims: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v = (1 + np.log(counts)) * self.idf[dims]
        return v / np.sqrt(v @ v)

    def logits(self, dims: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(dims, counts) @ self.weights[self.place[dims]]

    def predict(self, text: str | None) -> tuple[str, float]:
        dims, counts = ngrams(text)
        if not len(dims) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.logits(dims, counts) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], dims: int, classes: int, epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights (dims x classes) from rows of (dims, values, class)."""
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            after = ni + g * g
            z[at] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[at] = after
    return weights(z, n)


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least mean negative log-likelihood: golden-section search
    over its logarithm, from -1 (a separable sample would sharpen without end)."""
    def loss(t):
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-300)).mean()

    lo, hi, r = -1.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from ``labelled`` (doc_id, text, lang). Rows without a lang, a
    text or letters teach nothing; no rows give a model that knows no language."""
    d = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    counts = d.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    known = counts.count()
    df = np.zeros(DIMS + 1)
    for r in d.select("text").mapInArrow(_frequencies, "dim long, n long").groupBy("dim").agg(
            F.sum("n").alias("n")).collect():
        df[r["dim"]] = r["n"]
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1
    # a row of each language and its share; the broadcast is left to the measured size
    share = F.least(F.lit(1.0), F.lit(sample / max(known, 1)) / F.col("_n"))
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 30))
    picked = (d.withColumn("at", place).join(counts, F.col("lang") == F.col("_lang"))
              .filter(F.col("at") < share * (1 << 30)).limit(2 * sample)
              .select("text", "lang", "at").mapInArrow(_sampled, "lang string, at long, dims binary, counts binary")
              .collect())
    langs = sorted({r["lang"] for r in picked})
    if not langs:
        return Model([], idf, np.zeros((1, 0)), np.zeros(DIMS, np.int64))
    # a fixed order that mixes the languages
    picked.sort(key=lambda r: ((r["at"] * 0x9E3779B1) % (1 << 32), r["lang"], bytes(r["dims"])))
    model = Model(langs, idf, np.zeros((1, len(langs))), np.zeros(DIMS, np.int64))
    number, rows = {name: i for i, name in enumerate(langs)}, []
    for r in picked:
        dims = np.frombuffer(bytes(r["dims"]), np.int32)
        if len(dims):
            rows.append((dims, model.vector(dims, np.frombuffer(bytes(r["counts"]), np.int32)), number[r["lang"]]))
    aside, fitted = rows[4::5], [x for i, x in enumerate(rows) if i % 5 != 4]
    used = np.unique(np.concatenate([at for at, _, _ in fitted])) if fitted else np.zeros(0, np.int64)
    w = ftrl([(np.searchsorted(used, at), x, y) for at, x, y in fitted], len(used), len(langs))
    live = np.flatnonzero(w.any(axis=1))
    model.weights = np.concatenate((w[live], np.zeros((1, len(langs)))))
    model.place = np.full(DIMS, len(live))
    model.place[used[live]] = np.arange(len(live))
    if aside:
        model.temperature = calibrate(np.array([x @ model.weights[model.place[at]] for at, x, _ in aside]),
                                      np.array([y for _, _, y in aside]))
    return model


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct (lang_pred, score) for a text column. The model shipped to the
    tasks has at most as many rows as the sample has dimensions."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = held.value
        for texts in parts:
            yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return run(text)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (the calibrated probability of
    that language). Null texts and texts without letters: ``und``, 0. Columns
    of these names are replaced."""
    d = df.drop("lang_pred", "score").withColumn("_p", predicted(df.sparkSession, model, F.col(text)))
    return d.withColumns({"lang_pred": F.col("_p.lang_pred"), "score": F.col("_p.score")}).drop("_p")


def held_out(doc_id: Column) -> Column:
    """Fold 0 of 5 by the CRC-32 of the id's text; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


#: a document of lower score is rejected by :func:`known`
LEAST_SCORE = 0.5


def known(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` whose language is known with a score of ``least`` at least; the
    model learns from the documents outside fold 0."""
    bounded_batches(docs.sparkSession)
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    name = "_p"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    d = docs.withColumn(name, predicted(docs.sparkSession, model, F.col("text")))
    return d.filter((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)).drop(name)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.filter(~F.col("held_out")))
    return predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")
