"""Benchmark decontamination: exact containment of item windows in documents.

A window (10 consecutive item words; a shorter item is one window) is a set of
word shingles. If a document holds the window it holds the window's rarest
shingle, so joining that one shingle is enough: the prefix of an exact
containment join, with shingles ordered by their frequency in all documents.
A match fixes where the window would lie; the ends of the document bound it
(position and length) before the words are compared one by one.

The distinct windows of a block go to every task as flat arrays (some 100 bytes
a window); blocks hold at most ``MAX_WINDOWS`` or so and are looked up one after
another, each in all documents. Documents are never shuffled, and items never
come to the driver: a document's windows find their items in a join afterwards.
Words are compared by 64-bit hashes, as many as the window has words; windows
are named by a 64-bit hash of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shingle_hashes, table, word_hashes, written

WINDOW = 10
SHINGLE = 3
MAX_WINDOWS = 500_000
#: bits of the hash that the first, coarse look-up reads
COARSE = 20

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
SPANS = "array<struct<start:int,words:int,window:long>>"
#: candidates whose words are compared at once
STEP = 1 << 16
#: a window that a third of all documents hold is joined in as many parts
SALTS = 16


def words_of(text: bytes | None) -> np.ndarray:
    """Hashes of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text
    whose A-Z are lower-cased; null: none."""
    return word_hashes(text.lower(), WORD) if text else np.zeros(0, np.uint64)


class Lookup:
    """Positions of the members of a hash array that stand in a fixed set."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.coarse = np.zeros(1 << COARSE, bool)
        self.coarse[(self.sorted >> np.uint64(64 - COARSE)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, their places in ``sorted``)."""
        at = np.flatnonzero(self.coarse[(h >> np.uint64(64 - COARSE)).astype(np.int64)])
        place = np.searchsorted(self.sorted, h[at])
        ok = self.sorted[np.minimum(place, len(self.sorted) - 1)] == h[at] if len(self.sorted) else place < 0
        return at[ok], place[ok]


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    return shingle_hashes(words, k) if len(words) >= k else words[:0]


def _window_rows(batches: Iterator[pa.RecordBatch], window: int, unnamed: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        item, win = [], []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist()):
            w = words_of(t)
            if len(w) and (unnamed or i is not None):
                for a in range(max(1, len(w) - window + 1)):
                    item.append(i)
                    win.append(w[a:a + window].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(win, pa.binary())], ["item", "words"])


def _rows_of(raw: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint64).reshape(-1, size)


def _by_size(raw: list[bytes]) -> dict[int, np.ndarray]:
    """Places in ``raw`` of the windows of each number of words."""
    sizes = np.array([len(x) // 8 for x in raw], np.int64)
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


def _row_shingles(rows: np.ndarray) -> np.ndarray:
    """Shingles of windows of one size, a row each."""
    k = min(SHINGLE, rows.shape[1])
    # the k words of every row, one row after another: each k-th shingle is a row's
    return np.stack([shingle_hashes(np.ascontiguousarray(rows[:, i:i + k]).reshape(-1), k)[::k]
                     for i in range(rows.shape[1] - k + 1)], axis=1)


class Index:
    """Distinct windows of one block by their rarest shingle, as flat arrays.

    ``raw``: word hashes of each window; ``ids``: its number; ``hashes``
    (sorted) and ``counts``: how often a shingle stands in the documents."""

    def __init__(self, raw: list[bytes], ids: np.ndarray, hashes: np.ndarray, counts: np.ndarray):
        parts: dict[int, list] = {}
        self.width = max((len(x) // 8 for x in raw), default=1)
        for size, at in _by_size(raw).items():
            rows = _rows_of([raw[i] for i in at], size)
            s = _row_shingles(rows)
            n = np.zeros(s.shape, np.int64)
            if len(hashes):
                place = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                n = np.where(hashes[place] == s, counts[place], 0)
            # rarest, then least hash, then first place
            off = np.where(n == n.min(axis=1, keepdims=True), s, np.iinfo(np.uint64).max).argmin(axis=1)
            full = np.zeros((len(rows), self.width), np.uint64)
            full[:, :size] = rows
            parts.setdefault(min(SHINGLE, size), []).append(
                (s[np.arange(len(s)), off], off, np.full(len(rows), size), ids[at], full))
        self.by: dict[int, tuple] = {}
        for k, found in parts.items():
            rare, off, size, number, rows = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(rare, kind="stable")
            look = Lookup(rare)
            ends = np.searchsorted(rare[order], look.sorted, "right")
            self.by[k] = (look, np.concatenate(([0], ends)), off[order].astype(np.int16), size[order].astype(np.int16),
                          number[order], rows[order])

    def spans(self, w: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, words, window) of every occurrence, in order."""
        out = []
        for k, (look, ends, off, size, number, rows) in self.by.items():
            at, place = look.find(_shingles(w, k))
            upto = np.cumsum(ends[place + 1] - ends[place])
            for i in range(0, int(upto[-1]) if len(upto) else 0, STEP):
                c = np.arange(i, min(i + STEP, int(upto[-1])))
                hit = np.searchsorted(upto, c, "right")
                r = ends[place[hit] + 1] - (upto[hit] - c)
                a = at[hit] - off[r]
                ok = (a >= 0) & (a + size[r] <= len(w))
                r, a = r[ok], a[ok]
                cell = np.arange(self.width)
                same = w[np.minimum(a[:, None] + cell, len(w) - 1)] == rows[r]
                ok = (same | (cell >= size[r][:, None])).all(axis=1)
                out += zip(a[ok].tolist(), size[r[ok]].tolist(), number[r[ok]].tolist())
        return sorted(out)


def _item_shingles(raw: list[bytes]) -> np.ndarray:
    """Distinct shingles of all windows."""
    found = [np.unique(_row_shingles(_rows_of([raw[i] for i in at], n))) for n, at in _by_size(raw).items()]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def shingle_counts(docs: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each of ``hashes`` (shingles of 1 to SHINGLE words) stands in
    all documents: (sorted hashes, counts), 16 bytes a shingle."""
    held = docs.sparkSession.sparkContext.broadcast(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(held.value)
        n = np.zeros(len(look.sorted), np.int64)
        for b in batches:
            for t in b.column(0).cast(pa.large_binary()):
                w = words_of(t.as_py())
                for k in range(1, SHINGLE + 1):
                    n += np.bincount(look.find(_shingles(w, k))[1], minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(look.sorted[at].astype(np.int64)), pa.array(n[at])], ["h", "n"])

    rows = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toArrow()
    h, n = rows["h"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def windows(items: DataFrame, window: int = WINDOW, unnamed: bool = False) -> DataFrame:
    """(window, words, item): the distinct windows of each item, written."""
    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(
        lambda b: _window_rows(b, window, unnamed), "item string, words binary").distinct()
    return written(rows.select(F.xxhash64("words").alias("window"), "words", "item"), "windows")


def occurrences(docs: DataFrame, wins: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``: array of (start word, number of
    words, window) of every occurrence of a window of ``wins``. A block of
    windows is looked up in one pass; between blocks the rows are written."""
    docs = docs.drop("n_words", "spans")
    names = docs.columns
    distinct = wins.select("window", "words").distinct()
    blocks = max(1, -(-distinct.count() // MAX_WINDOWS))
    out = docs.toDF(*[f"c{i}" for i in range(len(names))])
    t = f"c{names.index(text)}"
    texts = docs.select(F.col(text).alias("text"))
    out = out.withColumns({"n_words": F.lit(None).cast("long"), "spans": F.array().cast(SPANS)})
    for i in range(blocks):
        found = distinct.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i).toArrow()  # MAX_WINDOWS or so
        raw, ids = found["words"].to_pylist(), found["window"].to_numpy()
        counts = shingle_counts(texts, _item_shingles(raw)) if raw else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        index = docs.sparkSession.sparkContext.broadcast(Index(raw, ids, *counts))
        out = _marked(out if i == 0 else written(out, "spans"), index, t)
    return out.toDF(*names, "n_words", "spans")


def with_items(df: DataFrame, wins: DataFrame) -> DataFrame:
    """``df`` (window and further columns) joined to the items of its windows; a
    window of very many rows is dealt over ``SALTS`` keys."""
    part = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    parts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    return df.withColumn("_part", part).join(
        wins.select(F.col("window"), "item", parts.alias("_part")), ["window", "_part"]).drop("_part")


def mark(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW,
         unnamed: bool = False) -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``: array of (start word, number of
    words, item_id as text) of every occurrence of a window.

    ``items``: item_id, text. Null or wordless texts have no words and no
    windows; items without an id are left out, or with ``unnamed`` marked by a
    null item; repeated items or rows are marked alike; empty tables give empty
    or unmarked results. Columns named n_words or spans are replaced.
    """
    wins = windows(items, window, unnamed)
    d = occurrences(docs, wins, text)
    names = d.columns
    d = written(d.toDF(*[f"c{i}" for i in range(len(names) - 1)], "spans").withColumn(
        "at", F.monotonically_increasing_id()), "marked")
    each = with_items(d.select("at", F.explode("spans").alias("s")).select("at", "s.*"), wins)
    found = each.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("start", "words", "item"))).alias("found"))
    none = F.array().cast("array<struct<start:int,words:int,item:string>>")
    d = d.join(found, "at", "left")
    return d.select(*[f"c{i}" for i in range(len(names) - 1)], F.coalesce("found", none)).toDF(*names)


def _marked(d: DataFrame, index, text: str) -> DataFrame:
    schema = d.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for b in batches:
            n, spans = [], []
            for t, before in zip(b.column(text).cast(pa.large_binary()), b.column("spans").to_pylist()):
                w = words_of(t.as_py())
                n.append(len(w))
                spans.append(before + [{"start": a, "words": s, "window": i} for a, s, i in ix.spans(w)])
            columns = dict(zip(b.schema.names, b.columns))
            columns["n_words"] = pa.array(n, pa.int64())
            columns["spans"] = pa.array(spans, b.schema.field("spans").type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in b.schema.names], schema=pa.schema(
                [pa.field("n_words", pa.int64()) if c == "n_words" else b.schema.field(c) for c in b.schema.names]))

    return d.mapInArrow(run, schema)


def n_hit(spans: Column) -> Column:
    """Words that lie in a span."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.sort_array(spans), zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["start"] + s["words"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["words"] - F.greatest(a["end"], s["start"]))).alias("n")),
        lambda a: a["n"])


def clean(docs: DataFrame, items: DataFrame, unnamed: bool = False) -> DataFrame:
    """``docs`` without the documents that hold a window (``unnamed`` as in
    :func:`mark`)."""
    d = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    d = occurrences(d, windows(items, unnamed=unnamed), f"c{docs.columns.index('text')}")
    return d.filter(F.size("spans") == 0).drop("n_words", "spans").toDF(*docs.columns)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: words hit, items that hit it (those without an id count
    as one, and are not in the hashed list)."""
    wins = windows(table(spark, sf_dir, "benchmark"), unnamed=True)
    d = occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"), wins).drop("text")
    d = written(d.select("doc_id", "n_words", n_hit(F.col("spans")).alias("n_hit"),
                         F.array_distinct(F.col("spans.window")).alias("held"),
                         F.monotonically_increasing_id().alias("at")), "hits")
    held = with_items(d.select("at", F.explode("held").alias("window")), wins).select("at", "item").distinct()
    held = held.groupBy("at").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    d = d.join(held, "at", "left")
    return d.select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def _words_sql(name: str, key: str) -> str:
    return (f"SELECT {key}, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            rf"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM {name}")


SQL8 = f"""
WITH d AS ({_words_sql('documents', 'doc_id')}), i AS ({_words_sql('benchmark', 'item_id')}),
iw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS t
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS t
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, p, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.t = iw.t),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""
