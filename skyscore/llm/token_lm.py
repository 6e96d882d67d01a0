"""Masked pseudo-likelihood over BPE tokens: a window network predicts every
token of a document from ``SIDE`` tokens on either side.

The vocabulary is what occurs in the corpus, gathered with its counts. The
network (token embeddings, a weight for each place of the window, tanh) ends in
a softmax down a tree of three levels over the tokens in order of frequency, so
probabilities are exact and normalised at a cost of three cube roots of the
vocabulary. Executors train it on minibatches of all tokens: each task goes
through its own part, and their changes are averaged by how often a row was
used, ``ROUNDS`` times, each on another share of the documents. What is
gathered grows with the input; the result depends on how it is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenise import encoder

SIDE, DIM, PIECE, RATE, ROUNDS, SEED = 4, 16, 1 << 14, 0.1, 2, 7
#: places of the window, and how many tokens are worked on in the cache
PLACES, STRETCH = [*range(SIDE), *range(SIDE + 1, 2 * SIDE + 1)], 2048
#: tokens scored at once: the nodes of the tree are visited once for all of them
SCORED = 1 << 15
#: numbers in a row of what the tasks send
BLOCK = 4096
#: nodes of so few places are worked on together, up to so many columns
WIDTHS, TOGETHER = (16, 64, 256), 1 << 12
#: texts encoded, and bytes of token ids worked on, at once
ROWS, GROUP = 256, 1 << 21


def with_ids(df: DataFrame, path: str, more=None, fields: str = "", text: str = "text") -> DataFrame:
    """``df`` with the token ids of every whole text as bytes (``_ids``, 4 a
    token; null text: none) in place of the text. ``more``, a function of a list
    of texts, gives the arrays of the further columns ``fields``."""
    d = df.drop("_ids")
    names = [c for c in d.columns if c != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name != text],
                        *([fields] if more else []), "_ids binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), ROWS):
                b = whole.slice(a, ROWS)
                texts = b.column(text).to_pylist()
                ids = [x.astype("<u4").tobytes() for x in encoder(path).encode(texts)]
                extra = more(texts) if more else {}
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], *extra.values(), pa.array(ids, pa.binary())],
                                                 [*names, *extra, "_ids"])

    return d.mapInArrow(run, schema)


def groups(docs: list[bytes]) -> Iterator[list[bytes]]:
    """``docs`` in turn, up to ``GROUP`` bytes at once (or one document)."""
    held, size = [], 0
    for d in docs:
        if held and size + len(d) > GROUP:
            yield held
            held, size = [], 0
        held.append(d)
        size += len(d)
    if held:
        yield held


def vocabulary(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Token ids that occur in ``_ids``, most frequent first, and how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(0, np.int64)
        for b in batches:
            for docs in groups(b.column(0).to_pylist()):
                found = np.bincount(np.frombuffer(b"".join(docs), "<u4").astype(np.int64), minlength=len(n))
                found[:len(n)] += n
                n = found
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["id", "n"])

    found = rows.select("_ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    found = sorted(((r["n"], r["id"]) for r in found), key=lambda x: (-x[0], x[1]))
    return np.array([i for _, i in found], np.int64), np.array([n for n, _ in found], np.int64)


class Model:
    """``ranks``: token id to place in the vocabulary. One place more stands for
    tokens never seen, one for the edge of a document."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, seed: int = SEED):
        self.unknown, self.edge = len(ids), len(ids) + 1
        self.ranks = np.full(int(ids.max(initial=0)) + 1, self.unknown, np.int64)
        self.ranks[ids] = np.arange(len(ids))
        self.base = b = next(i for i in range(1, 1 << 20) if i ** 3 >= len(ids) + 1)
        rng = np.random.default_rng(seed)
        mass = np.zeros(b ** 3)
        mass[:len(ids) + 1] = np.append(n, 1)
        leaves = mass.reshape(b * b, b)
        sums = np.concatenate((mass.reshape(b, -1).sum(1)[None], mass.reshape(b, b, b).sum(2), leaves))
        self.parts = [rng.normal(0, 0.5, (self.edge + 1, DIM)), np.full((1, 2 * SIDE * DIM), (2 * SIDE) ** -0.5),
                      np.zeros((len(sums), b * DIM)), np.log(np.maximum(sums, 1e-30))]
        self.parts = [p.astype(np.float32) for p in self.parts]

    def sequence(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the documents one after another, ``SIDE`` edges around each,
        and how many tokens each has."""
        size = np.array([len(d) // 4 for d in docs], np.int64)
        ids = np.frombuffer(b"".join(docs), "<u4").astype(np.int64)
        known = ids < len(self.ranks)
        out = np.full(len(ids) + SIDE * (len(docs) + 1), self.edge)
        at = np.arange(len(ids)) + SIDE * (1 + np.repeat(np.arange(len(docs)), size))
        out[at] = np.where(known, self.ranks[np.where(known, ids, 0)], self.unknown)
        return out, size

    def pieces(self, seq: np.ndarray, size=lambda: PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts of ``size()`` places with their windows, and the places in them
        that hold a token, in order of rank."""
        a = SIDE
        while a < len(seq) - SIDE:
            n = size()
            part = seq[a - SIDE:min(a + n, len(seq) - SIDE) + SIDE]
            here = part[SIDE:len(part) - SIDE]
            at = np.flatnonzero(here != self.edge)
            yield part, at[self.order(here[at])]
            a += n

    def order(self, ranks: np.ndarray) -> np.ndarray:
        """Stable ascending order; short numbers sort by radix."""
        return np.argsort(ranks.astype(np.uint16) if self.edge < 1 << 16 else ranks, kind="stable")

    def growing(self) -> int:
        """Size of the next minibatch: twice as large every 16, up to ``PIECE``."""
        self.steps += 1
        return min(PIECE, 1024 << min(self.steps // 16, 16))

    def hidden(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings and hidden states, a row a place. Both lie in memory by
        dimension, so that a dimension is one correlation with its weights."""
        table, w = self.parts[0], self.taps()
        if len(table) <= len(part):
            x = self._drawn(np.ascontiguousarray(table.T), part)
        else:
            x = np.ascontiguousarray(table.take(part, axis=0).T)
        out = np.empty((DIM, len(part) - 2 * SIDE), np.float32)
        for d in range(DIM):
            np.tanh(np.correlate(x[d], w[d], "valid"), out=out[d])
        return x.T, out.T

    @staticmethod
    def _drawn(columns: np.ndarray, at: np.ndarray, rows: int = DIM) -> np.ndarray:
        """The columns ``at`` (all of them there) in the first of ``rows`` rows, ones in the others."""
        out = Model._rows(rows, len(at))
        for c, o in zip(columns, out):
            c.take(at, out=o, mode="clip")
        out[len(columns):] = 1
        return out

    @staticmethod
    def _rows(rows: int, n: int) -> np.ndarray:
        """Rows of ``n`` numbers, apart by no power of two, as parts of all rows
        are worked on at once and would share few lines of the cache."""
        return np.empty((rows, n // 1024 * 1024 + 1552), np.float32)[:, :n]

    def taps(self) -> np.ndarray:
        """Weights of the window's places for each dimension, 0 at the token's own place."""
        w = np.zeros((DIM, 2 * SIDE + 1), np.float32)
        w[:, PLACES] = self.parts[1].reshape(2 * SIDE, DIM).T
        return w

    def runs(self, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """What ascending ranks visit down the tree, at most ``STRETCH`` places
        at once: the level, the node, and its places from and up to."""
        b, found = self.base, []
        for level, (first, width) in enumerate(((0, b ** 3), (1, b * b), (1 + b, b))):
            at = np.searchsorted(rank, np.arange(0, b ** 3 + 1, width))
            parts = -(-np.diff(at) // STRETCH)
            node = np.repeat(np.arange(b ** level), parts)
            start = at[node] + STRETCH * (np.arange(len(node)) - np.repeat(np.cumsum(parts) - parts, parts))
            found.append((np.full(len(node), level), first + node, start, np.minimum(start + STRETCH, at[node + 1])))
        return tuple(map(np.concatenate, zip(*found)))

    def children(self, rank: np.ndarray) -> np.ndarray:
        """The child that each rank takes on each level, one level after another."""
        leaf = rank // self.base
        top = leaf // self.base
        return np.concatenate((top, leaf - top * self.base, rank - leaf * self.base))

    def visits(self, rank: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Down the tree for ascending ranks: a node, its places ``a`` to ``b``
        in ``rank``, and where the child each takes lies in a table of children
        (rows) by these places."""
        child = self.children(rank)
        for level, node, a, b in zip(*(x.tolist() for x in self.runs(rank))):
            yield node, a, b, child[level * len(rank) + a:level * len(rank) + b] * (b - a) + np.arange(b - a)

    def blocks(self, rank: np.ndarray, own: np.ndarray, whole: tuple[np.ndarray, np.ndarray]):
        """Down the tree for ascending ranks and their hidden states (columns,
        with a last row of ones): the nodes, their levels, the places from and
        up to, the weights, the states and the powers of each (a matrix a node),
        their sums, where the children taken lie in the powers, and which of the
        columns are places of the node (None: all). Nodes of many places come by
        themselves, those of few together, filled up to the same width."""
        level, node, start, end = self.runs(rank)
        child, step, (weights, tame) = self.children(rank), np.arange(max(STRETCH, *WIDTHS)), whole
        size, at = end - start, 0
        for i in np.flatnonzero(size > WIDTHS[-1]).tolist():
            a, b = int(start[i]), int(end[i])
            w, x = weights[node[i]][None], own[None, :, a:b]
            z, sums = self._powers(w, tame[node[i]], x)
            taken = child[level[i] * len(rank) + a:level[i] * len(rank) + b] * (b - a)
            taken += step[:b - a]
            yield node[i:i + 1], level[i:i + 1], start[i:i + 1], end[i:i + 1], w, x, z, sums, taken, None
        for width in WIDTHS:
            few = np.flatnonzero((size > at) & (size <= width))
            at = width
            for i in (few[j:j + TOGETHER // width] for j in range(0, len(few), TOGETHER // width)):
                place = start[i][:, None] + step[:width]
                live = place < end[i][:, None]
                np.minimum(place, len(rank) - 1, out=place)
                w = weights[node[i]]
                x = self._drawn(own, place.ravel(), len(own)).reshape(len(own), len(i), width).transpose(1, 0, 2)
                z, sums = self._powers(w, tame[node[i]].all(), x)
                place += (level[i] * len(rank))[:, None]
                taken = (child.take(place) + step[:len(i), None] * self.base) * width + step[:width]
                yield node[i], level[i], start[i], end[i], w, x, z, sums, taken[live], live

    def walk(self, rank: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray]]:
        """(node, its places in ``rank``, the child each takes) down the tree,
        for ascending ranks."""
        for node, a, b, where in self.visits(rank):
            yield node, slice(a, b), where // (b - a)

    def _shares(self, node: int, h: np.ndarray) -> np.ndarray:
        """Shares of the children of a node (rows) for hidden states."""
        z = self.parts[2][node].reshape(self.base, DIM) @ h.T + self.parts[3][node][:, None]
        z -= z.max(axis=0)
        np.exp(z, out=z)
        z *= 1 / z.sum(axis=0)
        return z

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of every node with the shift as one more column, and whether
        ``exp`` can do without the greatest of each state. As a hidden state has
        no entry beyond 1, the weights bound what a child gets; shifts are less
        what the greatest child gets at least."""
        w = self.parts[2].reshape(-1, self.base, DIM)
        reach = np.abs(w) @ np.ones(DIM, np.float32)
        low = (self.parts[3] - reach).max(axis=1)
        high = (self.parts[3] + reach).max(axis=1)
        return np.concatenate((w, (self.parts[3] - low[:, None])[:, :, None]), axis=2), high - low < 80

    @staticmethod
    def _powers(weights: np.ndarray, tame: bool, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the children (rows) up to a factor, and their sums, for
        hidden states (columns) with a last row of ones: a matrix a node."""
        z = weights @ own
        if not tame:
            z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        return z, np.add.reduce(z, axis=1)

    def log_p(self, docs: list[bytes]) -> list[float]:
        """Sum of log p of every token given its window, for each document."""
        seq, size = self.sequence(docs)
        out = np.zeros(len(seq))
        whole = self.whole()
        for k, (part, at) in enumerate(self.pieces(seq, lambda: SCORED)):
            own, p = self._drawn(self.hidden(part)[1].T, at, DIM + 1), np.ones(len(at))
            shares = np.empty((3, len(at)), np.float32)
            for _, level, start, end, _, _, z, sums, taken, live in self.blocks(part[SIDE + at], own, whole):
                got = z.ravel().take(taken, mode="clip")
                if live is None:
                    np.divide(got, sums[0], out=shares[level[0], start[0]:end[0]])
                    continue
                got /= sums[live]
                cuts = np.cumsum(end - start).tolist()
                for i, a, b, c in zip(level.tolist(), start.tolist(), end.tolist(), cuts):
                    shares[i, a:b] = got[c - b + a:c]
            for got in np.maximum(shares, 1e-30, out=shares):
                p *= got
            out[SIDE + k * SCORED + at] = np.log(p)
        total = np.concatenate(([0.0], np.cumsum(out)))
        start = SIDE + np.concatenate(([0], np.cumsum(size + SIDE)[:-1])).astype(np.int64)
        return (total[start + size] - total[start]).tolist()

    def _step(self, i: int, rows, g: np.ndarray) -> None:
        seen = self.seen[i][rows] + g * g
        self.seen[i][rows] = seen
        self.parts[i][rows] -= RATE * g / np.sqrt(seen + 1e-12)

    def learn(self, docs: list[bytes]) -> None:
        """One pass by Adagrad; ``used`` counts how often each row took part."""
        for part, at in self.pieces(self.sequence(docs)[0], self.growing):
            if not len(at):
                continue
            x, hidden = self.hidden(part)
            own, n, x = self._drawn(hidden.T, at, DIM + 1), len(part) - 2 * SIDE, x.T
            back, nodes, grads, times = [self._rows(DIM, len(at) + k) for k in (1, 0, 0)], [], [], []
            for node, level, start, end, w, h, z, sums, taken, live in self.blocks(part[SIDE + at], own, self.whole()):
                np.reciprocal(sums, out=sums)
                if live is not None:
                    sums *= live
                z *= sums[:, None]
                z.reshape(-1)[taken] -= 1
                w = w[:, :, :DIM].transpose(0, 2, 1)
                if live is None:
                    np.matmul(w[0], z[0], out=back[level[0]][:, start[0]:end[0]])
                else:
                    for k, a, b, share in zip(level.tolist(), start.tolist(), end.tolist(), w @ z):
                        back[k][:, a:b] = share[:, :b - a]
                nodes.append(node)
                grads.append(z @ h.transpose(0, 2, 1))
                times.append(end - start)
            # every node once a minibatch, all of them at once
            nodes, grads = np.concatenate(nodes), np.concatenate(grads)
            order = np.argsort(nodes, kind="stable")
            nodes, first = np.unique(nodes[order], return_index=True)
            grads = np.add.reduceat(grads[order], first, axis=0) / np.float32(len(at))
            self._step(2, nodes, grads[:, :, :DIM].reshape(len(nodes), -1))
            self._step(3, nodes, grads[:, :, DIM])
            self.used[2][nodes] += np.add.reduceat(np.concatenate(times)[order], first)
            h = own[:DIM]
            h *= h
            np.subtract(1, h, out=h)
            h /= len(at)
            back, middle, low = back
            back[:, -1] = 0
            for total, k, m, slope in zip(back[:, :-1], middle, low, h):
                total += k
                total += m
                total *= slope
            # 0 at places without a token, and beyond both ends
            place = np.full(n + 4 * SIDE, len(at))
            place[2 * SIDE + at] = np.arange(len(at))
            d, w = self._drawn(back, place), self.taps()
            dx, dw = np.empty_like(x), np.empty_like(w)
            for k in range(DIM):
                dw[k] = np.correlate(x[k], d[k, 2 * SIDE:-2 * SIDE], "valid")
                dx[k] = np.correlate(d[k], w[k, ::-1], "valid")
            order = self.order(part)
            token = part[order]
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            times, token = np.diff(np.append(first, len(token))), token[first]
            self._step(0, token, np.add.reduceat(self._drawn(dx, order), first, axis=1).T)
            self._step(1, 0, dw.T[PLACES].reshape(-1))
            self.used[0][token] += times
            self.used[1] += len(at)

    def changes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What learning from the batches changes, times how often each row was
        used, and these numbers: cut in blocks, those of zeros left out."""
        before, self.steps = [p.copy() for p in self.parts], 0
        self.seen = [np.zeros_like(p) for p in self.parts]
        self.used = [np.zeros(len(p), np.float32) for p in self.parts]
        for b in batches:
            for docs in groups(b.column(0).to_pylist()):
                self.learn(docs)
        self.used[3] = self.used[2]
        flat = np.concatenate([*[((p - q) * u[:, None]).reshape(-1) for p, q, u in zip(self.parts, before, self.used)],
                               *self.used])
        at = [i for i in range(0, len(flat), BLOCK) if flat[i:i + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(
            [flat[i:i + BLOCK].astype(np.float64).tobytes() for i in at], pa.binary())], ["at", "part"])

    def apply(self, blocks) -> None:
        sizes = [p.size for p in self.parts] + [len(p) for p in self.parts]
        flat = np.zeros(sum(sizes))
        for at, part in blocks:
            part = np.frombuffer(part, np.float64)
            flat[at:at + len(part)] = part
        found = np.split(flat, np.cumsum(sizes)[:-1])
        for p, change, used in zip(self.parts, found[:4], found[4:]):
            p += (change.reshape(p.shape) / np.maximum(used, 1)[:, None]).astype(np.float32)


#: parts that the tasks' changes are summed up in first
SALTS = 64


def _sum(t: pa.Table) -> pa.Table:
    total = 0.0
    for x in t.column("part"):
        total = total + np.frombuffer(x.as_buffer(), np.float64)
    return pa.table({"at": t.column("at").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def train(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """The network fitted to all documents of ``rows`` (column ``_ids``). No
    rows, or none with a token: the untrained network, which knows no token."""
    model = Model(*vocabulary(rows))
    for k in range(rounds):
        held = rows.sparkSession.sparkContext.broadcast(model)
        share = rows.filter(F.pmod(F.xxhash64("_ids"), F.lit(rounds)) == k).select("_ids")

        def changes(batches, held=held):
            import copy
            mine = copy.copy(held.value)
            mine.parts = [p.copy() for p in mine.parts]
            return mine.changes(batches)

        # in two levels: a group holds a row of each task of one salt, then of each salt
        sent = share.mapInArrow(changes, "at long, part binary").withColumn("salt", F.spark_partition_id() % SALTS)
        found = sent.groupBy("at", "salt").applyInArrow(_sum, "at long, part binary").groupBy("at").applyInArrow(
            _sum, "at long, part binary")
        model.apply((r["at"], bytes(r["part"])) for r in found.collect())
        held.unpersist()
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``mean_bpe_pll`` (log p a token, null without tokens),
    ``n_bpe`` (tokens) and ``bpe_pll`` (sum of log p of every token given its
    window) for ``_ids``. Repeated rows score alike; no rows give no rows;
    columns of these names are replaced."""
    rows = rows.drop("n_bpe", "bpe_pll", "mean_bpe_pll")
    held = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in parts:
            yield pd.Series([x for docs in groups(ids.tolist()) for x in held.value.log_p(docs)], dtype="float64")

    d = rows.withColumns({"n_bpe": F.length("_ids").cast("long") / 4, "bpe_pll": run("_ids")})
    d = d.withColumn("n_bpe", F.col("n_bpe").cast("long"))
    return d.withColumn("mean_bpe_pll", F.when(F.col("n_bpe") > 0, F.col("bpe_pll") / F.col("n_bpe"))).drop("_ids")
