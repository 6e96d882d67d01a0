"""N-gram Jaccard join by parity sketches.

A text's shingle set is hashed into bits that each token flips (a parity
sketch), so sketches differ in no more bits than the sets have tokens apart:
for sets of n1 and n2 tokens with Jaccard similarity of 0.75 or more, at most
d = (n1 + n2) // 7.

*Pigeonhole.* A sketch is cut into k = 2**L parts by the leading bits of the
token hash; a part is stored as the XOR of its tokens' hashes, which equal
parts share. L follows n1 + n2, so a text takes part in the one or two levels
its partners may have. At most d parts differ, so a text with ``ne`` non-empty
parts shares ne - d of them or more with each partner. Parts are put into one
global order, rarest first, and a text keeps all but its ne - d - 1 most
frequent ones: the rarest shared part is never among those dropped. A text
with ne <= d (few tokens) also offers single tokens as parts.

*Candidates.* First every text meets hubs of its two most frequent parts (some
log2 of a part's texts), and its links to the nearest of them join components.
Most groups of copies are one component then, and only pairs in different
components are still open. Parts of few texts list their open pairs; a larger
part is dealt into blocks of about ``BLOCK`` texts, those of its largest
component apart, and blocks meet unless both are of that component; each
meeting compares its open pairs in place. In a first round only the ``NEAREST``
pairs within reach between two components leave a task, are verified and join
components; a second round emits all that is still open. Every pair that shares
a kept part was verified, or lies in one component, or is out of reach.

*Verify.* A pair's sketches (at least eight bits a token) bound the
difference; pairs within d bits are verified on the whole sets.

Copies of a set are one class from the start. Sets, classes and parts are
64-bit hashes (two different shingles agree with probability 2**-64).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, bounded_batches, mix, shingle_hashes, table, word_hashes, written
from .components import components, merged

SHINGLE = 5
#: level number of single tokens as parts
TOKENS = 63
#: a part of more texts than this counts as of so many in the global order
POPULAR = 1 << 20
#: a part of up to so many texts has its open pairs listed
SMALL = 12
#: texts of a larger part that are compared in one task
BLOCK = 256
#: parts of a text whose hubs it meets first
STARS = 2
#: hash classes of a part's texts that may give a hub
HUBS = 16
#: hubs of a text that it is verified against
NEAREST = 3


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 5-word shingles (hashes) of a UTF-8 text."""
    if not text:
        return np.zeros(0, np.uint64)
    s = np.sort(shingle_hashes(word_hashes(text.lower(), BLANKS), SHINGLE))
    new = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


def fingerprint(s: np.ndarray, mixed: np.ndarray | None = None) -> int:
    """64-bit hash of a whole set (``mixed``: its :func:`mix`, if at hand); 0
    for the empty one."""
    if not len(s):
        return 0
    x = np.bitwise_xor.reduce(mix(s) if mixed is None else mixed, keepdims=True) + np.add.reduce(s, keepdims=True) + np.uint64(len(s))
    return int(mix(x).astype(np.int64)[0])


def level(total: int) -> int:
    """Least L with 2**L parts or more for a pair of ``total`` tokens."""
    n = 0
    while (28 << n) // 5 < total:
        n += 1
    return n


def parts(s: np.ndarray, mixed: np.ndarray | None = None) -> list[tuple[int, np.ndarray, int]]:
    """(level, keys, number of most frequent keys to drop) for a sorted set
    (``mixed``: its :func:`mix`, the same for every level)."""
    n, out, few = len(s), [], False
    mixed = mix(s) if mixed is None else mixed
    least, most = n + (3 * n + 3) // 4, n + 4 * n // 3
    with np.errstate(over="ignore"):
        for lv in range(level(least), level(most) + 1):
            d = min(most, (28 << lv) // 5) // 7
            part = s >> np.uint64(64 - lv) if lv else np.zeros(n, np.uint64)
            at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            keys = mix(np.bitwise_xor.reduceat(mixed, at) ^ mix(part[at] + (np.uint64(lv + 1) << np.uint64(48))))
            few |= len(at) <= d
            out.append((lv, keys, max(0, len(at) - d - 1)))
        if few:
            out.append((TOKENS, mix(s ^ np.uint64(TOKENS)), n - most // 7 - 1))
    return out


def sketch(s: np.ndarray) -> bytes:
    """Parity sketch of eight times the set's size in bits or more (a power of
    two); a token's bit is given by its leading hash bits."""
    bits = int(len(s)).bit_length() + 3
    odd = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(v: bytes, size: int) -> np.ndarray:
    """Sketch of ``size`` bits: neighbouring bits of a longer one by exclusive
    or. As numbers of 64 bits, or of 8 where it is shorter."""
    x = np.frombuffer(v, np.uint8)
    if 8 * len(x) > size:
        x = np.unpackbits(x)
        while len(x) > size:
            x = x[0::2] ^ x[1::2]
        x = np.packbits(x)
    return x.view(np.uint64) if len(x) % 8 == 0 else x


def _apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the shorter."""
    size = 8 * min(len(a), len(b))
    return int(np.bitwise_count(_fold(a, size) ^ _fold(b, size)).sum())


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values).astype(np.int64) if len(values) else np.zeros(0, np.int64))


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes | None]:
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary())
    return (v.as_py() for v in column)


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [(fingerprint(s), len(s)) for s in map(shingle_set, _texts(b, "text"))]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([f for f, _ in found], pa.int64()),
             pa.array([n for _, n in found], pa.int64())], ["doc_id", "text_hash", "fp", "n"])


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # sets of this task's input only
    for b in batches:
        key, ref, info, size = [], [], [], 0
        for t in _texts(b, "text"):
            s = shingle_set(t)
            mixed = mix(s)
            fp = fingerprint(s, mixed)
            if len(s) == 0 or fp in seen:
                continue
            seen.add(fp)
            for lv, keys, drop in parts(s, mixed):
                key.append(keys)
                ref.append(np.full(len(keys), fp, np.int64))
                info.append(np.full(len(keys), drop * 64 + lv, np.int64))
                size += len(keys)
            if size > 500_000:
                yield _rows(key, ref, info)
                key, ref, info, size = [], [], [], 0
        if key:
            yield _rows(key, ref, info)


def _rows(key, ref, info) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_long(np.concatenate(key)), _long(np.concatenate(ref)),
                                       _long(np.concatenate(info))], ["key", "fp", "info"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, fp): those of keys with two texts or more, each
    text once, with their number. No more than POPULAR rows of a key wait."""
    held = np.zeros((0, 3), np.int64)  # the last key's rows so far
    flushed = None  # a key whose number is already POPULAR

    def out(rows, m):
        return pa.RecordBatch.from_arrays([_long(rows[:, i]) for i in range(3)] + [_long(m)],
                                          ["key", "fp", "info", "m"])

    def complete(rows):
        at = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
        m = np.repeat(np.diff(np.append(at, len(rows))), np.diff(np.append(at, len(rows))))
        m = np.minimum(m, POPULAR)
        if flushed is not None:
            m[rows[:, 0] == flushed] = POPULAR
        return rows[m > 1], m[m > 1]

    last = None  # (key, fp, info) of the last row of a flushed key
    for b in batches:
        rows = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if not len(rows):
            continue
        rows = np.concatenate((held, rows))
        same = np.concatenate(([last is not None and bool((rows[0] == last).all())],
                               (rows[1:] == rows[:-1]).all(axis=1)))
        rows, last = rows[~same], None
        if not len(rows):
            continue
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        if cut:
            yield out(*complete(rows[:cut]))
        held = rows[cut:]
        if len(held) >= POPULAR:
            yield out(held, np.full(len(held), POPULAR))
            flushed, last, held = int(held[0, 0]), held[-1], held[:0]
    if len(held):
        yield out(*complete(held))


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [(fingerprint(s), len(s), s.tobytes(), sketch(s)) for s in map(shingle_set, _texts(b, "text"))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(
            (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["fp", "n", "tokens", "sketch"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches are at most (n1 + n2) // 7 bits apart."""
    for b in batches:
        d = b.to_pydict()
        ok = [_apart(x, y) <= (m + n) // 7 for x, y, m, n in zip(d["sa"], d["sb"], d["na"], d["nb"])]
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = []
        for x, y in zip(b.column("ta"), b.column("tb")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * common >= 75 * (len(x) + len(y) - common))
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones of ``pairs`` (``a, b``: set fingerprints)."""
    small = sets.select("fp", "n", "sketch")
    p = pairs
    for side in "ab":
        p = p.join(small.select(F.col("fp").alias(side), F.col("n").alias(f"n{side}"),
                                F.col("sketch").alias(f"s{side}")), side)
    p = p.filter("4 * least(na, nb) >= 3 * greatest(na, nb)").mapInArrow(_near, "a long, b long")
    for side in "ab":
        p = p.join(sets.select(F.col("fp").alias(side), F.col("tokens").alias(f"t{side}")), side)
    return p.mapInArrow(_linked, "a long, b long")


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketch distance of each text and hub as a share of their sizes, of those
    within reach."""
    for b in batches:
        d = b.to_pydict()
        n = np.add(d["n"], d["nh"])
        apart = np.fromiter(map(_apart, d["sketch"], d["sh"]), np.int64, len(n))
        yield pa.RecordBatch.from_arrays([b.column("fp"), b.column("hub"), pa.array(apart / n, pa.float64())],
                                         ["fp", "hub", "far"]).filter(pa.array(apart <= n // 7, pa.bool_()))


def _star(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of each text with the ``NEAREST`` of the hubs of its STARS most
    frequent parts, by sketches. A part of m texts has about log2(m) hubs, at
    most ``HUBS``: the least member of some of its hash classes."""
    at = F.pmod(F.xxhash64("key", "fp"), F.lit(HUBS))
    hubs = (members.groupBy("key", at.alias("_at")).agg(F.min("fp").alias("_hub"), F.count(F.lit(1)).alias("_m"))
            .groupBy(F.col("key").alias("_k")).agg(F.sum("_m").alias("m"),
                                                   F.sort_array(F.collect_list(F.struct("_at", "_hub"))).alias("_hubs"))
            .select("_k", "m", F.slice(F.col("_hubs._hub"), 1, F.ceil(F.log2("m")).cast("int")).alias("_hubs")))
    w = Window.partitionBy("fp").orderBy(F.desc("m"), "key")
    d = members.join(hubs, F.col("key") == F.col("_k")).withColumn("_r", F.row_number().over(w))
    d = d.filter(f"_r <= {STARS}").select("fp", F.explode("_hubs").alias("hub")).filter("fp <> hub").distinct()
    small = sets.select("fp", "n", "sketch")
    d = d.join(small, "fp").join(small.select(F.col("fp").alias("hub"), F.col("n").alias("nh"),
                                              F.col("sketch").alias("sh")), "hub")
    d = d.filter("4 * least(n, nh) >= 3 * greatest(n, nh)").select("fp", "hub", "n", "nh", "sketch", "sh")
    near = F.row_number().over(Window.partitionBy("fp").orderBy("far", "hub"))
    d = d.mapInArrow(_distances, "fp long, hub long, far double").withColumn("_r", near).filter(f"_r <= {NEAREST}")
    return d.select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b")).distinct()


def _near_pairs(d: dict, x: np.ndarray, some: int | None) -> np.ndarray:
    """Open pairs (places) within reach of one meeting of blocks; with ``some``
    only so many of each two components, nearest first."""
    n, comp, own = d["n"], d["comp"], d["own"]
    first = np.flatnonzero(own == d["i"][0])
    second = first if d["i"][0] == d["j"][0] else np.flatnonzero(own == d["j"][0])
    out = []
    for p in first:
        q = second[(comp[second] != comp[p]) & (d["fp"][second] != d["fp"][p])]
        q = q[4 * np.minimum(n[q], n[p]) >= 3 * np.maximum(n[q], n[p])]
        apart = np.bitwise_count(x[q] ^ x[p]).sum(axis=1, dtype=np.int64)
        near = apart <= (n[q] + n[p]) // 7
        q, apart = q[near], apart[near]
        if some is not None and len(q) > some:  # of one component's texts the nearest to p
            order = np.lexsort((q, apart / (n[q] + n[p]), comp[q]))
            rank = np.arange(len(q)) - np.searchsorted(comp[q][order], comp[q][order])
            q, apart = q[order][rank < some], apart[order][rank < some]
        out.append(np.column_stack((np.full(len(q), p), q, (1 << 20) * apart // (n[q] + n[p]))))
    rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    if some is not None and len(rows):
        a, b = np.minimum(comp[rows[:, 0]], comp[rows[:, 1]]), np.maximum(comp[rows[:, 0]], comp[rows[:, 1]])
        order = np.lexsort((rows[:, 2], b, a))
        a, b = a[order], b[order]
        start = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
        rows = rows[order][rank < some]
    return rows[:, :2]


def _blocks(some: int | None):
    def run(table: pa.Table) -> pa.Table:
        d = {c: table.column(c).to_numpy() for c in ("fp", "comp", "n", "own", "i", "j")}
        raw = table.column("sketch").to_pylist()
        size = 8 * min(map(len, raw))
        p = _near_pairs(d, np.stack([_fold(v, size) for v in raw]), some)
        a, b = d["fp"][p[:, 0]], d["fp"][p[:, 1]]
        rows = np.unique(np.column_stack((np.minimum(a, b), np.maximum(a, b))), axis=0)
        return pa.table({"a": _long(rows[:, 0]), "b": _long(rows[:, 1])})
    return run


def _open_parts(members: DataFrame) -> DataFrame:
    """Parts whose texts lie in several components: ``_k``, number of texts
    ``m``, the largest component ``_main`` and its texts ``_inside``."""
    by_comp = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_n"))
    return (by_comp.groupBy(F.col("key").alias("_k")).agg(
        F.sum("_n").alias("m"), F.max(F.struct("_n", "comp")).alias("_top"), F.count(F.lit(1)).alias("_comps"))
        .filter("_comps > 1").select("_k", "m", F.col("_top._n").alias("_inside"), F.col("_top.comp").alias("_main")))


def _open_pairs(members: DataFrame, size: DataFrame, sets: DataFrame, some: int | None) -> DataFrame:
    """Pairs of texts that share an open part (``size``) and lie in different
    components; of larger parts only those whose sketches are near, and with
    ``some`` only so many of each two components in a meeting of blocks."""
    d = members.join(size, F.col("key") == F.col("_k")).drop("_k")
    few = d.filter(F.col("m") <= SMALL)
    other = few.select(F.col("key").alias("_k"), F.col("fp").alias("b"), F.col("comp").alias("_c"))
    pairs = few.join(other, (F.col("key") == F.col("_k")) & (F.col("fp") < F.col("b")) & (
        F.col("comp") != F.col("_c"))).select(F.col("fp").alias("a"), "b")
    # blocks 0 .. _in - 1 hold the largest component and do not meet one another
    count = lambda c: F.ceil(c / BLOCK).cast("long")
    d = d.filter(F.col("m") > SMALL).withColumns({"_in": count(F.col("_inside")), "_out": count(F.col("m") - F.col("_inside"))})
    inside, place = F.col("comp") == F.col("_main"), F.xxhash64("fp", "key")
    d = d.withColumn("own", F.when(inside, F.pmod(place, F.col("_in"))).otherwise(F.col("_in") + F.pmod(place, F.col("_out"))))
    last = F.col("_in") + F.col("_out") - 1
    d = d.withColumn("_j", F.explode(F.sequence(F.when(inside, F.col("_in")).otherwise(F.lit(0).cast("long")), last)))
    d = d.withColumns({"i": F.least("own", "_j"), "j": F.greatest("own", "_j")})
    d = d.join(sets.select(F.col("fp").alias("_fp"), "n", "sketch"), F.col("fp") == F.col("_fp"))
    near = d.select("key", "i", "j", "own", "fp", "comp", "n", "sketch").groupBy("key", "i", "j").applyInArrow(
        _blocks(some), "a long, b long")
    return pairs.unionByName(near).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """Written table ``doc_id, text_hash, fp, n``: a row for each row of docs."""
    return written(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _class_rows, docs.select("doc_id", F.lit(1).cast("long").alias("text_hash")).schema.add("fp", "long").add("n", "long")),
        "classes")


def near_duplicates(df: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, component`` for each row
    of ``df`` (doc_id, text; further columns are ignored).

    ``component_id``: least doc_id of the component (null ids only: null).
    Null or empty texts, or texts without words, have no shingles, are linked
    with nothing and have their own doc_id and a null ``component``. Repeated
    rows are copies of one another. No rows give no rows.
    """
    bounded_batches(df.sparkSession)
    docs = df.select("doc_id", "text")
    cls = classes(docs)
    keys = docs.select("text").mapInArrow(_part_rows, "key long, fp long, info long")
    shared = written(keys.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _shared, "key long, fp long, info long, m long"), "shared")
    rank = F.row_number().over(Window.partitionBy("fp", "info").orderBy(F.desc("m"), F.desc("key")))
    kept = shared.withColumn("_r", rank).filter("_r > shiftright(info, 6)").select("key", "fp")
    # a part with one text left has no pair
    two = kept.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(kept.join(two, F.col("key") == F.col("_k"), "left_semi"), "members")
    comps = None
    if not members.isEmpty():
        wanted = members.select("fp").distinct()
        one = (cls.join(wanted, "fp", "left_semi").groupBy("fp")
               .agg(F.min(F.struct("doc_id", "text_hash")).alias("s"))
               .select(F.col("s.doc_id").alias("_id"), F.col("s.text_hash").alias("_hash")))
        sets = written(docs.join(one, F.col("doc_id").eqNullSafe(F.col("_id")) & (
            F.xxhash64("text") == F.col("_hash")), "left_semi")
            .select("text").mapInArrow(_set_rows, "fp long, n long, tokens binary, sketch binary")
            .dropDuplicates(["fp"]), "sets")
        comps = components(written(verify(_star(members, sets), sets), "links"))
        for some in (NEAREST, None):
            held = members.join(comps.withColumnRenamed("v", "_v"), F.col("fp") == F.col("_v"), "left").select(
                "key", "fp", F.coalesce("comp", "fp").alias("comp"))
            sizes = written(_open_parts(held), "open")
            if sizes.isEmpty():
                break  # no open pairs
            if some and sizes.filter(F.col("m") > SMALL).isEmpty():
                continue  # no blocks: all open pairs are listed in one round
            comps = merged(comps, written(verify(_open_pairs(held, sizes, sets, some), sets), "links"))
    if comps is None:
        out = cls.withColumn("component", F.col("fp"))
    else:
        out = cls.join(comps.withColumnRenamed("v", "fp"), "fp", "left").withColumn(
            "component", F.coalesce("comp", "fp"))
    out = out.withColumn("component", F.when(F.col("n") > 0, F.col("component")))
    least = out.filter("n > 0").groupBy(F.col("component").alias("_c")).agg(F.min("doc_id").alias("_id"))
    return out.join(least, F.col("component") == F.col("_c"), "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_id")).otherwise(F.col("doc_id")).alias("component_id"), "component")


def one_of_each(df: DataFrame) -> DataFrame:
    """``df`` with one row of each component: that of the least doc_id (then
    text hash); all rows without words stay."""
    found = near_duplicates(df)
    stay = (found.filter("component is not null").groupBy("component")
            .agg(F.min(F.struct("doc_id", "text_hash")).alias("s")).select("s.*")
            .unionByName(found.filter("component is null").select("doc_id", "text_hash")).distinct())
    # the texts move once: plain keys, the same for the join and the window
    key = lambda h: [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.isnull("doc_id"), h]
    stay = stay.select(*[c.alias(f"_s{i}") for i, c in enumerate(key(F.col("text_hash")))])
    d = df.select(F.struct("*").alias("_row"), *[c.alias(f"_k{i}") for i, c in enumerate(key(F.xxhash64("text")))])
    d = d.join(stay, [F.col(f"_k{i}") == F.col(f"_s{i}") for i in range(3)], "left_semi")
    w = Window.partitionBy("_k0", "_k1", "_k2").orderBy("_k2")
    d = d.withColumn("_copy", F.when(F.col("_row.text").rlike(r"[^\x20\x09-\x0D]"), F.row_number().over(w)).otherwise(1))
    return d.filter("_copy = 1").select("_row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL7 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
    WHERE 100 * c >= 75 * (len(x.s) + len(y.s) - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(v, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.c FROM r JOIN e ON r.v = e.a WHERE r.c < e.b)
SELECT s.doc_id, len(s) AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT v, min(c) AS c FROM r GROUP BY v) m ON m.v = s.doc_id
"""
