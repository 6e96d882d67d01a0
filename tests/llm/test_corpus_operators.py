"""The corpus operators against brute force, round trips and edge cases."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from skyscore.llm import chat, decontaminate, jaccard, langid, licence, lm, pack, quality, shard, urls
from skyscore.llm.components import components

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000 + "end"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing column names."""
    rows = [(1, None, "en", 1), (2, "", None, 2), (3, LONG, "en", 3), (4, "a b c", "en", 4), (4, "a b c", "en", 4),
            (None, "lonely words here", None, 5), (6, "   \n ", "de", 6), (7, "1234 !!", "fr", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long").withColumns(
        {c: F.lit("x") for c in ("spans", "unit", "key", "fp", "score", "lang_pred", "source", "_row", "_hash")})


def empty(df):
    return df.filter("false")


def test_chat_round_trip_and_machine(spark):
    rows = [(1, 1, "assistant", "b\\|<|im_end|>"), (1, 0, "user", None), (2, 0, "assistant", "first"),
            (3, 0, "a\nb\\n", "x\ny"), (None, 0, "user", ""), (4, None, None, None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = {r["conv_id"]: r for r in chat.format_chat(df).withColumn("back", chat.read_turns(F.col("formatted"))).collect()}
    assert [tuple(t) for t in out[1]["back"]] == [("user", ""), ("assistant", "b\\|<|im_end|>")]
    assert [tuple(t) for t in out[3]["back"]] == [("a\nb\\n", "x\ny")]
    assert len(out[4]["back"]) == 2 and out[None]["valid"] and out[1]["valid"]
    assert not out[2]["valid"] and not out[3]["valid"]
    assert "".join(s["text"] for s in out[1]["segments"]) == out[1]["formatted"]
    assert chat.format_chat(empty(df)).count() == 0


@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2)])
def test_hilbert_curve_is_a_walk(spark, n, bits):
    side = 1 << bits
    df = spark.range(side ** n).select(*[F.expr(f"id div {side ** i} % {side}").alias(f"d{i}") for i in range(n)])
    rows = sorted(df.withColumn("h", shard.hilbert_index([F.col(f"d{i}") for i in range(n)], bits)).collect(),
                  key=lambda r: r["h"])
    assert [r["h"] for r in rows] == list(range(side ** n))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[i] - b[i]) for i in range(n)) == 1


def test_shards_are_even_gapless_and_ordered(spark, odd):
    out = shard.op2(spark, SF).toPandas()
    counts = out.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(counts) == 8
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    assert out.sort_values(["shard", "slot"]).curve.is_monotonic_increasing
    d = odd.withColumn("size", F.length("text"))
    assert shard.shard(d, ["lang", "source", "size"], 3, ["doc_id"]).groupBy("shard").count().count() == 3
    assert shard.shard(empty(d), ["lang", "size"], 3, ["doc_id"]).count() == 0


def test_shards_prune_on_every_dimension(spark):
    """Zone maps of the shards skip more, over filters on each of the three
    dimensions, than those of a sort on one; steps rise with the values."""
    d = spark.range(6000).select(
        "id", F.expr("concat('src', lpad(pmod(xxhash64(id, 1), 40), 2, '0'))").alias("source"),
        F.expr("case when pmod(xxhash64(id, 2), 3) = 0 then 'en' else concat('l', pmod(xxhash64(id, 3), 9)) end").alias("lang"),
        F.expr("pmod(xxhash64(id, 4), 5000)").alias("size"))
    dims = ["source", "lang", "size"]
    at = {c: i for c, i in zip(dims, shard.quantise(d, dims))}
    for c in dims:
        steps = d.select(c, at[c].alias("s")).distinct().orderBy(c).collect()
        assert [r["s"] for r in steps] == sorted(r["s"] for r in steps) and 4 <= len({r["s"] for r in steps}) <= 16

    def read(sharded):
        z = shard.shard_ranges(sharded, dims).collect()
        values = {c: [r[0] for r in d.select(c).distinct().collect()] for c in dims}
        return {c: sum(r[f"min_{c}"] <= v <= r[f"max_{c}"] for v in values[c] for r in z) / len(values[c]) for c in dims}

    mine = read(shard.shard(d, dims, 64, ["id"]))
    plain = read(d.withColumn("shard", F.expr("ntile(64) over (order by source, id) - 1")))
    assert max(mine.values()) < 40 and max(plain.values()) > 60 and sum(mine.values()) < 0.7 * sum(plain.values())


def test_cuts_of_a_hot_value_and_of_other_types(spark):
    d = spark.range(900).select(F.expr("if(id < 600, 'b', concat('c', id))").alias("s"),
                                F.expr("if(id % 2 = 0, null, date_add(date'2020-01-01', int(id)))").alias("t"),
                                F.expr("array(id % 3)").alias("a"))
    for c in ("s", "t", "a"):
        cells = {r[0] for r in d.select(shard.quantise(d, [c], 2)[0]).distinct().collect()}
        assert cells <= {0, 1, 2, 3} and len(cells) >= 2
    assert shard.value_cuts(d, "s", 4)[-1] > "b" and shard.value_cuts(empty(d), "s", 4) == []


def test_licence_dice(spark, odd):
    text = "hello there\nReleased under the MIT license\n\nReleased\nunder the MIT License.\n"
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licence.scan(df).collect()}
    # lines 1, 2, 4 (of "under the MIT License." three bigrams of four), paragraphs 1 and 2
    assert [(m["unit"], m["licence"], round(m["dice"], 3)) for m in rows[1]["matches"]] == [
        (1, "MIT", 1.0), (3, "MIT", 0.857), (4, "MIT", 0.8), (5, "MIT", 1.0)]
    assert rows[2]["n_units"] == 0 and rows[2]["matches"] == []
    assert licence.scan(odd).count() == 8 and licence.scan(empty(odd)).count() == 0


def test_url_trie_equals_join(spark):
    rules = [*urls.RULES, ("net", "/a", "allow"), ("b.net", "/", "allow"), ("", "/", "block"), ("b.net", "/", "block")]
    hosts = ["net", "x.net", "B.NET", "c.b.net", "xb.net", "example.com", "w.example.net:80", "", "org"]
    paths = ["", "/", "/a", "/ab/c", "/en/1", "/en", "/de/", "/fr/x?q=/", "#/a"]
    rows = [(f"http://{h}{p}",) for h in hosts for p in paths] + [(None,), ("no scheme",), ("http://net/",)]
    df = spark.createDataFrame(rows, "url string").withColumn("rule", F.lit("old"))
    a = urls.judge(df, rules)
    b = urls.judge_by_join(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    key = ["url", "host", "path", "rule", "verdict"]
    assert collections.Counter(map(tuple, a.select(key).collect())) == collections.Counter(map(tuple, b.select(key).collect()))
    assert urls.judge(df, []).filter("verdict <> 'allow' or rule is not null").count() == 0
    for r in a.collect():
        fit = [(len(h) + len(p), v, h + p) for h, p, v in rules
               if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        assert (r["verdict"], r["rule"]) == (max(fit)[1:] if fit else ("allow", None))


def base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_quality_against_brute_force(spark, docs, odd):
    out = {r["doc_id"]: r for r in quality.op6(spark, SF).collect()}
    for i, text, _ in docs:
        r = out[i]
        assert tuple(r)[1:6] == base(text)
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and not (r["base_failed"] and r["kept"])
    rows = quality.judge(odd).collect()
    assert len(rows) == 8 and {r["doc_id"]: r["n_words"] for r in rows}[3] == 30_001
    assert quality.judge(empty(odd)).count() == 0
    assert quality.good(odd).columns == odd.columns


def test_distance_is_jensen_shannon(spark):
    p, q = np.array([3, 1, 0, 0, 0, 2, 0]) / 6, np.array([1, 1, 1, 0, 0, 1, 0]) / 4
    m = (p + q) / 2
    want = sum(x * np.log2(x / y) for a in (p, q) for x, y in zip(a, m) if x > 0) / 2
    df = spark.createDataFrame([([3, 1, 0, 0, 0, 2, 0], [(1 << 40) + 3, (2 << 40) + 1])], "cls array<long>, hits array<long>")
    char, word = quality.distances([("en", q.tolist(), {1: 0.5, 3: 0.5})])
    r = df.select(char.alias("c"), word.alias("w")).first()
    a, b = np.array([.75, .25, 0]), np.array([.5, 0, .5])
    m = (a + b) / 2
    ww = sum(x * np.log2(x / y) for v in (a, b) for x, y in zip(v, m) if x > 0) / 2
    assert abs(r["c"] - want ** 0.5) < 1e-9 and abs(r["w"] - ww ** 0.5) < 1e-9


def test_jaccard_against_all_pairs(spark, odd):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for size in (6, 12, 30, 200):
        for _ in range(4):
            w = [f"w{x}" for x in rng.integers(0, 500, size)]
            for k in range(8):
                v = list(w)
                for j in rng.integers(0, size, k * size // 60):
                    v[j] = f"z{rng.integers(0, 9)}"
                rows.append((n, " ".join(v)))
                n += 1
    rows += [(n, rows[5][1]), (n + 1, rows[5][1].upper()), (n + 2, ""), (n + 3, None), (n + 4, " \n")]
    got = {r["doc_id"]: r for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = {k: min(a, b) if c in (a, b) else c for k, c in comp.items()}
    for i in sets:
        assert got[i]["n_shingles"] == len(sets[i])
        assert got[i]["component_id"] == comp[i], i
    one = jaccard.one_of_each(odd)
    assert one.columns == odd.columns and sorted(map(str, (r[0] for r in one.select("doc_id").collect()))) == [
        "1", "2", "3", "4", "6", "7", "None"]
    assert jaccard.near_duplicates(empty(odd)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 40)], "a long, b long")
    got = {r["v"]: r["comp"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 50: 40}


def test_further_links_join_components_without_the_old_ones(spark, monkeypatch):
    from skyscore.llm import components as module

    old = [(i, i + 1) for i in range(100, 140)] + [(200 + i, 200) for i in range(1, 30)] + [(7, 8)]
    new = [(205, 120), (300, 8), (300, 301), (1, 400), (140, 205)]
    comps = components(spark.createDataFrame(old, "a long, b long"))
    sizes, plain = [], module.written
    monkeypatch.setattr(module, "written", lambda df, label: (sizes.append((label, df.count())), plain(df, label))[1])
    more = spark.createDataFrame(new, "a long, b long")
    got = sorted(tuple(r) for r in module.merged(comps, more).collect())
    # only the new links go through the steps
    assert max(n for label, n in sizes if label == "edges") <= len(new)
    monkeypatch.undo()
    assert got == sorted(tuple(r) for r in components(spark.createDataFrame(old + new, "a long, b long")).collect())
    assert module.merged(comps, more.limit(0)) is comps


def test_sketch_bounds_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, 80).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate((a[:60], rng.integers(0, 1 << 63, 30).astype(np.uint64))))
        assert jaccard._apart(jaccard.sketch(a), jaccard.sketch(b)) <= len(np.setxor1d(a, b))


def test_decontaminate_edges_and_blocks(spark, odd, monkeypatch):
    items = spark.createDataFrame([(1, "a b"), (2, None), (3, "..."), (None, "lonely words"), (10, "B, C"), (2, "A b")],
                                  "item_id long, text string")
    want = {4: {(0, 2, "1"), (0, 2, "2"), (1, 2, "10")}}
    for most in (1_000_000, 1):
        monkeypatch.setattr(decontaminate, "MAX_WINDOWS", most)
        for r in decontaminate.mark(odd, items).collect():
            assert {tuple(s) for s in r["spans"]} == want.get(r["doc_id"], set())
    assert decontaminate.clean(odd, items).count() == 6
    assert decontaminate.clean(odd, empty(items)).columns == odd.columns
    assert decontaminate.mark(empty(odd), items).count() == 0


def test_windows_index_against_every_place(spark):
    """Windows of all sizes, some sharing their shingles; one window in 20,000 items."""
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    raw = sorted({words[rng.integers(0, 12, n)].tobytes() for n in range(1, 11) for _ in range(30)})
    ids = np.arange(len(raw), dtype=np.int64)
    doc = words[rng.integers(0, 12, 3000)]
    for x in raw[::3]:
        at = int(rng.integers(0, 2900))
        doc[at:at + len(x) // 8] = np.frombuffer(x, np.uint64)
    shingles = decontaminate._item_shingles(raw)
    ix = decontaminate.Index(raw, ids, shingles, rng.integers(0, 5, len(shingles)))
    want = sorted((a, len(x) // 8, i) for i, x in enumerate(raw) for a in range(len(doc) - len(x) // 8 + 1)
                  if doc[a:a + len(x) // 8].tobytes() == x)
    assert ix.spans(doc) == want and len(want) > 100
    assert ix.spans(doc[:0]) == [] and decontaminate.Index([], ids[:0], shingles[:0], ids[:0]).spans(doc) == []
    items = spark.range(20_000).select(F.col("id").alias("item_id"), F.lit("One and the same two").alias("text"))
    d = spark.createDataFrame([(1, "x one and the same two y"), (2, "one and the same")], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in decontaminate.mark(d, items).collect()}
    assert len(got[1]) == 20_000 and {(s["start"], s["words"]) for s in got[1]} == {(1, 5)} and got[2] == []


def test_language_held_out_accuracy(spark, docs, odd):
    got = {r["doc_id"]: r for r in langid.op9(spark, SF).collect()}
    out = [(got[i]["lang_pred"], lang) for i, _, lang in docs if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in docs)
    assert sum(a == b for a, b in out) / len(out) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    model = langid.train(empty(odd))
    assert {tuple(r) for r in langid.predict(odd, model).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert langid.known(odd).columns == odd.columns
    assert "7" not in {str(r["doc_id"]) for r in langid.known(odd).collect()}


def test_lm_scores_every_token(spark, docs, odd):
    got = {r["doc_id"]: r for r in lm.op10(spark, SF).collect()}
    assert list(next(iter(got.values())).asDict()) == ["doc_id", "score", "pll", "n_tokens"]
    ids = {i: encode_all([t])[0] for i, t, _ in docs[:40]}
    assert all(got[i]["n_tokens"] == len(x) for i, x in ids.items())
    assert all(r["score"] is None if not r["n_tokens"] else abs(r["pll"] / r["n_tokens"] - r["score"]) < 1e-9 for r in got.values())


def test_character_table(spark, docs, odd):
    code = np.concatenate([lm.codes(lm.tokens(t)) for _, t, _ in docs])
    u, n = np.unique(code, return_counts=True)
    log_p = lm.train(u, n)
    assert np.allclose(np.exp(log_p).sum(axis=2), 1, atol=1e-4)
    some = spark.createDataFrame([(i, t) for i, t, _ in docs[:20]], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score(some, log_p).collect()}
    for i, t, _ in docs[:20]:
        x = [lm.EDGE, *lm.tokens(t).tolist(), lm.EDGE]
        want = sum(float(log_p[x[k - 1], x[k + 1], x[k]]) for k in range(1, len(x) - 1))
        assert got[i]["n_tokens"] == len(t) and abs(got[i]["pll"] - want) < 1e-3 * abs(want)
    rows = lm.score(odd, log_p).collect()
    assert len(rows) == 8 and [r["pll"] for r in rows if r["doc_id"] in (1, 2)] == [0.0, 0.0]
    assert len(lm.counts(empty(odd))[0]) == 0


def encode_all(texts):
    from skyscore.llm.tokenise import encoder
    return list(encoder(pack.tokenizer_path()).encode(texts))


def test_many_languages(spark):
    """More languages than any earlier limit; each has letters of its own."""
    word = lambda k, i: "".join(chr(0x4E00 + 20 * k + (i * j) % 20) for j in range(1, 9))
    rows = [(i * 700 + k, " ".join([word(k, i), word(k, i + 1)]), f"l{k:03}") for k in range(700) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert len(model.langs) > 500 and model.weights.shape[0] < langid.DIMS
    got = langid.predict(df.limit(50), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) > 25


def test_tokeniser_equals_the_library():
    from skyscore.llm.tokenise import SAFE, Encoder
    e = Encoder(pack.tokenizer_path())
    rng = np.random.default_rng(5)
    odd = ["'", "'s", "'re", "'S", "!'s", " ", "\n", "a", "b1", "'ll", "é", "²", "\x1c", "\x85", "İ", "Σ", "中", "<|endoftext|>"]
    texts = ["".join(rng.choice(odd, 12)) for _ in range(400)] + [f"a{chr(i)}b {chr(i)}{chr(i)}" for i in range(SAFE)]
    for t, ids in zip(texts, e.encode(texts)):
        assert ids.tolist() == e.whole.encode(t, add_special_tokens=False).ids, t


def test_packing_round_trip(spark, docs, odd):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(pack.tokenizer_path())
    p = pack.pack(spark.createDataFrame(docs, "doc_id long, text string, lang string"), pack.tokenizer_path(), True)
    rows = p.toPandas()
    for i, g in rows.sort_values("start").groupby("doc_id"):
        ids = np.array(tok.encode(docs[i][1], add_special_tokens=False).ids + [1], "<u4")
        assert b"".join(map(bytes, g.ids)) == ids.tobytes() and (g.doc_tokens == len(ids)).all()
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in g.itertuples())
    q = rows.sort_values(["sequence_id", "offset"])
    for _, g in q.groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
    assert rows.length.sum() / (rows.sequence_id.nunique() * 2048) > 0.97
    s = pack.sequences(p).toPandas()
    assert all(len(x) == 2048 or len(x) & (len(x) - 1) == 0 for x in s.ids)
    small = pack.pack(odd, pack.tokenizer_path()).toPandas()
    assert (small[small.doc_id.isin([1, 2, 6])].length == 1).all() and (small.doc_id == 4).sum() == 2
    assert pack.pack(empty(odd), pack.tokenizer_path()).count() == 0


def test_hot_length_is_cut():
    plan, cut = pack.solve({150: 1000, 20: 30})
    assert cut and sum(n * len(u) for u, n in plan + cut) == 1030
    parts = pack.solve_parts(cut)
    assert sum(n for _, n in parts) <= sum(n * sum(u) for u, n in cut) / 256 * 1.05 + 2
    a = np.array([[2.0, 1, 0], [0, 1, 2]])
    x = pack.nnls(a, np.array([3.0, 1]))
    assert (x >= 0).all() and np.allclose(a @ x, [3, 1])


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        after = after.cache()
        assert 0 < after.count() <= docs.count(), name
        assert stage(spark, docs.filter("false"), SF).count() == 0, name
        docs = after
    assert {r["doc_id"] for r in E.queries()["pipeline"](spark, SF).select("doc_id").collect()} == {
        r["doc_id"] for r in docs.select("doc_id").collect()}


def test_part_rows_mix_a_set_once(monkeypatch):
    """The parts of all levels and the fingerprint share one mix of the set, and
    are those of the plain formulas."""
    import pyarrow as pa

    from skyscore.llm import common, jaccard
    mixed = []
    monkeypatch.setattr(jaccard, "mix", lambda x: mixed.append(len(x)) or common.mix(x))
    texts = [" ".join(f"w{k * j % 91}" for j in range(200)) for k in (1, 2, 3)] + ["a b", "", None, " \t"]
    sets = [jaccard.shingle_set(t and t.encode()) for t in texts]
    for s in sets:
        assert (s == np.unique(s)).all()
    whole = [len(s) for s in sets if len(s) > 10]
    rows = [r for b in jaccard._part_rows(iter([pa.record_batch({"text": pa.array(texts, pa.string())})])) for r in b.to_pylist()]
    assert sum(n in whole for n in mixed) <= len(whole) + sum(n in whole for n in (len(p[1]) for s in sets if len(s) for p in jaccard.parts(s)))
    plain = []
    for s in sets:
        if len(s):
            h = common.mix(s)
            with np.errstate(over="ignore"):
                x = np.bitwise_xor.reduce(h) + np.add.reduce(s) + np.uint64(len(s))
            fp = int(common.mix(np.array([x])).astype(np.int64)[0])
            plain += [(int(np.int64(k)), fp, d * 64 + lv) for lv, keys, d in jaccard.parts(s) for k in keys.astype(np.int64)]
    assert [(r["key"], r["fp"], r["info"]) for r in rows] == plain
