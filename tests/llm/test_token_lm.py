"""The token network of op10: window, vocabulary and scripts."""

import itertools

import numpy as np

from skyscore.llm import pack, token_lm


def rows_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return token_lm.with_ids(df, pack.tokenizer_path())


def test_window_reaches_beyond_the_neighbours(spark):
    rng = np.random.default_rng(2)
    names, things = ["red", "blue", "green", "black"], ["house", "water", "music", "paper"]
    # the word three places on follows from the first
    line = lambda i: f"{names[i]} is the {things[i]} ."
    train = [" ".join(line(i) for i in rng.integers(0, 4, 120)) for _ in range(150)]
    model = token_lm.train(rows_of(spark, train).cache())
    right = " ".join(line(i) for i in (0, 1, 2, 3) * 6)
    wrong = right.replace("house", "x").replace("water", "house").replace("x", "water")
    shuffled = " ".join(rng.permutation(right.split()))
    got = [r["mean_bpe_pll"] for r in token_lm.score(rows_of(spark, [right, wrong, shuffled, "", None]), model)
           .orderBy("doc_id").collect()]
    assert got[0] > got[1] + 0.2 and got[0] > got[2] + 0.5 and got[3:] == [None, None]


def test_probabilities_sum_to_one_and_vocabulary_grows(spark):
    rows = rows_of(spark, ["a b c a b", "Хорошо там", "你好 世界", None]).cache()
    ids, n = token_lm.vocabulary(rows)
    assert n.sum() == sum(len(r["_ids"]) // 4 for r in rows.collect())
    assert len(ids) > len(token_lm.vocabulary(rows.filter("doc_id = 0"))[0])
    model = token_lm.train(rows)
    before, after = ids[:1].astype("<u4").tobytes(), ids[1:2].astype("<u4").tobytes()
    unseen = np.array([ids.max() + 5], "<u4")
    every = [before + np.array([i], "<u4").tobytes() + after for i in itertools.chain(ids, unseen)]
    place = []
    for doc in every:
        seq, _ = model.sequence([doc])
        h = model.hidden(seq)[1][1:2]
        rank = seq[token_lm.SIDE + 1:token_lm.SIDE + 2]
        place.append(np.prod([model._shares(node, h)[c[0], 0] for node, _, c in model.walk(rank)]))
    assert abs(sum(place) - 1) < 1e-3


def test_equal_remainders_are_told_apart(spark):
    train = ["你好 世界 " * 40] * 20
    model = token_lm.train(rows_of(spark, train).cache())
    other = "".join(chr(ord(c) + 31) if c != " " else c for c in train[0])
    a, b = [r["mean_bpe_pll"] for r in token_lm.score(rows_of(spark, [train[0], other]), model).orderBy("doc_id").collect()]
    assert a > b + 0.5


def _plain_log_p(model, ids):
    """The network's formula token by token, without pieces, order or batches."""
    emb, w = model.parts[0].astype(float), model.parts[1].reshape(2 * token_lm.SIDE, token_lm.DIM).astype(float)
    b, total = model.base, 0.0
    rank = [model.ranks[i] if i < len(model.ranks) else model.unknown for i in ids]
    line = [model.edge] * token_lm.SIDE + rank + [model.edge] * token_lm.SIDE
    for k, r in enumerate(rank):
        window = line[k:k + token_lm.SIDE] + line[k + token_lm.SIDE + 1:k + 2 * token_lm.SIDE + 1]
        h = np.tanh(sum(emb[t] * w[j] for j, t in enumerate(window)))
        for node, child in ((0, r // (b * b)), (1 + r // (b * b), r // b % b), (1 + b + r // b, r % b)):
            z = model.parts[2][node].reshape(b, token_lm.DIM).astype(float) @ h + model.parts[3][node]
            total += z[child] - np.log(np.exp(z).sum())
    return total


def test_scores_and_one_step_against_plain_versions(spark):
    texts = ["a b c a b d e", "Хорошо там", "the water and the house", "x"]
    rows = rows_of(spark, texts * 8).cache()
    model = token_lm.train(rows)
    docs = [r["_ids"] for r in rows.orderBy("doc_id").limit(4).collect()]
    want = [_plain_log_p(model, np.frombuffer(d, "<u4").tolist()) for d in docs]
    assert np.allclose(model.log_p([bytes(d) for d in docs]), want, rtol=1e-4)
    # one minibatch: the step of Adagrad has the sign of the numerical gradient of the mean loss
    import copy
    start = token_lm.Model(*token_lm.vocabulary(rows))
    start.steps, start.seen = 0, [np.zeros_like(p) for p in start.parts]
    start.used = [np.zeros(len(p), np.float32) for p in start.parts]
    rng = np.random.default_rng(0)
    start.parts[2] = rng.normal(0, 0.5, start.parts[2].shape).astype(np.float32)
    moved = copy.copy(start)
    moved.parts, moved.seen = [p.copy() for p in start.parts], [np.zeros_like(p) for p in start.parts]
    doc = bytes(docs[0])
    moved.learn([doc])
    for part, index in ((0, (0, 3)), (0, (1, 5)), (1, (0, 7)), (1, (0, 40)), (2, (0, 2)), (3, (0, 0))):
        loss = []
        for eps in (1e-2, -1e-2):
            near = copy.copy(start)
            near.parts = [p.copy() for p in start.parts]
            near.parts[part][index] += eps
            loss.append(-_plain_log_p(near, np.frombuffer(doc, "<u4").tolist()))
        slope, change = loss[0] - loss[1], moved.parts[part][index] - start.parts[part][index]
        if abs(slope) > 1e-4:
            assert np.sign(change) == -np.sign(slope), (part, index)


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 40_000), (4, "a b"), (4, "a b")], "doc_id long, text string")
    from pyspark.sql import functions as F
    odd = df.withColumns({c: F.lit("x") for c in ("n_bpe", "_ids", "bpe_pll", "mean_bpe_pll", "at", "part", "salt")})
    rows = token_lm.with_ids(odd, pack.tokenizer_path())
    got = token_lm.score(rows, token_lm.train(rows)).orderBy("doc_id").collect()
    assert [r["n_bpe"] > 0 for r in got] == [False, False, True, True, True]
    assert [r["mean_bpe_pll"] for r in got[:2]] == [None, None] and got[3]["bpe_pll"] == got[4]["bpe_pll"]
    none = token_lm.with_ids(odd.filter("false"), pack.tokenizer_path())
    assert token_lm.score(none, token_lm.train(none)).count() == 0


def _texts_of_many_places():
    rng = np.random.default_rng(5)
    words = np.array(["the", "of", "water", "house", "red", "green", "music", "paper", "7", "x", "там", "."])
    return [" ".join(rng.choice(words, 4000, p=np.arange(12, 0, -1) / 78)) for _ in range(12)]


def test_a_node_of_many_places_is_worked_on_in_parts(spark):
    rows = rows_of(spark, _texts_of_many_places()).cache()
    model = token_lm.train(rows)
    docs = [bytes(r["_ids"]) for r in rows.orderBy("doc_id").collect()]
    seq, _ = model.sequence(docs)
    part, at = next(model.pieces(seq, lambda: token_lm.SCORED))
    rank = part[token_lm.SIDE + at]
    seen = np.zeros((3, len(rank)), int)
    for node, a, b, where in model.visits(rank):
        assert 0 < b - a <= token_lm.STRETCH
        lv = 0 if node == 0 else 1 if node <= model.base else 2
        assert (where % (b - a) == np.arange(b - a)).all()
        seen[lv, a:b] += 1
        taken = node - (0, 1, 1 + model.base)[lv]
        assert ((taken * model.base + where // (b - a)) == rank[a:b] // model.base ** (2 - lv)).all()
    assert (seen == 1).all() and len(rank) > 2 * token_lm.STRETCH
    want = [_plain_log_p(model, np.frombuffer(d, "<u4").tolist()) for d in docs[:2]]
    assert np.allclose(model.log_p(docs)[:2], want, rtol=1e-4)


def test_wide_weights_do_not_overflow(spark):
    rows = rows_of(spark, ["a b c a b d e", "the water and the house"] * 4).cache()
    model = token_lm.train(rows)
    model.parts[2] = np.random.default_rng(3).normal(0, 12, model.parts[2].shape).astype(np.float32)
    assert not all(model.whole()[1])
    docs = [bytes(r["_ids"]) for r in rows.orderBy("doc_id").limit(2).collect()]
    want = [_plain_log_p(model, np.frombuffer(d, "<u4").tolist()) for d in docs]
    got = np.array(model.log_p(docs))
    # a share counts as 1e-30 at least
    assert np.isfinite(got).all() and (got >= np.array(want) - 1e-2).all()
    model.parts[2] /= 6
    want = [_plain_log_p(model, np.frombuffer(d, "<u4").tolist()) for d in docs]
    assert np.allclose(model.log_p(docs), want, rtol=1e-3)


def _fresh(size, seed=4):
    """An untrained network of ``size`` tokens with weights of every node, ready to learn."""
    rng = np.random.default_rng(seed)
    model = token_lm.Model(np.arange(size), np.sort(rng.integers(1, 1000, size))[::-1])
    model.parts[2] = rng.normal(0, 0.3, model.parts[2].shape).astype(np.float32)
    model.steps, model.seen = 0, [np.zeros_like(p) for p in model.parts]
    model.used = [np.zeros(len(p), np.float32) for p in model.parts]
    return model


def _skewed(n, size, seed=6):
    """Few tokens often, most of the ``size`` once or twice, one never seen."""
    rng = np.random.default_rng(seed)
    return np.append((size * rng.random(n) ** 5).astype("<u4"), np.array([size + 9], "<u4"))


def test_nodes_of_few_places_are_worked_on_together(monkeypatch):
    model, doc = _fresh(4000), _skewed(8000, 4000).tobytes()
    part, at = next(model.pieces(model.sequence([doc])[0]))
    visited = sum(1 for _ in model.visits(part[token_lm.SIDE + at]))
    calls, powers = [], token_lm.Model._powers
    monkeypatch.setattr(token_lm.Model, "_powers", staticmethod(lambda *a: calls.append(1) or powers(*a)))
    got = model.log_p([doc])[0]
    assert visited > 150 and len(calls) < visited / 3
    assert np.isclose(got, _plain_log_p(model, np.frombuffer(doc, "<u4").tolist()), rtol=1e-4)
    calls.clear()
    monkeypatch.setattr(token_lm.Model, "growing", lambda self: token_lm.PIECE)  # one minibatch
    model.learn([doc])
    assert len(calls) < visited / 3


def test_one_minibatch_has_the_plain_gradient():
    model, side, dim = _fresh(700), token_lm.SIDE, token_lm.DIM
    docs = [_skewed(500, 700, 1), _skewed(1, 700, 2)[:1], _skewed(460, 700, 3)]
    parts, b = [p.astype(float) for p in model.parts], model.base
    want, used = [np.zeros_like(p) for p in parts], [np.zeros(len(p)) for p in parts]
    seq, size = model.sequence([d.tobytes() for d in docs])
    for k in np.flatnonzero(seq != model.edge):
        r, near = seq[k], np.delete(seq[k - side:k + side + 1], side)
        w = parts[1].reshape(2 * side, dim)
        h, dh = np.tanh((parts[0][near] * w).sum(axis=0)), np.zeros(dim)
        for node, child in ((0, r // (b * b)), (1 + r // (b * b), r // b % b), (1 + b + r // b, r % b)):
            v = parts[2][node].reshape(b, dim)
            p = np.exp(v @ h + parts[3][node])
            p /= p.sum()
            p[child] -= 1
            dh += p @ v
            want[2][node] += np.outer(p, h).reshape(-1)
            want[3][node] += p
            used[2][node] += 1
        dh *= 1 - h * h
        np.add.at(want[0], near, dh * w)
        want[1] += (dh * parts[0][near]).reshape(1, -1)
    used[0], used[1] = np.bincount(seq, minlength=len(parts[0])), size.sum()
    model.learn([d.tobytes() for d in docs])
    # after one step Adagrad holds the squares
    for i in range(4):
        slope = want[i] / size.sum()
        assert np.allclose(np.sqrt(model.seen[i]), abs(slope), rtol=2e-3, atol=2e-6), i
        clear = abs(slope) > 1e-4
        assert clear.any() and (np.sign(model.parts[i] - parts[i])[clear] == -np.sign(slope)[clear]).all()
    for i in range(3):
        assert (model.used[i] == used[i]).all(), i
