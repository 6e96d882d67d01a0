"""Quality rules: references, both distances, limits and verdicts in plain
Python, and planted word lists and gibberish."""

import collections
import math

import numpy as np
import pytest
import regex

from skyscore.llm import quality
from skyscore.llm.quality import FIRST, SCRIPTS, Rules

SF = "/root/testdata/sf0.001"


def classes(t):
    out = [len(regex.findall(c, t)) for c in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[.,;:!?'\"()-]")]
    out.append(len(regex.findall(r"[\x21-\x7E]", t)) - sum(out))
    out.append(len(regex.findall(r"[\x20\x09-\x0D]", t)))
    rest = regex.sub(r"[\x00-\x7F]", "", t)
    scripts = [len(regex.findall(rf"\p{{Script={s}}}", rest)) for s in SCRIPTS]
    return [*out, *scripts, len(t) - sum(out) - sum(scripts)]


def distance(a, b):
    a, b = np.array(a, float), np.array(b, float)
    a, b = a / a.sum(), b / b.sum()
    m = (a + b) / 2
    return math.sqrt(max(0.0, sum(x * math.log2(x / y) for v in (a, b) for x, y in zip(v, m) if x > 0) / 2))


def script(c):
    n = [c[FIRST + i] + (c[0] + c[1] if i == 0 else 0) for i in range(len(SCRIPTS))]
    best = max(range(len(n)), key=lambda i: (n[i], i))
    return best if n[best] else None


def plain(docs, base, rules):
    """(char distance, word distance, limit, kept) of each document."""
    tokens = [[w for w in regex.split(r"[^\p{L}]+", (t or "").lower()) if w] for _, t, _ in docs]
    n_docs = collections.Counter(lang for *_, lang in docs if lang is not None)
    held = collections.defaultdict(collections.Counter)
    for (*_, lang), w in zip(docs, tokens):
        if lang is not None:
            held[lang].update(set(w))
    common = set()
    for lang, c in held.items():
        top = sorted(c, key=lambda w: (-c[w], w))[:rules.n_common]
        common |= {w for w in top if n_docs[lang] >= rules.min_docs and c[w] >= rules.common_share * n_docs[lang]}
    words = sorted(common)

    def histogram(w):
        c = collections.Counter(w)
        return [sum(n for x, n in c.items() if x not in common), *[c[x] for x in words]]

    cls, hist = [classes(t or "") for _, t, _ in docs], [histogram(w) for w in tokens]
    refs = {}
    for lang in n_docs:
        at = [i for i, d in enumerate(docs) if d[2] == lang and not base[i]]
        if len(at) >= rules.min_docs:
            refs[lang] = (np.sum([cls[i] for i in at], axis=0), np.sum([hist[i] for i in at], axis=0))
    char, word = [], []
    for (*_, lang), c, h in zip(docs, cls, hist):
        fit = [refs[lang]] if lang in refs else [r for r in refs.values() if script(r[0]) == script(c)]
        char.append(min((distance(c, r[0]) for r in fit), default=None) if sum(c) >= rules.min_chars else None)
        word.append(min((distance(h, r[1]) for r in fit), default=None) if sum(h) >= rules.min_letter_words else None)
    groups = collections.defaultdict(set)
    band = [int(math.log2(max(1, sum(h)))) for h in hist]
    for (*_, lang), b, x, bad in zip(docs, band, word, base):
        if lang is not None and x is not None and not bad:
            groups[lang, b].add(round(x, 9))
            groups[lang, -1].add(round(x, 9))
    fence = {}
    for (lang, b), xs in groups.items():
        if b == -1 or len(xs) >= rules.min_docs:
            lo, hi = (sorted(xs)[math.ceil(p * len(xs)) - 1] for p in (.25, .75))
            fence[lang, b] = hi + max(rules.margin, rules.fence * (hi - lo))
    most = {}
    for (_, b), x in fence.items():
        most[b] = max(x, most.get(b, 0))
    out = []
    for (*_, lang), b, c, w, bad in zip(docs, band, char, word, base):
        limit = fence.get((lang, b), fence.get((lang, -1), most.get(b, most.get(-1))))
        out.append((c, w, limit, not bad and not (c is not None and c > rules.max_char_distance)
                    and not (w is not None and limit is not None and w > limit)))
    return out


def compare(docs, got):
    want = plain(docs, [got[i]["base_failed"] for i, *_ in docs], Rules())
    for (i, *_), (c, w, limit, kept) in zip(docs, want):
        r = got[i]
        for name, x in (("char_distance", c), ("word_distance", w), ("word_limit", limit)):
            assert (r[name] is None) == (x is None) and (x is None or abs(r[name] - x) < 1e-6), (i, name)
        assert r["kept"] == kept, i


def test_verdicts_against_plain_python(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    compare([tuple(r) for r in rows], {r["doc_id"]: r for r in quality.op6(spark, SF).collect()})


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    frequent = {"en": "the of and to in is that it was for".split(), "xx": "ka lo mi nu pa re so ti va wo".split()}
    word = lambda: "".join(rng.choice(list("etaoinshrdlucm"), rng.integers(3, 9)))
    prose = lambda lang, n: " ".join(rng.choice(frequent[lang]) if rng.random() < .45 else word() for _ in range(n))
    rows = [(prose(lang, int(n)), lang) for lang in frequent for n in rng.integers(60, 700, 300)]
    rows[0] = (rows[0][0] + " \x02\x7f\x02 \u00a0\u4e2d", rows[0][1])
    clean = len(rows)
    rows += [(" ".join(word() for _ in range(300)), lang) for lang in ("en", "xx", None) for _ in range(5)]
    rows += [(" ".join(rng.choice(frequent["en"]) for _ in range(100)), "en") for _ in range(5)]
    rows += [(prose("xx", 300), "en") for _ in range(5)]
    docs = [(i, t, lang) for i, (t, lang) in enumerate(rows)] + [(None, None, None), (-1, "", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    return docs, clean, {r["doc_id"]: r for r in quality.judge(df).collect()}


def test_planted_lists_gibberish_and_stuffing_go(planted):
    docs, clean, got = planted
    kept = [got[i]["kept"] for i in range(clean)]
    assert sum(kept) / clean >= 0.98
    assert [i for i in range(clean, len(docs) - 2) if got[i]["kept"]] == []
    assert not any(got[i]["base_failed"] for i in range(clean, len(docs) - 2))


def test_planted_against_plain_python(planted):
    docs, _, got = planted
    compare(docs, got)


def test_one_text_that_most_rows_repeat(spark):
    """Copies count once for the limit, so the other documents stay."""
    rng = np.random.default_rng(2)
    prose = lambda: " ".join(rng.choice(["the", "of", "and"]) if rng.random() < .4 else
                             "".join(rng.choice(list("etaoinshr"), 6)) for _ in range(200))
    one = prose()
    rows = [(i, one if i < 200 else prose(), "en") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert quality.judge(df).filter("not kept").count() <= 4
