"""Quality rules: word and repetition statistics of whole texts, and the
Jensen-Shannon distance of character-class and common-word histograms to
language references taken from the corpus. DataFrame functions only.

A first pass counts, per language, the documents that hold a word; the words of
most documents are its common words. The features of a document are small and
made in a second pass over its text; they are written once, the references (a
few hundred numbers a language) are summed from them over all documents, and the
verdict is arithmetic on the features. The limit of the word distance comes from
the distances of all documents of the language and about the same length, whose
histograms are as noisy.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, let, table, written

SYMBOLS = "#*$%&|<>"
#: characters outside each class; what is left counts: A-Z, digits, punctuation,
#: other visible ASCII but letters, control characters but blanks
CLASSES = [r"[^A-Z]+", r"[^0-9]+", r"[^.,;:!?'\"()-]+", r"[^#$%&*+/<=>@\[\\\]^_`{|}~]+",
           r"[^\x00-\x08\x0E-\x1F\x7F]+"]
#: scripts of the letters beyond ASCII, each a class
SCRIPTS = ["Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Thai", "Han", "Hiragana", "Katakana",
           "Hangul"]
#: places in ``cls``: letters a-z and A-Z, then digits, punctuation, symbols, blanks; scripts; the rest
FIRST = 6


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: greatest Jensen-Shannon distance (square root of the divergence in bits)
    max_char_distance: float = 0.25
    #: the word distance may lie ``fence`` times the quartiles' distance, and
    #: must lie ``margin``, above the upper quartile of its language and length
    fence: float = 2.0
    margin: float = 0.05
    #: guards: a histogram of fewer entries is not judged
    min_chars: int = 200
    min_letter_words: int = 50
    #: common words of a language: most documents first, a share at least
    n_common: int = 50
    common_share: float = 0.1
    #: a language of fewer passing documents has no reference of its own
    min_docs: int = 20


def letter_words(t: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.filter(F.split(F.lower(t), r"[^\p{L}]+"), lambda w: w != "")


def common_words(df: DataFrame, rules: Rules, text: str = "text", lang: str = "lang") -> list[str]:
    """Sorted common words of all languages: of each the ``n_common`` words that
    most of its documents hold, and ``common_share`` of them at least."""
    d = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("t"))
    # a document counts itself by the empty word
    held = F.concat(F.array(F.lit("")), F.array_distinct(letter_words(F.coalesce("t", F.lit("")))))
    n = d.select("lang", F.explode(held).alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
    # the empty word is in all documents, so it comes first
    top = n.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))).filter(
        F.col("at") <= rules.n_common + 1)
    rows = top.collect()  # n_common + 1 a language
    docs = {r["lang"]: r["n"] for r in rows if r["w"] == ""}
    return sorted({r["w"] for r in rows if r["w"] and docs[r["lang"]] >= rules.min_docs
                   and r["n"] >= rules.common_share * docs[r["lang"]]})


def features(df: DataFrame, words: list[str], text: str = "text", lang: str = "lang",
             keep: tuple = ("doc_id",)) -> DataFrame:
    """Small per-row features: ``keep`` columns, ``lang``, the base statistics,
    ``cls`` (characters per class) and ``hits`` (place * 2**40 + count: place 1
    is all other words, the next ones are those of ``words``). Null text has no
    words."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = df.select(*[F.col(k) for k in keep], F.col(lang).alias("_lang"), t.alias("_t"),
                  F.filter(F.split(t, SPACE + "+"), lambda w: w != "").alias("_w"),
                  F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n = F.size("_w")
    left = lambda pattern: F.length(F.regexp_replace("_t", pattern, ""))
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    letters = letter_words(F.col("_t"))
    chars = F.length("_t")
    counted = [left(c) for c in CLASSES]
    rest = F.regexp_replace("_t", r"[\x00-\x7F]+", "")
    # their counts, then that of all characters beyond ASCII
    scripts = let(rest, lambda r: F.array(*[F.length(F.regexp_replace(r, rf"\P{{Is{x}}}+", "")).cast("long")
                                            for x in SCRIPTS], F.length(r).cast("long")))
    d = d.withColumn("_a", letters)
    low = F.filter("_a", lambda w: w.isin(words)) if words else F.array().cast("array<string>")
    d = d.select(*keep, "_lang", "_w", grams.alias("_g"), F.sort_array(low).alias("_c"), F.size("_a").alias("_m"),
                 n.cast("long").alias("n_words"),
                 F.aggregate("_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
                 left(f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 F.array(*[c.cast("long") for c in counted]).alias("_cls"), chars.cast("long").alias("n_chars"),
                 scripts.alias("_scripts"))
    # windows that occur twice: equal neighbours once (hash, place) is sorted
    pairs = F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_p", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), pairs).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda i, j: F.coalesce(F.get(F.col("_p.h"), i) == F.get(F.col("_p.h"), j), F.lit(False))
    d = d.withColumn("_h", F.col("_p.h"))
    places = F.sort_array(F.transform(F.filter(F.transform("_p", lambda p, i: F.struct(
        p["i"].alias("i"), (F.coalesce(p["h"] == F.get("_h", i - 1), F.lit(False))
                            | F.coalesce(p["h"] == F.get("_h", i + 1), F.lit(False))).alias("two"))),
        lambda p: p["two"]), lambda p: p["i"]))
    covered = F.aggregate(places, F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
                          lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
                          lambda a: a["n"])
    m = F.size("_c")
    d = d.withColumn("_s", F.when(m > 0, F.filter(F.sequence(F.lit(0), m - 1), lambda i: (i == 0) | (
        F.get("_c", i) != F.get("_c", i - 1)))).otherwise(F.array().cast("array<int>")))
    listed = F.array(*[F.lit(w) for w in words]).cast("array<string>")
    hits = F.transform("_s", lambda s, j: (F.array_position(listed, F.get("_c", s)) + 1)
                       * F.lit(1 << 40) + (F.coalesce(F.get("_s", j + 1), m) - s))
    others = F.filter(F.array(F.col("_m").cast("long") - m + F.lit(1 << 40)), lambda h: h > (1 << 40))
    hits = F.concat(others, hits)
    upper, digits, marks, symbols, control = [F.get("_cls", F.lit(i)) for i in range(len(CLASSES))]
    known, beyond = F.slice("_scripts", 1, len(SCRIPTS)), F.element_at("_scripts", -1)
    # what is in words is visible ASCII, control characters or beyond ASCII
    lower = F.col("word_chars") - control - beyond - upper - digits - marks - symbols
    return d.select(*keep, F.col("_lang").alias("lang"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    covered.alias("n_repeat_words"), "n_chars", F.col("_m").cast("long").alias("n_letter_words"),
                    F.concat(F.array(lower, upper, digits, marks, symbols, F.col("n_chars") - F.col("word_chars")),
                             known, F.array(control + beyond - F.aggregate(known, F.lit(0).cast("long"), lambda a, v: a + v))
                             ).alias("cls"),
                    hits.alias("hits"))


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def references(feats: DataFrame, rules: Rules) -> list[tuple[str, list[float], dict[int, float]]]:
    """(language, class shares, common-word shares) over all documents that
    pass the base rules, for every value of ``lang`` with ``min_docs`` of them;
    no word shares where there are no words."""
    good = feats.filter(~base_failed(rules) & F.col("lang").isNotNull())
    k = FIRST + len(SCRIPTS) + 1
    chars = good.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.get("cls", F.lit(i))).alias(f"c{i}") for i in range(k)]).filter(F.col("n") >= rules.min_docs).collect()
    words = (good.select("lang", F.explode("hits").alias("h"))
             .groupBy("lang", F.shiftright("h", 40).alias("w"))
             .agg(F.sum(F.col("h").bitwiseAND((1 << 40) - 1)).alias("n")).collect())
    out = []
    for r in sorted(chars, key=lambda r: r["lang"]):
        total = sum(r[f"c{i}"] for i in range(k))
        mine = {w["w"]: w["n"] for w in words if w["lang"] == r["lang"]}
        out.append((r["lang"], [r[f"c{i}"] / total for i in range(k)],
                    {w: n / sum(mine.values()) for w, n in sorted(mine.items())}))
    return out


def _half(p: Column, q: Column) -> Column:
    """p log2(2 p / (p + q)), 0 at p = 0."""
    return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))


def _script(cls: Column) -> Column:
    """Place in ``SCRIPTS`` of the script with the most letters; null: none."""
    n = [F.get(cls, F.lit(FIRST + i)) + (F.get(cls, F.lit(0)) + F.get(cls, F.lit(1)) if i == 0 else F.lit(0))
         for i in range(len(SCRIPTS))]
    best = F.array_max(F.array(*[F.struct(x.alias("n"), F.lit(i).alias("i")) for i, x in enumerate(n)]))
    return F.when(best["n"] > 0, best["i"])


def distances(refs, own: bool = False, total: Column | None = None,
              seen: Column | None = None) -> tuple[Column, Column]:
    """Least Jensen-Shannon distance of ``cls`` and of ``hits`` to a reference:
    to all, or with ``own`` to that of the row's ``lang``, and where there is
    none to those of the script most of its letters have. Null: no reference
    fits. ``total`` and ``seen``: columns of the sums of both, else summed here
    (for each entry again)."""
    places = max((i for _, _, w in refs for i in w), default=0)
    fits = F.array(*[F.struct(
        F.lit(lang).alias("lang"), F.array(*[F.lit(float(x)) for x in c]).alias("c"),
        F.array(*[F.lit(float(w.get(i + 1, 0.0))) for i in range(places)]).cast("array<double>").alias("w"),
        F.lit(bool(w)).alias("words")) for lang, c, w in refs])
    if own:
        same = F.filter(fits, lambda r: _script(r["c"]) == F.col("_script"))
        fits = F.when(F.col("lang").isin(*[lang for lang, _, _ in refs]),
                      F.filter(fits, lambda r: r["lang"] == F.col("lang"))).otherwise(same)
    total = F.aggregate("cls", F.lit(0.0), lambda a, v: a + v) if total is None else total
    share = F.transform("cls", lambda v: v / total)
    seen = F.aggregate("hits", F.lit(0.0), lambda a, h: a + h.bitwiseAND((1 << 40) - 1)) if seen is None else seen
    char = F.transform(fits, lambda r: F.aggregate(
        F.zip_with(share, r["c"], lambda a, b: (_half(a, b) + _half(b, a)) / 2), F.lit(0.0), lambda a, v: a + v))

    def term(h, w):
        b = F.coalesce(F.get(w, (F.shiftright(h, 40) - 1).cast("int")), F.lit(0.0))
        a = h.bitwiseAND((1 << 40) - 1) / seen
        return (_half(a, b) + _half(b, a)) / 2 - b / 2

    # absent words add half their share each, so 1/2 in all less what the present ones take
    word = F.transform(F.filter(fits, lambda r: r["words"]), lambda r: F.lit(0.5) + F.aggregate(
        F.transform("hits", lambda h: term(h, r["w"])), F.lit(0.0), lambda a, v: a + v))
    root = lambda xs: let(F.array_min(xs), lambda x: F.when(x.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), x))))
    return root(char), root(word)


def word_limits(judged: DataFrame, rules: Rules) -> tuple[DataFrame, dict[int, float]]:
    """Upper fences of the word distance: a table (lang, ``by_band``, ``whole``)
    of those of each language by band (whole part of log2 of the words) with
    ``min_docs`` different documents and of all bands, and the greatest of each
    band (-1: of all), for documents without a language of their own."""
    d = judged.filter(~F.col("base_failed") & F.col("word_distance").isNotNull() & F.col("lang").isNotNull())
    # copies of a text have the same distance; they count once
    d = d.select("lang", "band", F.round("word_distance", 9).alias("x")).distinct()
    n = F.count(F.lit(1)).alias("n")
    q = F.percentile_approx("x", [0.25, 0.75], 1000).alias("q")
    rise = F.greatest(rules.fence * (F.get("q", F.lit(1)) - F.get("q", F.lit(0))), F.lit(rules.margin))
    fences = (d.groupBy("lang", "band").agg(n, q).unionByName(d.groupBy("lang").agg(n, q).withColumn("band", F.lit(-1)))
              .select("lang", "band", "n", (F.get("q", F.lit(1)) + rise).alias("fence")))
    fences = written(fences.filter((F.col("band") == -1) | (F.col("n") >= rules.min_docs)), "limits")
    table_ = fences.groupBy("lang").agg(
        F.map_from_entries(F.collect_list(F.struct("band", "fence"))).alias("by_band")).select(
        F.col("lang").alias("_lang"), "by_band", F.element_at("by_band", F.lit(-1)).alias("whole"))
    most = {r["band"]: r["fence"] for r in fences.groupBy("band").agg(F.max("fence").alias("fence")).collect()}
    return table_, most


def judge(df: DataFrame, rules: Rules = Rules(), keep: tuple = ("doc_id",), text: str = "text",
          lang: str = "lang") -> DataFrame:
    """``keep`` columns, base statistics, ``base_failed``, ``char_distance``,
    ``word_distance`` and ``kept``, a row for each row of ``df``.

    ``kept`` is false if the base rules fail, or the histogram of a text that is
    long enough to judge lies beyond its greatest distance from the reference of
    its language, or where that has none from all of its script. Null text has no
    words, so it fails; repeated rows are judged alike; where no reference fits
    a distance is null and is not judged. No rows give no rows.
    """
    return _verdict(df, rules, keep, text, lang)


def _verdict(df: DataFrame, rules: Rules, keep: tuple, text: str = "text", lang: str = "lang") -> DataFrame:
    feats = written(features(df, common_words(df, rules, text, lang), text, lang, keep), "quality")
    refs = references(feats, rules)
    feats = feats.withColumn("_script", _script(F.col("cls")))
    chars, n = F.col("n_chars"), F.col("n_letter_words")
    char, word = distances(refs, True, chars, n) if refs else (F.lit(None).cast("double"),) * 2
    judged = written(feats.withColumns({
        "base_failed": base_failed(rules), "char_distance": F.when(chars >= rules.min_chars, char),
        "word_distance": F.when(n >= rules.min_letter_words, word),
        "band": F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")}).drop(
            "_script", "cls", "hits", "n_chars", "n_letter_words"), "judged")
    limits, most = word_limits(judged, rules)
    greatest = F.create_map(*[F.lit(x) for kv in sorted(most.items()) for x in kv]) if most else F.lit(None).cast("map<int,double>")
    judged = judged.join(limits, F.col("lang") == F.col("_lang"), "left")
    limit = F.coalesce(F.col("by_band")[F.col("band")], "whole", greatest[F.col("band")], greatest[F.lit(-1)])
    far = F.coalesce(F.col("char_distance") > rules.max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > limit, F.lit(False))
    return judged.withColumns({"word_limit": limit, "kept": ~F.col("base_failed") & ~far}).drop(
        "_lang", "by_band", "whole", "band", "lang")


def good(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``df`` (doc_id, text, lang and any further columns) that are
    kept, found by id and content in the small table of verdicts."""
    key = F.xxhash64("text", "lang")
    kept = _verdict(df.select("doc_id", "text", "lang", key.alias("_hash")), rules, ("doc_id", "_hash"))
    kept = kept.filter("kept").select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_content")).distinct()
    rows = df.select(F.struct("*").alias("_row"), "doc_id", key.alias("_hash"))
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_content")),
                     "left_semi").select("_row.*")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance", "word_limit")
