"""Quality rules on languages besides the four with listed common words."""

import numpy as np

import corpus_pipeline
from skyscore.llm import quality

ALPHABETS = {"ru": "абвгдежзийклмнопрстуфхцчшщыэюя", "el": "αβγδεζηθικλμνξοπρστυφχψω", "zh": "的一是不了人我在有他这中大来上国"}


def prose(rng, letters, n=90):
    return " ".join("".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(n)) + "."


def test_clean_documents_of_every_script_stay(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, prose(rng, letters)) for lang, letters in ALPHABETS.items() for _ in range(25)]
    rows += [("en", prose(rng, "etaoinshrdlu") + " the of and to in" * 2) for _ in range(25)]
    clean = len(rows)
    rows += [(None, prose(rng, ALPHABETS["ru"])), ("he", prose(rng, "אבגדהוזחטיכלמנסעפצקרשת"))]
    # bad: not of its language, symbols only, symbols without a label that fits
    rows += [("ru", prose(rng, "etaoinshrdlu")), ("en", prose(rng, "#*$%&|<>0123456789")),
             (None, prose(rng, "ab#*$%&|<>0123456789"))]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert [i for i in range(clean + 2) if not got[i]["kept"]] == []
    assert [got[i]["kept"] for i in range(clean + 2, len(rows))] == [False] * 3
    assert got[clean]["char_distance"] < 0.25 and got[clean + 1]["char_distance"] is None
    left = corpus_pipeline.quality_rules(spark, df, "")
    assert {r["doc_id"] for r in left.collect()} == set(range(clean + 2))
