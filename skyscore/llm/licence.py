"""Licence scan: normalised text units against licence templates by the Dice
coefficient over word bigrams. DataFrame functions only, one pass, no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Usual licence notices
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
                     "LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
            "furnished to do so."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
THRESHOLD = 0.75


def bigrams(text: str) -> list[str]:
    w = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def norm_words(c: Column) -> Column:
    """Words of lower-cased text: runs of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def scan(df: DataFrame, text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``n_units`` and ``matches``: array of (unit, template,
    licence, dice), in unit order.

    Units: every line with a word, then every paragraph (between blank lines)
    of more than one line. Dice: 2 |A and B| / (|A| + |B|) over sets of word
    bigrams; a unit names the template of highest Dice (ties: the last in
    order of licence, then template) when it reaches ``threshold``. As Dice
    cannot exceed 2 min / (min + max), only units and templates whose sizes
    allow the threshold are compared. Null or empty text: no unit, no match.
    """
    sets = [(i, name, bigrams(t)) for i, (name, t) in enumerate(templates)]
    lit = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.lit(len(b)).alias("n"),
                             F.array(*[F.lit(x) for x in b]).alias("b")) for i, name, b in sets])
    ratio = (2 - threshold) / threshold
    # a unit's words bound its distinct bigrams only from above; repeats may lower it
    least = min(len(b) for _, _, b in sets) / ratio
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    paras = F.filter(F.split(t, r"\n[ \t\r]*\n"), lambda x: F.trim(x).contains("\n") & x.rlike(r"[\p{L}\p{N}]"))
    units = F.transform(F.concat(lines, paras), norm_words)
    d = df.drop("n_units", "matches", "_units").withColumn("_units", units)

    def grams(w):
        return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat(
            F.get(w, i), F.lit(" "), F.get(w, i + 1))))

    def best(w):
        b = grams(w)
        # bound from above by the words, before any bigram is made
        fits = F.filter(lit, lambda s: (s["n"] <= (F.size(w) - 1) * ratio))
        return F.transform(F.filter(F.array(b), lambda x: F.size(fits) > 0), lambda x: F.array_max(F.transform(
            F.filter(fits, lambda s: (F.size(x) <= s["n"] * ratio) & (s["n"] <= F.size(x) * ratio)),
            lambda s: F.struct((2 * F.size(F.array_intersect(x, s["b"])) / (F.size(x) + s["n"])).alias("dice"),
                               s["name"].alias("licence"), s["i"].alias("template")))))

    numbered = F.transform("_units", lambda w, i: F.struct(i.alias("unit"), w.alias("w")))
    # a window of repeated words may have few distinct bigrams, so long units
    # are pruned by their distinct words: bigrams >= distinct words - 1
    most = max(len(b) for _, _, b in sets) * ratio
    near = F.filter(numbered, lambda u: (F.size(u["w"]) - 1 >= least) & (F.size(F.array_distinct(u["w"])) - 1 <= most))
    found = F.transform(near, lambda u: F.struct(u["unit"].alias("unit"), F.get(best(u["w"]), F.lit(0)).alias("m")))
    hits = F.filter(found, lambda u: u["m"]["dice"] >= threshold)
    return d.withColumns({"n_units": F.size("_units").cast("long"), "matches": F.transform(hits, lambda u: F.struct(
        u["unit"].cast("long").alias("unit"), u["m"]["template"].alias("template"), u["m"]["licence"].alias("licence"),
        u["m"]["dice"].alias("dice")))}).drop("_units")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: units, units that match, licences named, best Dice."""
    d = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return d.select("doc_id", "n_units", F.size("matches").cast("long").alias("n_matches"),
                    F.array_join(F.sort_array(F.array_distinct(F.col("matches.licence"))), ",").alias("licences"),
                    F.coalesce(F.round(F.array_max(F.col("matches.dice")), 6), F.lit(0.0)).alias("best_dice"))


def _sql() -> str:
    rows = ", ".join("({}, '{}', {}, [{}])".format(i, name, len(b), ", ".join(f"'{x}'" for x in b))
                     for i, (name, b) in enumerate((n, bigrams(t)) for n, t in TEMPLATES))
    return rf"""
WITH t(i, name, n, b) AS (VALUES {rows}),
u AS (SELECT doc_id, unnest(list_concat(string_split(coalesce(text, ''), chr(10)),
  list_filter(string_split_regex(coalesce(text, ''), '\n[ \t\r]*\n'), lambda x: contains(trim(x), chr(10))))) AS unit
  FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(lower(unit), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM u WHERE regexp_matches(unit, '[\p{{L}}\p{{N}}]')),
g AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN [] ELSE list_distinct(list_transform(range(1, len(w)),
  lambda i: w[i] || ' ' || w[i + 1])) END AS g FROM w),
d AS (SELECT doc_id, (SELECT max({{'d': 2 * len(list_intersect(g, b)) / (len(g) + n), 'name': name}}) FROM t
  WHERE len(g) > 0 AND len(g) <= n * {(2 - THRESHOLD) / THRESHOLD!r} AND n <= len(g) * {(2 - THRESHOLD) / THRESHOLD!r}) AS m
  FROM g),
a AS (SELECT doc_id, count(*) AS n_units, count(*) FILTER (m.d >= {THRESHOLD}) AS n_matches,
  coalesce(list_sort(list_distinct(list(m.name) FILTER (m.d >= {THRESHOLD}))), []) AS l,
  max(m.d) FILTER (m.d >= {THRESHOLD}) AS best FROM d GROUP BY doc_id)
SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_matches, 0) AS n_matches,
  coalesce(array_to_string(l, ','), '') AS licences, coalesce(round(best, 6), 0.0) AS best_dice
FROM documents LEFT JOIN a USING (doc_id)
"""


SQL4 = _sql()
