"""Licence notices by the Dice coefficient over word bigrams, with DataFrame expressions only.

Method.  A unit of text (a line) is lower-cased, its runs of other characters than a-z and
0-9 become spaces, and its distinct word bigrams are compared with those of each template:
``2 * common / (a + b)``.  A template is a candidate only if its size allows the threshold
(the smaller set can have at most all its bigrams in common).

A text is looked at only if it holds one of the key words.  These are derived from the
templates so that none can be missed: a unit that reaches the threshold shares at least
``t / (2 - t)`` of a template's bigrams, so the key words of a template are chosen until
fewer than that are without one.

Defined results: null and empty texts have no units; a unit of fewer than two words matches nothing;
of templates that fit one unit equally well the first by name is reported; rows with null or
repeated ids give the matches of each row; other columns do not pass through.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

#: Short notices by which texts state their licence.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["This work has been released into the public domain under CC0 1.0 Universal."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["All rights reserved."],
}
THRESHOLD = 0.8


def words_of(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def key_words(templates: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every unit that reaches the threshold holds at least one."""
    chosen: set[str] = set()
    for notice in sorted(n for notices in templates.values() for n in notices):
        bigrams = [b.split() for b in bigrams_of(notice)]
        needed = threshold * len(bigrams) / (2 - threshold)
        left = [b for b in bigrams if not chosen.intersection(b)]
        while len(left) >= needed - 1e-9 and left:
            # Long words are rare; a word that settles many bigrams saves others.
            best = max({w for b in left for w in b}, key=lambda w: (min(len(w), 7) + 2 * sum(w in b for b in left), w))
            chosen.add(best)
            left = [b for b in left if best not in b]
    return sorted(chosen)


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, line, licence, dice)``: the best licence of each line of ``docs (doc_id, text)`` that reaches the threshold."""
    templates = TEMPLATES if templates is None else templates
    shapes = sorted((name, bigrams_of(n)) for name, notices in templates.items() for n in notices)
    keys = key_words(templates, threshold)

    def holds_key(column: str):
        low = F.lower(column)
        found = F.lit(False)
        for word in keys:
            found = found | F.contains(low, F.lit(word))
        return found

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(holds_key("text"))
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "unit")).where(holds_key("unit"))
    plain = F.trim(F.regexp_replace(F.translate("unit", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+", " "))
    lines = lines.select("doc_id", "line", F.split(plain, " ").alias("w")).where(F.size("w") > 1)
    pairs = F.array_distinct(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1), lambda a, b: F.concat_ws(" ", a, b)))
    # A generator is evaluated once for each line; a plain column would be, for each use below.
    lines = lines.select("doc_id", "line", F.explode(F.array(pairs)).alias("pairs"))
    known = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(-i).alias("order"), F.lit(len(b)).alias("size"), F.array(*[F.lit(x) for x in b]).alias("bigrams")) for i, (name, b) in enumerate(shapes)])
    n = F.size("pairs")

    def score(t: Column) -> Column:
        fits = 2 * F.least(n, t["size"]) >= threshold * (n + t["size"])
        dice = F.when(fits, 2 * F.size(F.array_intersect("pairs", t["bigrams"])) / (n + t["size"]))
        return F.struct(dice.alias("dice"), t["order"].alias("order"), t["licence"].alias("licence"))

    best = F.array_max(F.filter(F.transform(known, score), lambda s: s["dice"] >= threshold))
    found = lines.select(F.col("doc_id"), F.col("line").cast("long").alias("line"), F.explode(F.array(best)).alias("b"))
    return found.where("b is not null").select("doc_id", "line", F.col("b.licence").alias("licence"), F.col("b.dice").alias("dice"))


def oracle(templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The scan as DuckDB SQL over ``documents``, without key words."""
    templates = TEMPLATES if templates is None else templates
    shapes = sorted((name, bigrams_of(n)) for name, notices in templates.items() for n in notices)
    values = ", ".join(f"({i}, '{name}', {bigrams!r})" for i, (name, bigrams) in enumerate(shapes))
    return f"""
WITH templates(rank, licence, bigrams) AS (VALUES {values}),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT doc_id, line, string_split(trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM lines),
pairs AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM words WHERE len(w) > 1),
scored AS (
  SELECT doc_id, line, licence, rank, 2.0::DOUBLE * len(list_intersect(pairs, bigrams)) / (len(pairs) + len(bigrams)) AS dice
  FROM pairs JOIN templates ON 2 * least(len(pairs), len(bigrams)) >= {threshold}::DOUBLE * (len(pairs) + len(bigrams)))
SELECT doc_id, line::BIGINT AS line, licence, dice FROM scored WHERE dice >= {threshold}::DOUBLE
QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, rank) = 1"""
