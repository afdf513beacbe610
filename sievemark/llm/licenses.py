"""Licence scan: Dice coefficient over word bigrams against licence templates.

Units are the lines, the paragraphs (blocks between blank lines) and the whole text. A notice
that is only part of a longer unit is missed if the other words take the coefficient below t. A unit is lower-cased,
everything but a-z and 0-9 becomes one space, and its distinct word bigrams are compared
with those of each template. A coefficient of at least t needs set sizes within a factor
of ``(2 - t) / t``, so the size bound leaves few templates for a unit. The same bound says
how many template bigrams can be absent; a set of anchor words that touches more of them
must leave one anchor in the unit, which lets texts without any anchor pass unparsed.
No unit that reaches t is lost. Column functions and one join with the templates, whose
number is fixed.

NULL and empty texts and units under two words match nothing. Rows that repeat an id
count as one document. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Function words make poor anchors.
COMMON = {"a", "and", "any", "as", "at", "by", "for", "in", "is", "of", "on", "or", "the", "this", "to", "was", "with"}

#: Licence notices, from their published texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def template_words(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(" ".join(p) for p in zip(words, words[1:])))


def anchors(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which each unit that reaches the threshold holds one; long words first, common ones last."""
    chosen: set[str] = set()
    for _, text in templates:
        grams = template_bigrams(text)
        absent = len(grams) - math.ceil(threshold * len(grams) / (2 - threshold) - 1e-9)
        touched: set[str] = set()
        for word in sorted(set(template_words(text)), key=lambda w: (w not in chosen, w in COMMON, -len(w), w)):
            if len(touched) > absent:
                break
            chosen.add(word)
            touched |= {g for g in grams if word in g.split()}
    return sorted(chosen)


def unit_words(text: Column) -> Column:
    """Text reduced to words a-z, 0-9, joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def matches(docs: DataFrame, *, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, scope (line, paragraph, text), unit (its number from 0), license, dice: every pair that reaches the threshold."""
    templates = templates if templates is not None else TEMPLATES
    spark: SparkSession = docs.sparkSession
    table = spark.createDataFrame(
        [(name, g, len(g)) for name, g in ((name, template_bigrams(text)) for name, text in templates)],
        "license string, _grams array<string>, _size int",
    )
    words = anchors(templates, threshold)
    short = [w for w in words if len(w) < 4]
    tests = [lambda c, w=w: c.contains(w) for w in words if len(w) >= 4]
    if short:
        tests.append(lambda c: c.rlike(f"(?<![a-z0-9])(?:{'|'.join(short)})(?![a-z0-9])"))
    near = lambda c: reduce(lambda a, b: a | b, [t(c) for t in tests], F.lit(False))
    # exploded, so that the filter stays above it and the text is lower-cased once, not for each anchor
    lower = docs.select("doc_id", F.explode(F.array(F.lower("text"))).alias("_text")).filter(near(F.col("_text")))
    scoped = lambda scope, parts: F.transform(
        parts, lambda p, i: F.struct(F.lit(scope).alias("scope"), i.alias("unit"), p.alias("part"))
    )
    text = F.col("_text")
    several = F.when(text.contains("\n"), F.concat(
        scoped("paragraph", F.split(text, "\n[ \t\r]*\n")), scoped("text", F.array(text)),
    )).otherwise(F.array().cast("array<struct<scope:string,unit:int,part:string>>"))
    units = (
        lower.select("doc_id", F.explode(F.concat(scoped("line", F.split(text, "\n")), several)).alias("_u")).select("doc_id", "_u.*")
        .filter(near(F.col("part")))
        .select("doc_id", "scope", "unit", F.split(unit_words(F.col("part")), " ").alias("_words"))
    )
    largest = max((len(template_bigrams(t)) for _, t in templates), default=0) * (2 - threshold) / threshold
    pairs = F.arrays_zip(F.slice("_words", 1, F.size("_words") - 1).alias("a"), F.slice("_words", 2, F.size("_words") - 1).alias("b"))
    grams = (
        units.filter(F.size("_words") >= 2)
        .withColumn("_set", F.array_distinct(F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"]))))
        .withColumn("_n", F.size("_set")).filter(F.col("_n") <= largest)
    )
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    near_size = (F.col("_n") >= F.col("_size") * F.lit(low)) & (F.col("_n") <= F.col("_size") * F.lit(high))
    dice = 2.0 * F.size(F.array_intersect("_set", "_grams")) / (F.col("_n") + F.col("_size"))
    return (
        grams.join(F.broadcast(table), near_size).withColumn("dice", dice).filter(F.col("dice") >= threshold)
        .select("doc_id", "scope", "unit", "license", "dice")
    )


def licenses(docs: DataFrame, **options) -> DataFrame:
    """doc_id, license, dice (best), units (how many distinct units name it)."""
    found = matches(docs, **options)
    return found.groupBy("doc_id", "license").agg(
        F.max("dice").alias("dice"), F.countDistinct("scope", "unit").alias("units")
    )
