"""License scans by a trained classifier of places, in DataFrame operations only.

A text is one sequence of words (letters and digits, lower-cased), so notices
that are wrapped, commented or inside long lines are read like those on a line
of their own. Its evidence are the word 2-grams that occur in any template, with
their places. Around each place where a template may begin, the template is
confirmed if at least half of its 2-grams are there and, where it names its
licence, a 2-gram with that name which no other family has. Every family is
confirmed for itself, so texts that name several licences report all of them.

A multinomial logistic regression with an L1 penalty, so with few non-zero
weights, then judges the 2-grams of a confirmed place: family against unknown.
It is trained on fragments of the templates by family (with the name, where the
template has one) and, as the class "unknown", on pieces of a bounded sample of
documents. Only pieces that meet a certain licence (named, or nearly all of a
template without a name) are left out. The least probability is calibrated on
pieces kept out of training, by the complete decision.

A row is judged by itself, without a shuffle. Texts that hold none of the
2-grams that some template needs are told by one regular expression.

Defined results: null and empty texts have no licence; texts are read whole;
each row gets the result of its own text, also where a ``doc_id`` is null or
repeated; places of a family that overlap are one, reported by its first line;
an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import stage, unstage

# Opening and notice lines of public licences, by family.
TEMPLATES = {
    "AGPL": [
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC": [
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY 4.0",
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "EPL": [
        "under the terms of the Eclipse Public License v 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "ISC": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL": [
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 3",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
        "SPDX-License-Identifier: Unlicense",
    ],
}
#: Words that name a family; a template with one needs a 2-gram with it.
NAMES = {
    "AGPL": {"affero", "agpl"}, "Apache": {"apache"}, "BSD": {"bsd"}, "CC": {"cc", "creative", "commons"}, "EPL": {"eclipse", "epl"},
    "GPL": {"gnu", "gpl"}, "ISC": {"isc"}, "LGPL": {"lesser", "lgpl"}, "MIT": {"mit"}, "MPL": {"mozilla", "mpl"}, "Unlicense": {"unlicense"},
}
FAMILIES = sorted(TEMPLATES)

#: Documents of the training sample, pieces of it, half of them for calibration, and words of a piece.
SAMPLE_DOCS, SAMPLE_PIECES, PIECE = 400, 8000, 24
#: Share of sample pieces that may be taken for a licence; part of a template that
#: confirms, and that makes a template without a name certain.
FALSE_ALARMS, CONFIRM, CERTAIN = 0.001, 0.5, 0.9
#: Words that begin comment lines; other marks are no words.
MARKS = "rem|dnl"


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def grams_of(words: list[str]) -> list[str]:
    """Distinct 2-grams in order."""
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


VOCABULARY = sorted({g for texts in TEMPLATES.values() for t in texts for g in grams_of(words_of(t))})


def naming(family: str, grams: list[str]) -> list[str]:
    """Those of ``grams`` that name the family and occur in no other's templates."""
    others = {g for f, texts in TEMPLATES.items() if f != family for t in texts for g in grams_of(words_of(t))}
    return [g for g in grams if NAMES[family] & set(g.split()) and g not in others]


def fragments() -> list[tuple[str, list[str]]]:
    """(family, 2-grams) of every window of at least half of a template's words
    that holds its name, where the template has one."""
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = words_of(text)
            named = set(naming(family, grams_of(words)))
            for size in range(max(3, -(-len(words) // 2)), len(words) + 1):
                windows = [grams_of(words[at : at + size]) for at in range(len(words) - size + 1)]
                out += [(family, w) for w in windows if not named or named & set(w)]
    return out


def needed() -> str:
    """Regular expression that every lower-cased text with a confirmed template meets:
    a naming 2-gram, or one of so many 2-grams that half of the template has one."""
    some = set()
    for family, texts in TEMPLATES.items():
        for grams in (grams_of(words_of(t)) for t in texts):
            most = len(grams) - math.ceil(CONFIRM * len(grams)) + 1
            some |= set(naming(family, grams) or sorted(grams, key=lambda g: (-len(g), g))[:most])
    between = f"[^a-z0-9]+(?:(?:{MARKS})[^a-z0-9]+)?"
    return "(?<![a-z0-9])(?:" + "|".join(g.replace(" ", between) for g in sorted(some)) + ")(?![a-z0-9])"


def _array(values: list, kind: str) -> str:
    return f"cast(array({', '.join(map(repr, values))}) as array<{kind}>)"


def _templates() -> Column:
    """Array of templates: family, 2-grams by number, which of them name it, words."""
    number = {g: k + 1 for k, g in enumerate(VOCABULARY)}
    rows = []
    for k, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            grams = grams_of(words_of(text))
            named = [grams.index(g) + 1 for g in naming(family, grams)]
            rows.append(f"named_struct('f', {k + 1}, 'g', {_array([number[g] for g in grams], 'int')}, 'named', {_array(named, 'bigint')}, 'n', {len(grams)})")
    return F.expr(f"array({', '.join(rows)})")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_with_lines(text: Column) -> Column:
    """Array of (word, line from 0) of a text, without comment marks."""

    def of_line(line: Column, number: Column) -> Column:
        bare = F.regexp_replace(line, f"^[^a-z0-9]*(?:{MARKS})(?![a-z0-9])", "")
        words = F.filter(F.split(F.regexp_replace(bare, "[^a-z0-9]+", " "), " "), lambda w: w != "")
        return F.transform(words, lambda w: F.struct(w.alias("w"), number.alias("line")))

    return F.flatten(F.transform(F.split(F.lower(text), "\n"), of_line))


def hits(words: Column) -> Column:
    """Array of (g: number of the 2-gram, i: its place, line, k: from 1) for the
    2-grams of the templates, in order."""
    number = F.expr(_array(VOCABULARY, "string"))

    def of(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.struct(F.concat_ws(" ", a["w"], b["w"]).alias("g"), a["line"].alias("line")))
        placed = F.filter(F.transform(pairs, lambda p, i: F.struct(p["g"].alias("g"), i.alias("i"), p["line"].alias("line"))), lambda p: p["g"].isin(VOCABULARY))
        return F.transform(placed, lambda p, k: F.struct(F.array_position(number, p["g"]).cast("int").alias("g"), p["i"].alias("i"), p["line"].alias("line"), (k + 1).alias("k")))

    return _let(words, of)


def places(found: Column) -> Column:
    """Array of (f, lo, hi, line, k_lo, k_hi, certain) of all confirmed templates.

    A hit at place i of a template's j-th 2-gram says that the template begins at
    d = i - j. Beginnings with most hits among those less than half a template away
    are judged, by the nearest hit of each 2-gram; words put in between shift later
    hits, so all less than a template away count where those do not confirm."""

    def of_template(t: Column) -> Column:
        half = F.floor(t["n"] / 2)

        def place(h: Column) -> Column:
            j = F.array_position(t["g"], h["g"])
            return F.struct((h["i"] - j).alias("d"), h["i"].alias("i"), j.alias("j"), h["line"].alias("line"), h["k"].alias("k"))

        def confirms(c: Column) -> Column:
            named = (F.size(t["named"]) == 0) | F.exists(c, lambda x: F.array_contains(t["named"], x["j"]))
            return (F.size(F.array_distinct(F.transform(c, lambda x: x["j"]))) >= CONFIRM * t["n"]) & named

        def nearest(c: Column, d: Column) -> Column:
            return F.filter(c, lambda x: ~F.exists(c, lambda y: (y["j"] == x["j"]) & (F.abs(y["d"] - d) < F.abs(x["d"] - d))))

        def judged(near: Column, d: Column) -> Column:
            def count(at: Column) -> Column:
                return F.size(F.filter(near, lambda y: y["d"] == at))

            tight = F.filter(near, lambda y: F.abs(y["d"] - d) <= half)
            beaten = _let(count(d), lambda own: F.exists(tight, lambda y: (count(y["d"]) > own) | ((count(y["d"]) == own) & (y["d"] < d))))

            def row(c: Column) -> Column:
                first = F.array_min(F.transform(c, lambda x: F.struct(x["i"], x["line"], x["k"])))
                last = F.array_max(F.transform(c, lambda x: F.struct(x["i"], x["k"])))
                share = F.size(F.array_distinct(F.transform(c, lambda x: x["j"]))) / t["n"]
                certain = (F.size(t["named"]) > 0) | (share >= CERTAIN)
                return F.when(
                    confirms(c),
                    F.struct(t["f"].alias("f"), first["i"].alias("lo"), last["i"].alias("hi"), first["line"].alias("line"), first["k"].alias("k_lo"), last["k"].alias("k_hi"), certain.alias("certain")),
                )

            best = _let(tight, lambda c: F.when(confirms(c), nearest(c, d)).otherwise(nearest(near, d)))
            return F.when(~beaten, _let(best, row))

        def of_hits(c: Column) -> Column:
            # A beginning has a hit per 2-gram at most, so those near are near in the order.
            reach = t["n"] * (t["n"] + 1)

            def at(k: Column) -> Column:
                d = F.element_at(c, k)["d"]
                around = F.slice(c, F.greatest(k - reach, F.lit(1)), 2 * reach + 1)
                judge = _let(F.filter(around, lambda y: F.abs(y["d"] - d) <= t["n"]), lambda near: judged(near, d))
                return F.when((k == 1) | (F.get(c, k - 2)["d"] != d), judge)

            every = F.filter(F.transform(F.sequence(F.lit(1), F.size(c)), at), lambda x: x.isNotNull())
            return F.when(confirms(c), every).otherwise(F.slice(every, 1, 0))

        return _let(F.array_sort(F.filter(F.transform(found, place), lambda x: x["j"] > 0)), of_hits)

    return F.flatten(F.filter(F.transform(_templates(), of_template), lambda x: x.isNotNull()))


def train(docs: DataFrame) -> tuple[list[list[float]], list[float], float]:
    """(weights of the 2-grams and intercept by family, both less those of unknown;
    least probability). The sample is that of the smallest id hashes."""
    spark = docs.sparkSession
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(ids), "doc_id").select("doc_id", words_with_lines(F.col("text")).alias("words"))  # SAMPLE_DOCS ids
    sample = sample.select("doc_id", F.size("words").alias("n"), hits(F.col("words")).alias("hits")).withColumn("places", places(F.col("hits")))
    sample = sample.where("n > 1").select("doc_id", "hits", "places", F.explode(F.sequence(F.lit(0), F.col("n") - 2, F.lit(PIECE))).alias("at"))
    end = F.col("at") + PIECE
    grams = F.transform(F.filter("hits", lambda h: (h["i"] >= F.col("at")) & (h["i"] < end)), lambda h: h["g"].cast("string"))
    meets = F.exists("places", lambda p: p["certain"] & (p["lo"] < end) & (p["hi"] >= F.col("at")))
    doubts = F.filter("places", lambda p: (p["lo"] >= F.col("at")) & (p["lo"] < end))
    evidence = F.transform(doubts, lambda p: F.struct(p["f"].alias("f"), _grams_at(F.col("hits"), p).alias("g")))
    pieces = sample.where(~meets).select(F.xxhash64("doc_id", "at").alias("h"), grams.alias("grams"), evidence.alias("doubts"))
    unknown = stage(pieces.orderBy("h", "grams").limit(SAMPLE_PIECES), "license_sample")
    number = {g: str(k + 1) for k, g in enumerate(VOCABULARY)}
    classes = {f: float(i + 1) for i, f in enumerate(FAMILIES)}
    rows = [(classes[f], [number[x] for x in g]) for f, g in fragments()]
    rows += [(0.0, ["-"])] * len(rows)  # unknown has a class even where the sample is empty
    positive = spark.createDataFrame(rows, "label double, grams array<string>")
    half = F.col("h") % 2 == 0
    vectors = CountVectorizerModel.from_vocabulary([number[g] for g in VOCABULARY], "grams", "features").setBinary(True)
    # The sample is bounded: one partition, so that a step of the fit is one task.
    training = vectors.transform(positive.unionByName(unknown.where(half).select(F.lit(0.0).alias("label"), "grams"))).coalesce(1).cache()
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.8, maxIter=30, tol=1e-6, maxBlockSizeInMB=8.0).fit(training)
    training.unpersist()
    matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    weights = [[float(x) for x in row - matrix[0]] for row in matrix[1:]]
    intercepts = [float(x) for x in bias[1:] - bias[0]]
    held = unknown.where(~half).select("doubts").collect()  # SAMPLE_PIECES at most
    scores = sorted((max((_probability(intercepts[p.f - 1] + sum(weights[p.f - 1][g - 1] for g in p.g)) for p in r.doubts), default=0.0) for r in held), reverse=True)
    unstage(unknown)
    return weights, intercepts, least_probability(scores)


def _probability(margin: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-700.0, margin)))


def least_probability(scores: list[float]) -> float:
    """Least probability that at most FALSE_ALARMS of the ``scores`` (descending) reach."""
    allowed = int(FALSE_ALARMS * len(scores))
    return max(0.5, scores[allowed] + 1e-9 if allowed < len(scores) else 0.5)


def _grams_at(found: Column, place: Column) -> Column:
    """Distinct 2-grams of a place, of any template."""
    return F.array_distinct(F.transform(F.slice(found, place["k_lo"], place["k_hi"] - place["k_lo"] + 1), lambda h: h["g"]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_licenses, families, paragraphs)`` per row: lines where a licence
    begins, by family; their families (distinct, sorted, comma-joined) and
    ``family:line`` in order."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights, intercepts, least = train(docs)
    table = F.expr(f"array({', '.join(_array([b, *w], 'double') for w, b in zip(weights, intercepts, strict=True))})")
    names = F.expr(_array(FAMILIES, "string"))

    def likely(found: Column) -> Callable[[Column], Column]:
        def judge(p: Column) -> Column:
            of_family = F.element_at(table, p["f"])
            margin = F.aggregate(_grams_at(found, p), F.element_at(of_family, 1), lambda total, g: total + F.element_at(of_family, g + 1))
            return 1.0 / (1.0 + F.exp(-margin)) >= least

        return judge

    def merged(every: Column) -> Column:
        """(line, family) of places, those of a family that overlap as one."""
        start = F.struct(F.lit(0).alias("f"), F.lit(-1).alias("hi"), F.expr("cast(array() as array<struct<line: int, family: string>>)").alias("at"))

        def add(state: Column, p: Column) -> Column:
            one = F.struct(p["line"].alias("line"), F.element_at(names, p["f"]).alias("family"))
            same = (state["f"] == p["f"]) & (p["lo"] <= state["hi"])
            return F.struct(
                p["f"].alias("f"), F.when(same, F.greatest(state["hi"], p["hi"])).otherwise(p["hi"]).alias("hi"),
                F.when(same, state["at"]).otherwise(F.concat(state["at"], F.array(one))).alias("at"),
            )

        return F.array_sort(F.array_distinct(F.aggregate(F.array_sort(every), start, add, lambda s: s["at"])))

    every = _let(hits(words_with_lines(F.col("text"))), lambda found: merged(F.filter(places(found), likely(found))))
    found = docs.select("doc_id", F.when(F.lower("text").rlike(needed()), every).alias("at"))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("at", lambda x: x["family"]))), ",")
    at = F.array_join(F.transform("at", lambda x: F.concat_ws(":", x["family"], x["line"])), ",")
    return found.select(
        "doc_id", F.coalesce(F.size("at"), F.lit(0)).cast("long").alias("n_licenses"), F.coalesce(families, F.lit("")).alias("families"), F.coalesce(at, F.lit("")).alias("paragraphs")
    )
