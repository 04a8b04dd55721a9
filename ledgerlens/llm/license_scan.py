"""License scan with a trained paragraph classifier, in DataFrame functions only.

Paragraphs are the lines of a text and, for notices that are wrapped, its runs of
adjacent lines with words (comment marks are no words), less the lines that are
confirmed on their own. A run of lines is a finding only if a notice confirms it.
A sparse logistic regression (elastic net)
on word n-grams of up to three words scores each line for the licence families
and for "unknown". It is trained on the notices in ``NOTICES``, whole, in part and
amid other words, and on lines of a bounded sample of the corpus that resemble no
notice (class unknown). A temperature, and the least probability at which a family
is believed rather than unknown, are calibrated on rows kept back. A believed family
must then be confirmed by comparison with its notices: most n-grams of one of them
must be in the line.

Scoring is one expression per row: the hashed n-grams of a line are intersected
with those that have a weight or are in a notice, and only lines that have some are
scored, so a text is neither exploded nor shuffled. Those of a run of lines are the
ones of its lines and the ones across their borders; it is scored only if a notice
is largely in it.

Defined cases: null and empty texts have no licence; rows are scanned one by one,
repeated ones too; ties go to the first family in order; an empty table gives an
empty result (the notices alone train the model); other columns are ignored. A
line of any length is one paragraph, and so is a run of any number of lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import hashed_rows, id_text, stored

MAX_UNKNOWN = 2000       # corpus lines the classifier is trained on
MAX_FEATURES = 1 << 12
CONFIRM = 0.6            # share of a notice's n-grams that must be in the line
SHORT = 6                # a notice of so few n-grams must be there whole
RESERVED = "proprietary"
UNKNOWN = "unknown"

# Licence families and short notices by which they are known.
NOTICES = {
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.",
             "This program is free software under the terms of the GNU Affero General Public License."),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "You may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
                   "SPDX-License-Identifier: Apache-2.0"),
    "bsd": ("Released under the BSD License.",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "cc-by": ("Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("Released under CC0 1.0.",
            "To the extent possible under law, the author has waived all copyright and related rights to this work "
            "under CC0 1.0 Universal Public Domain Dedication."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "Licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later"),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.",
             "You can redistribute it under the terms of the GNU Lesser General Public License."),
    "mit": ("Released under the MIT License.",
            "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction",
            "SPDX-License-Identifier: MIT"),
    "mpl-2.0": ("Licensed under the Mozilla Public License, Version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "proprietary": ("All rights reserved.",
                    "All rights reserved. Unauthorized copying of this file is strictly prohibited.",
                    "This document is proprietary and confidential and may not be distributed without permission."),
}
FAMILIES = [*sorted(NOTICES), UNKNOWN]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda variable holds it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(of: Column, as_text: bool = False) -> Column:
    """Distinct n-grams of one to three words, hashed unless ``as_text``."""
    def gram(*parts):
        return F.concat_ws(" ", *parts) if as_text else F.xxhash64(*parts)

    none = F.array().cast("array<string>" if as_text else "array<bigint>")

    def every(w: Column) -> Column:
        n = F.size(w)
        two = F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: gram(F.get(w, i - 1), F.get(w, i))))
        three = F.when(n >= 3, F.transform(F.sequence(F.lit(2), n - 1),
                                           lambda i: gram(F.get(w, i - 2), F.get(w, i - 1), F.get(w, i))))
        return F.array_distinct(F.concat(F.transform(w, lambda x: gram(x)), *[F.coalesce(x, none) for x in (two, three)]))

    return let(of, every)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


# --------------------------------------------------------------- training
def notices(spark: SparkSession) -> DataFrame:
    """(family, text): one row per notice."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f in sorted(NOTICES) for t in NOTICES[f]]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.family", "r.text")


def _notice_grams(spark: SparkSession) -> Column:
    """All notices as a constant array of (family, hashed n-grams)."""
    rows = notices(spark).select("family", grams(words(F.col("text"))).alias("g")).collect()
    return F.array(*[F.struct(F.lit(r.family).alias("family"), F.array(*map(F.lit, r.g)).alias("g")) for r in rows])


def _resemblance(g: Column, known: Column, family: Column | None = None) -> Column:
    """The largest share of a notice's n-grams among those of a line (of the
    notices of ``family``, or of all); a short notice counts whole or not."""
    def share(own: Column, t: Column) -> Column:
        of_it = F.size(F.array_intersect(own, t["g"])) / F.size(t["g"])
        return F.when(F.size(t["g"]) > SHORT, of_it).otherwise(F.floor(of_it).cast("double"))

    of = known if family is None else F.filter(known, lambda t: t["family"] == family)
    return let(g, lambda own: F.coalesce(F.array_max(F.transform(
        of, lambda t: share(own, t))), F.lit(0.0)))


def training_rows(docs: DataFrame, max_unknown: int) -> DataFrame:
    """(label, g, back): text n-grams of notices and of corpus lines; one row in
    five is kept back for calibration."""
    spark = docs.sparkSession
    every = F.explode(lines(F.col("text")))
    sampled = (hashed_rows(id_text(docs), max_unknown // 4)
               .select(every.alias("text")).filter("trim(text) <> ''")
               .orderBy(F.xxhash64("text"), "text").limit(max_unknown))
    sampled = sampled.withColumn("w", words(F.col("text"))).filter(F.size("w") > 0)
    other = stored(sampled.select("w").filter(
        _resemblance(grams(F.col("w")), _notice_grams(spark)) < CONFIRM / 2), "unknown-lines")
    # each notice: whole, with every fourth word left out, its halves, and between words of corpus lines
    around = (other.orderBy(F.xxhash64("w"), "w").limit(12)
              .select(F.slice("w", 1, 12).alias("a"), (F.row_number().over(Window.orderBy("w")) - 1).alias("k")))
    base = notices(spark).select("family", words(F.col("text")).alias("w"))

    def without(k: int) -> Column:
        return F.filter("w", lambda x, i: i % 4 != k)

    half = F.ceil(F.size("w") / 2).cast("int")
    parts = base.select("family", F.explode(F.array(
        F.col("w"), *map(without, range(4)),
        F.slice("w", F.lit(1), half), F.slice("w", half, half + 1))).alias("w"))
    mixed = (base.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11)))).join(around, "k")
             .select("family", F.concat("a", "w", F.reverse("a")).alias("w")))
    number = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")).cast("double") - 1
    rows = (parts.unionByName(mixed).withColumn("label", number).select("label", "w")
            .unionByName(other.select(F.lit(float(len(FAMILIES) - 1)).alias("label"), "w"))
            .coalesce(2))  # a bounded set that every iteration of the training reads
    return stored(rows.select("label", grams(F.col("w"), as_text=True).alias("g"),
                              (F.pmod(F.xxhash64("w"), F.lit(5)) == 0).alias("back")), "license-training")


class Model:
    """Weights per n-gram and family, intercepts, temperature, threshold."""

    def __init__(self, hashes: list[int], weights: list[list[float]], bias: list[float]):
        self.hashes, self.weights, self.bias = hashes, weights, bias
        self.temperature, self.threshold = 1.0, 0.5

    def hits(self, g: Column) -> Column:
        return F.array_intersect(g, F.array(*map(F.lit, self.hashes)).cast("array<bigint>"))

    def scores(self, hits: Column) -> Column:
        """The score of every family for a line with these weighted n-grams."""
        if not self.hashes:
            return F.array(*map(F.lit, self.bias))
        table = F.map_from_arrays(F.array(*map(F.lit, self.hashes)),
                                  F.array(*[F.array(*map(F.lit, w)) for w in self.weights]))
        return F.aggregate(hits, F.array(*map(F.lit, self.bias)),
                           lambda acc, h: F.zip_with(acc, F.element_at(table, h), lambda a, b: a + b))

    def probabilities(self, scores: Column, temperature: float | None = None) -> Column:
        t = F.lit(temperature or self.temperature)
        shares = let(scores, lambda s: let(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp((x - top) / t))))
        return let(shares, lambda e: let(F.aggregate(e, F.lit(0.0), lambda x, y: x + y),
                                         lambda total: F.transform(e, lambda x: x / total)))


def train(docs: DataFrame, max_unknown: int = MAX_UNKNOWN) -> Model:
    rows = training_rows(docs, max_unknown)
    fit = rows.filter("not back")
    vocabulary = CountVectorizer(inputCol="g", outputCol="features", vocabSize=MAX_FEATURES, minDF=2.0,
                                 binary=True).fit(fit)
    fitted = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40,
                                standardization=False).fit(vocabulary.transform(fit).select("label", "features"))
    weights = fitted.coefficientMatrix.toArray()
    bias = [float(x) for x in fitted.interceptVector.toArray()]
    bias += [-50.0] * (len(FAMILIES) - len(bias))  # no corpus line: unknown has no weight of its own
    used = [i for i in range(weights.shape[1]) if weights[:, i].any()]
    texts = [vocabulary.vocabulary[i] for i in used]
    spark = docs.sparkSession
    if texts:
        w = F.split("t", " ")
        hashed = F.when(F.size(w) == 1, F.xxhash64(F.get(w, F.lit(0)))).when(
            F.size(w) == 2, F.xxhash64(F.get(w, F.lit(0)), F.get(w, F.lit(1)))).otherwise(
            F.xxhash64(F.get(w, F.lit(0)), F.get(w, F.lit(1)), F.get(w, F.lit(2))))
        table = spark.range(1).select(F.posexplode(F.array(*map(F.lit, texts))).alias("i", "t"))
        hashes = [r.h for r in table.select("i", hashed.alias("h")).orderBy("i").collect()]
    else:
        hashes = []
    per_gram = [[float(x) for x in weights[:, i]] + [0.0] * (len(FAMILIES) - weights.shape[0]) for i in used]
    model = Model(hashes, per_gram, bias)
    _calibrate(model, rows.filter("back"), texts)
    return model


def _calibrate(model: Model, rows: DataFrame, texts: list[str]) -> None:
    """Temperature of least loss on the rows kept back, then the least
    probability that parts families from unknown best."""
    at = F.array(*map(F.lit, texts)).cast("array<string>")
    by_text = F.map_from_arrays(at, F.array(*map(F.lit, model.hashes)).cast("array<bigint>")) if texts else None
    hits = (F.transform(F.array_intersect("g", at), lambda t: F.element_at(by_text, t)) if texts
            else F.array().cast("array<bigint>"))
    scored = stored(rows.select("label", model.scores(hits).alias("s")), "license-calibration")
    grid = [0.25 * 1.35 ** k for k in range(12)]
    losses = scored.agg(*[F.avg(-F.log(F.greatest(F.lit(1e-9), F.get(
        model.probabilities(F.col("s"), t), F.col("label").cast("int"))))).alias(f"t{k}") for k, t in enumerate(grid)]).first()
    if losses[0] is None:
        return
    model.temperature = grid[min(range(len(grid)), key=lambda k: losses[k])]
    last = len(FAMILIES) - 1
    best = F.array_max(F.slice(model.probabilities(F.col("s")), 1, last))
    cuts = [0.05 * k for k in range(4, 20)]
    right = scored.withColumn("p", best).agg(*[
        F.avg(((F.col("p") >= c) == (F.col("label") < last)).cast("double")).alias(f"c{k}")
        for k, c in enumerate(cuts)]).first()
    top = max(right)
    good = [c for k, c in enumerate(cuts) if right[k] == top]
    model.threshold = good[len(good) // 2]  # the middle of the best stretch


# --------------------------------------------------------------- operator
def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, license (the family of its surest confirmed
    line or run of lines, null if none; rights reserved yield to a licence that is
    granted), n_licenses (confirmed ones), n_unconfirmed (lines whose family no
    notice confirms), matches (line and last, of a run; family, probability,
    similarity, confirmed)."""
    model = model or train(docs)
    spark = docs.sparkSession
    known = _notice_grams(spark)
    noticed = notices(spark).select(F.explode(grams(words(F.col("text")))).alias("h")).distinct().collect()
    marks = F.array(*map(F.lit, sorted({*model.hashes, *(r.h for r in noticed)}))).cast("array<bigint>")
    last = len(FAMILIES) - 1
    names = F.array(*map(F.lit, FAMILIES))
    border = F.array(F.lit(""))  # between words that do not follow each other: no word is empty

    def judged(own: Column, first: Column, final: Column) -> Column:
        """The finding of lines with these n-grams: null where none has a weight or no family is believed."""
        def believed(hits: Column) -> Column:
            return let(model.probabilities(model.scores(hits)), lambda p: let(
                F.array_max(F.slice(p, 1, last)), lambda top: F.when(top >= model.threshold, let(
                    F.get(names, (F.array_position(p, top) - 1).cast("int")), lambda family: let(
                        _resemblance(own, known, family), lambda same: F.struct(
                            first.alias("line"), final.alias("last"), family.alias("family"),
                            F.round(top, 6).alias("probability"), F.round(same, 6).alias("similarity"),
                            (same >= CONFIRM).alias("confirmed")))))))
        return F.when(F.size(own) > 0, let(model.hits(own), lambda hits: F.when(F.size(hits) > 0, believed(hits))))

    def line_of(line: Column, number: Column) -> Column:
        """own: n-grams of the line that matter; ends: its words, without those in the middle; found."""
        return let(words(line), lambda w: let(F.array_intersect(grams(w), marks), lambda own: F.struct(
            own.alias("own"),
            F.when(F.size(w) > 4, F.concat(F.slice(w, 1, 2), border, F.slice(w, -2, 2))).otherwise(w).alias("ends"),
            judged(own, number, number).alias("found"))))

    def sure(line: Column) -> Column:
        return F.coalesce(line["found"]["confirmed"], F.lit(False))

    def run_of(every: Column, run: Column) -> Column:
        """The finding of a run of lines, null unless confirmed."""
        def own(part: Column) -> Column:
            rest = F.transform(part, lambda x: F.when(sure(x), none).otherwise(x["own"]))
            ends = F.transform(part, lambda x: F.when(sure(x), border).otherwise(x["ends"]))
            return F.array_distinct(F.concat(F.flatten(rest), F.array_intersect(grams(F.flatten(ends)), marks)))

        none = F.array().cast("array<bigint>")
        found = let(F.slice(every, run["a"] + 1, run["b"] - run["a"] + 1), lambda part: let(own(part), lambda g: F.when(
            _resemblance(g, known) >= CONFIRM, judged(g, run["a"], run["b"]))))
        return let(found, lambda x: F.when(x["confirmed"], x))

    def findings(every: Column) -> Column:
        n = F.size(every)
        at = F.sequence(F.lit(0), n - 1)

        def blank(i: Column) -> Column:
            return F.coalesce(F.size(F.get(every, i)["ends"]) <= 0, F.lit(True))

        starts = F.filter(at, lambda i: ~blank(i) & ((i == 0) | blank(i - 1)))
        finals = F.filter(at, lambda i: ~blank(i) & ((i == n - 1) | blank(i + 1)))
        runs = F.filter(F.zip_with(starts, finals, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                        lambda r: r["a"] < r["b"])
        lone = F.filter(F.transform(every, lambda x: x["found"]), lambda x: x.isNotNull())
        wrapped = F.filter(F.transform(runs, lambda r: run_of(every, r)), lambda x: x.isNotNull())
        # a line that a confirmed run explains is not unconfirmed
        return let(wrapped, lambda many: F.concat(F.filter(lone, lambda x: x["confirmed"] | ~F.exists(
            many, lambda m: (m["family"] == x["family"]) & x["line"].between(m["line"], m["last"]))), many))

    done = id_text(docs).select("doc_id", let(
        F.transform(lines(F.col("text")), line_of), findings).alias("matches"))
    confirmed = F.filter("matches", lambda x: x["confirmed"])
    surest = F.array_max(F.transform(confirmed, lambda x: F.struct(
        (x["family"] != RESERVED).alias("granted"), x["similarity"].alias("s"), x["probability"].alias("p"), (-x["line"]).alias("l"), x["family"].alias("family"))))
    return done.select("doc_id", surest["family"].alias("license"), F.size(confirmed).cast("long").alias("n_licenses"),
                       (F.size("matches") - F.size(confirmed)).cast("long").alias("n_unconfirmed"), "matches")
