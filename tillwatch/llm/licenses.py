"""Licence scans: a paragraph classifier over sparse word n-grams, confirmed by comparison with templates.

Texts are cut into paragraphs at blank lines, these into overlapping windows of words; a single line break is a blank. Word
1-, 2- and 3-grams that the templates have go, as a sparse vector, into a multinomial logistic regression over the licence
families and `unknown`. n-grams of function words alone are no features. The model is trained on the templates below, each in
many mutilated copies among foreign words, and on windows of a bounded sample of the corpus (SAMPLE_DOCS, SAMPLE_LINES) as
`unknown`. A quarter of the training rows is kept out of the fit to calibrate what a prediction must reach, so that at most
one in a thousand unknown rows would. A licence is confirmed where enough of a template's own 3-grams stand in a window and
the model predicts its family, for the window or for the place in it where the template stands; so a window may state several.
Where the words of a place fit several families, only the one that fits best is stated, and none where two fit alike in part.

Null and empty texts have no paragraphs. Repeated rows are scanned each for itself. An empty table gives an empty result.
Columns beside doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import let, stored

#: Words of a window, and from one window's start to the next.
WINDOW, STRIDE = 48, 32
#: Bounds on the corpus' documents and lines that teach what no licence looks like.
SAMPLE_DOCS, SAMPLE_LINES = 500, 4_000
COPIES = 24
#: Share of a template's 3-grams that confirms it.
CONFIRMED = 0.5
UNKNOWN = "unknown"

# How licences are commonly stated, by family.
TEMPLATES = {
    "agpl": ("This work is licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it under the terms of the GNU Affero General Public License",
             "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
             "Licensed under AGPLv3."),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Released under the BSD 3-Clause License."),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
            "Released under CC0 1.0 Universal."),
    "epl": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This work is licensed under the GNU General Public License, version 2.",
            "Licensed under GPLv2.", "Licensed under GPLv3.",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    "isc": ("Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
             "Licensed under LGPLv2.1.", "Licensed under LGPLv3."),
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "proprietary": ("All rights reserved.",
                    "All rights reserved. No part of this work may be reproduced without permission."),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "zlib": ("Released under the zlib License.",
             "This software is provided 'as-is', without any express or implied warranty."),
}
#: Names that a line `SPDX-License-Identifier: ...` states a family by.
IDENTIFIERS = {
    "agpl": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "apache": ("Apache-2.0",),
    "bsd": ("BSD-2-Clause", "BSD-3-Clause"),
    "cc-by": ("CC-BY-4.0",),
    "cc-by-nc": ("CC-BY-NC-4.0",),
    "cc-by-sa": ("CC-BY-SA-4.0",),
    "cc0": ("CC0-1.0",),
    "epl": ("EPL-2.0",),
    "gpl": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "isc": ("ISC",),
    "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",),
    "mpl": ("MPL-2.0",),
    "unlicense": ("Unlicense",),
    "zlib": ("Zlib",),
}
TEMPLATES = {
    family: (*texts, *(f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS.get(family, ())))
    for family, texts in TEMPLATES.items()
}
FAMILIES = (UNKNOWN, *TEMPLATES)
FUNCTION_WORDS = (
    "a all and any are as at be been by following for free from has have in included including into is it made may no not of on or "
    "other part person so such that the this to under use used using with without work you"
)


#: The mark of an identifier line and the three words that it counts as.
MARK = ("spdx-license-identifier", "spdx license identifier")


def license_words(text: Column) -> Column:
    """Runs of letters and digits, also joined by points and hyphens, in lower case."""
    return F.regexp_extract_all(F.replace(F.lower(text), *map(F.lit, MARK)), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), F.lit(0))


def _grams(words: Column, n: int) -> Column:
    if n == 1:
        return words
    at = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(
        at, lambda i: F.concat_ws(" ", *[F.get(words, i + step) for step in range(n)]))).otherwise(F.array().cast("array<string>"))


def ngrams(words: Column) -> Column:
    return F.concat(*[_grams(words, n) for n in (1, 2, 3)])


def _windowed(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (number of its first line) and windows (the words of each)."""

    def cut(lines: Column) -> Column:
        filled = lambda line: F.coalesce(line.rlike(r"[^\s]"), F.lit(False))
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda at: filled(F.get(lines, at)) & ~filled(F.get(lines, at - 1)))
        return let(starts, lambda first: F.transform(first, lambda at, number: F.struct(
            at.alias("paragraph"),
            F.array_join(F.slice(lines, at + 1, F.coalesce(F.get(first, number + 1), F.size(lines)) - at), "\n").alias("text"))))

    parts = docs.select("doc_id", F.explode(let(F.split(F.coalesce("text", F.lit("")), "\n"), cut)).alias("part"))
    windows = let(license_words(F.col("part.text")), lambda words: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - F.lit(WINDOW - STRIDE) - 1, F.lit(0)), F.lit(STRIDE)),
        lambda at: F.slice(words, at + 1, WINDOW)))
    return parts.select("doc_id", "part.paragraph", windows.alias("windows"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph (number of its first line), and the words of each of its windows."""
    return _windowed(docs).select("doc_id", "paragraph", F.explode("windows").alias("words")).filter(F.size("words") >= 3)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, template string").select(
        "family", "template", license_words(F.col("template")).alias("words"))


def vocabulary(spark: SparkSession) -> tuple[list[str], list[str]]:
    """The n-grams of the templates that hold more than function words, and the words that make them do so."""
    common = set(FUNCTION_WORDS.split())
    grams, telling = set(), set()
    for row in _templates(spark).collect():  # the templates of this file
        words = row["words"]
        telling.update(word for word in words if word not in common)
        for n in (1, 2, 3):
            grams.update(" ".join(own) for own in zip(*[words[at:] for at in range(n)]) if set(own) - common)
    return sorted(grams), sorted(telling)


def _template_grams() -> list[tuple[str, list[str]]]:
    """Family and distinct 3-grams of each template."""
    found = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", text.lower().replace(*MARK))
            found.append((family, list(dict.fromkeys(" ".join(own) for own in zip(words, words[1:], words[2:])))))
    return found


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _holds_a_gram(words: Column) -> Column:
    """Whether the words have a 3-gram of any template."""
    return F.arrays_overlap(_grams(words, 3), _literals(sorted({gram for _, grams in _template_grams() for gram in grams})))


def _holds_a_licence(words: Column) -> Column:
    """Whether the words have CONFIRMED of any template's 3-grams."""

    def any_of(own: Column) -> Column:
        held = F.lit(False)
        for _, grams in _template_grams():
            held = held | (F.size(F.array_intersect(own, _literals(grams))) / len(grams) >= CONFIRMED)
        return held

    return F.coalesce(F.when(_holds_a_gram(words), let(_grams(words, 3), any_of)), F.lit(False))


def _stated(words: Column) -> Column:
    """Each family that has CONFIRMED of a template's 3-grams among the words: family, overlap, and the words it stands at.

    A place starts at one of the template's 3-grams and reaches over the first that follows of each other one. Of the places
    that confirm, the one with most of the template in the fewest words is taken.
    """

    def places(own: Column, grams: list[str]) -> Column:
        template = _literals(grams)

        def place(start: Column) -> Column:
            rest = F.slice(own, start + 1, F.size(own))
            ends = F.filter(F.transform(template, lambda gram: F.array_position(rest, gram)), lambda end: end > 0)
            return let(ends, lambda ends: F.struct(
                (F.size(ends) * F.size(ends) / (len(grams) * F.array_max(ends))).alias("density"),
                (F.size(ends) / len(grams)).alias("overlap"), start.alias("start"),
                (F.array_max(ends) + 2).cast("int").alias("length")))

        starts = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda at: F.array_contains(template, F.get(own, at)))
        return F.filter(F.transform(starts, place), lambda found: found["overlap"] >= CONFIRMED)

    def best(family: str, own: Column) -> Column:
        found = F.concat(*[places(own, grams) for name, grams in _template_grams() if name == family])
        return let(found, lambda found: F.struct(
            F.lit(family).alias("family"), F.array_max(F.transform(found, lambda one: one["overlap"])).alias("overlap"),
            F.array_max(found)["start"].alias("start"), F.array_max(found)["length"].alias("length"), F.slice(words, F.array_max(found)["start"] + 1, F.array_max(found)["length"]).alias("place")))

    def families(own: Column) -> Column:
        every = [best(family, own) for family in TEMPLATES]
        return F.filter(F.array(*every), lambda one: one["overlap"].isNotNull())

    return let(_grams(words, 3), families)


def training_rows(docs: DataFrame, lines: int = SAMPLE_LINES) -> DataFrame:
    """label, words and whether the row is kept out of the fit. Of fixed size: COPIES of each template, and `lines` lines.

    Windows of the corpus that hold half of any template's 3-grams are licences themselves and teach nothing, nor do the
    windows beside them, which may have the rest of one.
    """
    spark = docs.sparkSession
    # At most SAMPLE_DOCS ids: a broadcast of bounded size.
    ids = docs.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = _windowed(docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id"))
    held = F.transform("windows", _holds_a_licence)
    near = lambda held, at: F.coalesce(F.get(held, at), F.lit(False))
    clean = let(held, lambda held: F.filter("windows", lambda words, at: ~(near(held, at - 1) | near(held, at) | near(held, at + 1))))
    foreign = sample.select(F.explode(clean).alias("words")).filter(F.size("words") >= 3).distinct()
    foreign = stored(foreign.orderBy(F.xxhash64("words"), "words").limit(lines).withColumn(
        "number", F.row_number().over(Window.orderBy(F.xxhash64("words"), "words"))), "foreign")
    # A copy loses some of its words and stands among the first words of a foreign line.
    copies = _templates(spark).crossJoin(spark.range(COPIES).withColumnRenamed("id", "copy")).withColumn(
        "number", (F.pmod(F.xxhash64("template", "copy"), F.lit(lines)) + 1).cast("int"))
    chance = lambda *of: F.pmod(F.xxhash64(*of), F.lit(100))
    kept = F.filter("words", lambda word, at: (F.col("copy") == 0) | (chance(F.col("copy"), word, at) >= 8))
    around = copies.join(foreign.select("number", F.col("words").alias("foreign")), "number", "left")
    size = (F.pmod(F.col("copy"), F.lit(6)) * 3).cast("int")
    other = F.coalesce("foreign", F.array().cast("array<string>"))
    known = around.select("family", F.concat(F.slice(other, 1, size), kept, F.slice(other, 12, size)).alias("words"), "copy")
    unknown = foreign.select(F.lit(UNKNOWN).alias("family"), "words", F.col("number").alias("copy"))
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    return known.union(unknown).select(
        label.cast("double").alias("label"), "words", (chance(F.col("words"), F.col("copy")) < 25).alias("held_out"))


@dataclass
class Classifier:
    vectors: CountVectorizerModel
    telling: list[str]  # without one of these words a window is the zero vector
    model: LogisticRegressionModel
    needed: float  # probability that a prediction must reach

    def predicted(self, rows: DataFrame) -> DataFrame:
        """The rows with `family` (`unknown` below what is needed) and its probability.

        Rows that are the zero vector are left out where its answer is `unknown`.
        """
        if self.model.predict(Vectors.sparse(len(self.vectors.vocabulary), {})) == 0:
            rows = rows.filter(F.exists("words", lambda word: word.isin(self.telling)))
        answered = self.model.transform(_vectors(rows, self.vectors)).withColumn("probabilities", vector_to_array("probability"))
        probability = F.get("probabilities", F.col("prediction").cast("int"))
        family = F.get(F.array(*map(F.lit, FAMILIES)), F.col("prediction").cast("int"))
        return answered.select(
            *rows.columns, F.when(probability >= self.needed, family).otherwise(UNKNOWN).alias("family"),
            probability.alias("probability"))


def _vectors(rows: DataFrame, vectors: CountVectorizerModel) -> DataFrame:
    return vectors.transform(rows.withColumn("grams", ngrams(F.col("words"))))


def train(docs: DataFrame, lines: int = SAMPLE_LINES) -> Classifier:
    grams, telling = vocabulary(docs.sparkSession)
    vectors = CountVectorizerModel.from_vocabulary(grams, "grams", "features").setBinary(True)
    rows = stored(training_rows(docs, lines).repartition(2), "licence-training")
    # An unknown zero vector stands for all texts without a licence's words, also where the sample has none.
    model = LogisticRegression(maxIter=25, regParam=1e-4, featuresCol="features", labelCol="label").fit(
        _vectors(rows.filter("not held_out").union(
            docs.sparkSession.range(4).select(F.lit(0.0), F.array().cast("array<string>"), F.lit(False))), vectors,
        ).select("label", "features"))
    # Calibration: the largest answer for a licence among kept-out unknown rows, but for one in a thousand.
    answered = model.transform(_vectors(rows.filter("held_out and label = 0"), vectors)).select(
        F.array_max(F.slice(vector_to_array("probability"), 2, len(TEMPLATES))).alias("licence"))
    wrong = answered.agg(F.percentile("licence", 0.999)).first()[0] or 0.0
    return Classifier(vectors, telling, model, max(0.5, wrong))


def _better(other: Column, one: Column) -> Column:
    """Whether `other` takes the place of `one` among the statements of a paragraph.

    Where two windows have the same statement, the one with more of it counts, or else the first. Where two families share
    words of the text, the one that has more of its template there counts; as long as neither has all of it, words that
    fit both alike, such as the mark before a name that no template has, state neither.
    """
    same = (other["family"] == one["family"]) & (other["at"] != one["at"])
    earlier = (other["overlap"] == one["overlap"]) & (other["at"] < one["at"])
    alike = (other["overlap"] == one["overlap"]) & (one["overlap"] < 1)
    return (other["start"] < one["end"]) & (one["start"] < other["end"]) & (
        (same & ((other["overlap"] > one["overlap"]) | earlier))
        | ((other["family"] != one["family"]) & ((other["overlap"] > one["overlap"]) | alike)))


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """One row per window and licence confirmed in it, once where windows overlap: doc_id, paragraph, family, probability and the share of the template."""
    classifier = classifier or train(docs)
    # A template's 3-grams hold a word that tells.
    telling = lambda words: F.exists(words, lambda word: word.isin(classifier.telling)) & _holds_a_gram(words)
    numbered = F.filter(
        F.transform("windows", lambda words, number: F.struct(words.alias("words"), (number * STRIDE).alias("at"))),
        lambda window: telling(window["words"]))
    each = F.flatten(F.transform(numbered, lambda window: F.transform(_stated(window["words"]), lambda one: F.struct(
        one["family"].alias("family"), one["overlap"].alias("overlap"), (window["at"] + one["start"]).alias("start"),
        (window["at"] + one["start"] + one["length"]).alias("end"), one["place"].alias("place"), window["at"].alias("at"),
        window["words"].alias("words")))))
    once = let(each, lambda each: F.filter(each, lambda one: ~F.exists(each, lambda other: _better(other, one))))
    stated = _windowed(docs).select("doc_id", "paragraph", F.explode(once).alias("stated")).withColumn("words", F.col("stated.words"))
    # A window may state several licences, so each is also judged by the words of its own place.
    windows = classifier.predicted(stated).withColumnsRenamed({"family": "by_window", "probability": "window_probability"})
    both = classifier.predicted(windows.withColumn("words", F.col("stated.place")))
    family = F.col("stated.family")
    probability = F.greatest(
        F.when(F.col("by_window") == family, F.col("window_probability")), F.when(F.col("family") == family, F.col("probability")))
    return both.select(
        "doc_id", "paragraph", family.alias("family"), probability.alias("probability"), F.col("stated.overlap").alias("overlap"),
    ).filter("probability is not null")
