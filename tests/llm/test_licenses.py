from __future__ import annotations

import math
import os
import random
import re
from pathlib import Path

import pytest

from tillwatch.llm import licenses

PROSE = "the river ran past the old mill and nobody in the village had seen the water so low for years"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(at, f"{PROSE} {at}\nsome more words about season {at % 7} and the work of {at}", "x") for at in range(120)]
    return spark.createDataFrame(rows, "doc_id long, text string, family string")


@pytest.fixture(scope="module")
def classifier(docs):
    return licenses.train(docs)


def test_families_are_told_apart(spark, docs, classifier):
    rows = [(1000 + at, f"{PROSE}\n\n{text}\n{PROSE}", family) for at, (family, text) in enumerate(
        (family, text) for family, texts in licenses.TEMPLATES.items() for text in texts)]
    found = licenses.scan(docs.union(spark.createDataFrame(rows, docs.schema)), classifier).collect()
    assert {(row["doc_id"], row["family"]) for row in found} == {(doc_id, family) for doc_id, _, family in rows}
    assert all(row["paragraph"] == 2 and row["overlap"] >= 0.99 for row in found)


def test_in_capitals_and_inside_a_long_line(spark, classifier):
    text = "x " * 3000 + "Licensed under the APACHE License,  Version 2.0. " + "y " * 3000
    docs = spark.createDataFrame([(1, text), (2, "released under the mit license")], "doc_id long, text string")
    assert {(row["doc_id"], row["family"]) for row in licenses.scan(docs, classifier).collect()} == {(1, "apache"), (2, "mit")}


def test_words_of_licences_are_no_licence(spark, classifier):
    docs = spark.createDataFrame(
        [(1, "his driving license and the general public were under the version of work he gave"), (2, "permission"), (3, None), (4, "")],
        "doc_id long, text string")
    assert licenses.scan(docs, classifier).count() == 0


def test_unusual_rows(spark, docs, classifier):
    text = "Released under the MIT License."
    rows = spark.createDataFrame([(3, text, "q"), (3, text, "q"), (None, text, "q")], docs.schema)
    assert [row["family"] for row in licenses.scan(rows, classifier).collect()] == ["mit"] * 3
    assert licenses.scan(docs.limit(0)).count() == 0


def test_short_proprietary_statement(spark, classifier):
    docs = spark.createDataFrame(
        [(1, f"{PROSE}\nAll rights reserved."), (2, "ALL RIGHTS RESERVED"), (3, "all the rights of way are reserved to them")],
        "doc_id long, text string")
    assert sorted((row["doc_id"], row["family"]) for row in licenses.scan(docs, classifier).collect()) == [
        (1, "proprietary"), (2, "proprietary")]


def test_every_statement_of_the_test_documents(spark):
    sf = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
    if not sf.exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(str(sf / "documents.parquet"))
    stated = "GNU General Public License|CC BY-NC|MIT License|Apache License|All rights reserved"
    assert licenses.scan(docs).count() == docs.filter(docs.text.rlike(stated)).count()


def test_over_line_breaks_and_side_by_side(spark, classifier):
    gpl, agpl, lgpl = (licenses.TEMPLATES[name][0] for name in ("gpl", "agpl", "lgpl"))
    texts = {
        1: ("Released under\nthe MIT License.", {"mit"}), 2: (f"{PROSE}\nReleased under the\n  MIT License.\n{PROSE}", {"mit"}),
        3: ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", {"apache", "mit"}),
        4: (f"{agpl} {gpl}", {"agpl", "gpl"}), 5: (f"{gpl}\n{lgpl}", {"gpl", "lgpl"}), 6: ("Released under\n\nthe MIT License.", set()),
        7: ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public\nLicense",
            {"gpl"}),
        8: ("\n".join(licenses.TEMPLATES["cc-by-nc"][1].split()), {"cc-by-nc"}),
        9: ("All rights reserved. Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", {"proprietary", "cc-by", "cc-by-sa"}),
    }
    docs = spark.createDataFrame([(at, text) for at, (text, _) in texts.items()], "doc_id long, text string")
    found = [(row["doc_id"], row["family"]) for row in licenses.scan(docs, classifier).collect()]
    assert sorted(found) == sorted((at, family) for at, (_, families) in texts.items() for family in families)


def test_names_and_families_that_share_words(spark, classifier):
    texts = {
        1: ("Licensed under GPLv3.", {"gpl"}), 2: ("// SPDX-License-Identifier: ISC\nint main()", {"isc"}),
        3: ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", {"cc-by-sa"}),
        4: ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"cc-by"}),
        5: ("SPDX-License-Identifier: Artistic-2.0", set()), 6: ("# SPDX-License-Identifier: GPL-2.0-or-later", {"gpl"}),
        7: ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
        8: ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", {"lgpl"}),
        9: (licenses.TEMPLATES["agpl"][0], {"agpl"}), 10: ("SPDX-License-Identifier: MIT", {"mit"}),
    }
    docs = spark.createDataFrame([(at, text) for at, (text, _) in texts.items()], "doc_id long, text string")
    found = [(row["doc_id"], row["family"]) for row in licenses.scan(docs, classifier).collect()]
    assert sorted(found) == sorted((at, family) for at, (_, families) in texts.items() for family in families)


def spelled(text):
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower().replace("spdx-license-identifier", "spdx license identifier"))


def grams(words, *sizes):
    return [" ".join(words[at:at + n]) for n in sizes for at in range(len(words) - n + 1)]


def plain_paragraphs(text):
    lines = (text or "").split("\n")
    starts = [at for at, line in enumerate(lines) if line.strip() and (at == 0 or not lines[at - 1].strip())]
    for at, end in zip(starts, [*starts[1:], len(lines)]):
        yield at, spelled("\n".join(lines[at:end]))


def plain_statements(words):
    """(family, overlap, start, end, window, place) of every window and family, by trying each place."""
    last = max(len(words) - (licenses.WINDOW - licenses.STRIDE) - 1, 0)
    for at in range(0, last + 1, licenses.STRIDE):
        window = words[at:at + licenses.WINDOW]
        own = grams(window, 3)
        for family, texts in licenses.TEMPLATES.items():
            found = []
            for text in texts:
                template = list(dict.fromkeys(grams(spelled(text), 3)))
                for start in range(len(own)):
                    ends = [own.index(gram, start) - start + 1 for gram in template if gram in own[start:]]
                    if own[start] in template and len(ends) / len(template) >= licenses.CONFIRMED:
                        density = len(ends) * len(ends) / (len(template) * max(ends))
                        found.append((density, len(ends) / len(template), start, max(ends) + 2))
            if found:
                _, _, start, length = max(found)
                yield family, max(one[1] for one in found), at + start, at + start + length, at, window, window[start:start + length]


def plain_scan(docs, classifier):
    matrix, intercepts = classifier.model.coefficientMatrix.toArray(), classifier.model.interceptVector.toArray()
    places = {gram: at for at, gram in enumerate(classifier.vectors.vocabulary)}

    def predicted(words):
        on = sorted({places[gram] for gram in grams(words, 1, 2, 3) if gram in places})
        margins = matrix[:, on].sum(axis=1) + intercepts
        odds = [math.exp(own - max(margins)) for own in margins]
        best = odds.index(max(odds))
        return (licenses.FAMILIES[best] if 1 / sum(odds) >= classifier.needed else licenses.UNKNOWN), 1 / sum(odds)

    for doc_id, text in docs:
        for paragraph, words in plain_paragraphs(text):
            every = list(plain_statements(words))
            for family, overlap, start, end, at, window, place in every:
                rivals = [own for own in every if own[2] < end and start < own[3]]
                if any(own[0] == family and (-own[1], own[4]) < (-overlap, at) for own in rivals):
                    continue
                if any(own[0] != family and (own[1] > overlap or own[1] == overlap < 1) for own in rivals):
                    continue
                sure = [p for name, p in map(predicted, (window, place)) if name == family]
                if sure:
                    yield doc_id, paragraph, family, round(max(sure), 6), round(overlap, 9)


def test_like_brute_force(spark, classifier):
    chance = random.Random(3)
    texts = [text for own in licenses.TEMPLATES.values() for text in own]
    found = [None, "", "\n\n", "x"]
    for _ in range(60):
        parts = []
        for _ in range(chance.randrange(1, 7)):
            words = chance.choice([*texts, PROSE, PROSE, PROSE * 4]).split()
            at = chance.choice([0, 0, 0, chance.randrange(len(words))])
            parts.append(chance.choice([" ", " ", "\n"]).join(word for word in words[at:] if chance.random() > 0.04))
        found.append(chance.choice([" ", "\n", "\n\n"]).join(parts))
    docs = list(enumerate(found))
    got = sorted((row["doc_id"], row["paragraph"], row["family"], round(row["probability"], 6), round(row["overlap"], 9))
                 for row in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"), classifier).collect())
    assert got == sorted(plain_scan(docs, classifier)) and len({row[2] for row in got}) > 8
