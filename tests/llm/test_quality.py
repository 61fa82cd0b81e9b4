from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter

import pytest

from tillwatch.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[at:at + 8]) for at in range(len(words) - 7)]
    times = Counter(windows)
    covered = {at + step for at, own in enumerate(windows) if times[own] > 1 for step in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    measures = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(own) for own in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }
    n, lines, capitals = len(words), len(lines), sum(unicodedata.category(own) == "Lu" for own in text)
    base = n < 20 or 100 * len(covered) > 30 * n
    rejected = base or 10 * measures["n_symbols"] > n or 100 * measures["n_dup_lines"] > 30 * lines
    rejected = rejected or 100 * capitals > 40 * measures["word_chars"] or measures["word_chars"] > 20 * n
    return {**measures, "base_failed": base, "kept": not rejected}


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(8)
    word = lambda: "".join(chance.choice("abcdeÉßŌ字#😀") for _ in range(chance.randrange(1, 7)))
    found = [None, "", " \t\n", "\u00a0", "x", "a b\x0bc\x0cd\r\ne\n\ne\n e"]
    for _ in range(60):
        part = [word() for _ in range(chance.randrange(1, 40))]
        again = part * chance.choice([1, 1, 1, 2, 3])
        found.append(chance.choice([" ", "\n", "  ", "\n \n"]).join(again))
    return found + [" ".join(map(str, range(60_000))), "same words again and again " * 3000, "LOUD " * 40, "long" * 30 + " b" * 30]


def test_like_brute_force(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality.report(docs).collect():
        assert row.asDict() == {"doc_id": row["doc_id"], **brute(texts[row["doc_id"]])}, texts[row["doc_id"]]


def test_measures_of_one_rule_stand_inside_the_cascade(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines = quality.report(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    asking = [line for line in lines if r"\p{Lu}" in line]
    assert len(asking) == 1 and "CASE WHEN" in asking[0] and asking[0].index("CASE WHEN") < asking[0].index(r"\p{Lu}")


def test_the_order_changes_no_verdict(spark, texts):
    docs = spark.createDataFrame([(at, text, "x") for at, text in enumerate(texts)], "doc_id long, text string, n_words string")
    want = sorted(at for at, text in enumerate(texts) if brute(text)["kept"])
    for rules in (quality.RULES, quality.RULES[::-1]):
        kept = quality.keep(docs, rules)
        assert kept.columns == docs.columns and sorted(row["doc_id"] for row in kept.collect()) == want
    assert sorted(row["doc_id"] for row in quality.judge(docs).filter("rejected_by is null").collect()) == want
    assert quality.keep(docs.limit(0)).count() == 0 and quality.report(docs.limit(0)).count() == 0


def test_rules_are_ordered_by_rejections_per_cost(spark, texts):
    docs = spark.createDataFrame([(text,) for text in texts], "text string")
    found = quality.estimate(docs)
    assert [own.worth for own in found] == sorted((own.worth for own in found), reverse=True)
    assert {own.rule for own in found} == set(quality.RULES) and all(0 <= own.rejected <= 1 for own in found)
