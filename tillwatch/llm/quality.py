"""Quality rules as a short-circuit cascade, in built-in expressions only.

Each rule is a condition that rejects a document. A sample gives each rule's cost (seconds to evaluate it) and its
selectivity (share it rejects); the cascade asks the rules in the order of rejections per second, and asks no further
once one has rejected. The order changes what the verdict costs, never the verdict.

Null text counts as empty. An empty text has no words and is rejected by the first base rule. Equal rows get equal
verdicts, an empty table gives an empty result, and columns beside the text are carried along untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import BLANKS, WORD, let, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2_000
SAMPLE_PARTS = 4


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return F.char_length(F.translate(_known(text), BLANKS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    known = _known(text)
    return (F.char_length(known) - F.char_length(F.translate(known, SYMBOLS, ""))).cast("long")


def n_capitals(text: Column) -> Column:
    return F.regexp_count(_known(text), F.lit(r"\p{Lu}")).cast("long")


def _worded_lines(text: Column) -> Column:
    return F.filter(F.split(_known(text), r"\n"), lambda line: line.rlike(WORD))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(_worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_lines(text: Column) -> Column:
    return F.size(_worded_lines(text)).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words that stand in a window of eight words found twice or more in the text.

    Windows are compared by 64-bit hashes, so the work grows with the text's length and not with its square.
    """
    return let(F.transform(words(text), lambda word: F.xxhash64(word)), _covered_by_repeats).cast("long")


def _covered_by_repeats(hashes: Column) -> Column:
    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW),
        lambda at: F.xxhash64(*[F.get(hashes, at + step) for step in range(WINDOW)]),
    )
    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(let(
        windows,
        lambda own: F.when(F.size(F.array_distinct(own)) == F.size(own), 0).otherwise(_covered(own)),
    ))


def _covered(windows: Column) -> Column:
    placed = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
    starts = let(placed, lambda own: F.sort_array(F.transform(
        F.filter(own, lambda x, i: (x["window"] == F.get(own, i - 1)["window"])
                 | F.coalesce(x["window"] == F.get(own, i + 1)["window"], F.lit(False))),
        lambda x: x["at"],
    )))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("covered")),
        lambda so_far, at: F.struct(
            (at + WINDOW).alias("end"),
            (so_far["covered"] + F.least(F.lit(WINDOW), at + WINDOW - so_far["end"])).alias("covered"),
        ),
        lambda total: total["covered"],
    )


def _known(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


MEASURES = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_capitals": n_capitals,
    "n_lines": n_lines, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """Rejects where `test` holds of its measures."""

    name: str
    measures: tuple[str, ...]
    test: Callable[..., Column]

    def rejects(self, measured: Mapping[str, Column]) -> Column:
        return self.test(*[measured[name] for name in self.measures])


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 20),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda repeated, n: 100 * repeated > 30 * n),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_symbols", "n_words"), lambda symbols, n: 10 * symbols > n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda repeated, n: 100 * repeated > 30 * n),
    Rule("capitals", ("n_capitals", "word_chars"), lambda capitals, chars: 100 * capitals > 40 * chars),
    Rule("long_words", ("word_chars", "n_words"), lambda chars, n: chars > 20 * n),
)


def lazy(text: Column, rule: Rule) -> dict[str, Column]:
    return {name: MEASURES[name](text) for name in rule.measures}


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Cost and selectivity of each rule on a sample of about `sample_rows` documents, best value first.

    A rule is timed on the stored sample twice and the better time counts, less that of reading the sample alone.
    """
    rows = docs.count()
    share = min(1.0, sample_rows / rows) if rows else 1.0
    sample = stored(docs.select("text").sample(fraction=share, seed=seed).repartition(SAMPLE_PARTS), "quality-sample")
    text = F.col("text")
    rejections = sample.agg(F.count("*").alias("rows"), *[
        F.count_if(rule.rejects(lazy(text, rule))).alias(rule.name) for rule in rules
    ]).first()

    def seconds(check: Column) -> float:
        best = None
        for _ in range(2):
            begun = time.perf_counter()
            sample.agg(F.count_if(check)).first()
            took = time.perf_counter() - begun
            best = took if best is None else min(best, took)
        return best

    idle = seconds(F.length(text) < 0)
    found = [
        Estimate(rule, max(seconds(rule.rejects(lazy(text, rule))) - idle, 1e-3), rejections[rule.name] / max(rejections["rows"], 1))
        for rule in rules
    ]
    return sorted(found, key=lambda own: (-own.worth, own.seconds, own.rule.name))


def first_rejection(order: Sequence[Rule], text: Column, measured: Mapping[str, Column] | None = None) -> Column:
    """The name of the first rule, in this order, that rejects the text; null if none does.

    Later branches of a CASE are evaluated only where the earlier ones fail, which is the short circuit. The text is split
    into words once for all rules that count them. Measures that are at hand as columns are used instead.
    """
    if measured is not None:
        return _cascade(order, measured)
    return let(words(text), lambda own: _cascade(order, {name: take(text) for name, take in MEASURES.items()} | of_words(own)))


def of_words(own: Column) -> dict[str, Column]:
    """The measures that are taken of a text's words."""
    return {
        "n_words": F.size(own).cast("long"),
        "n_repeat_words": let(F.transform(own, lambda word: F.xxhash64(word)), _covered_by_repeats).cast("long"),
    }


def _cascade(order: Sequence[Rule], measured: Mapping[str, Column]) -> Column:
    verdict = None
    for rule in order:
        branch = rule.rejects(measured)
        verdict = F.when(branch, rule.name) if verdict is None else verdict.when(branch, rule.name)
    return verdict


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with `rejected_by`, the rule that turned them away, or null for those to keep."""
    order = [own.rule for own in estimate(docs, rules, sample_rows)]
    return docs.withColumn("rejected_by", first_rejection(order, F.col("text")))


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    order = [own.rule for own in estimate(docs, rules, sample_rows)]
    return docs.filter(first_rejection(order, F.col("text")).isNull())


def report(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: measures, base verdict and the cascade's verdict.

    The measures that the report lists are taken of every text. Those that a rule alone asks for stand inside the cascade,
    so they are taken of texts that no earlier rule has rejected.
    """
    text = F.col("text")
    order = [own.rule for own in estimate(docs, rules, sample_rows)]
    # One pass splits each text once for both counts of words.
    measured = docs.select("doc_id", "text", let(words(text), lambda own: F.struct(
        *[measure.alias(name) for name, measure in of_words(own).items()],
    )).alias("counted"), *[MEASURES[name](text).alias(name) for name in ("word_chars", "n_symbols", "n_dup_lines")])
    known = {name: take(text) for name, take in MEASURES.items()} | {
        name: F.col("counted")[name] for name in ("n_words", "n_repeat_words")
    } | {name: F.col(name) for name in ("word_chars", "n_symbols", "n_dup_lines")}
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.rejects(known)
    return measured.select(
        "doc_id", known["n_words"].alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        known["n_repeat_words"].alias("n_repeat_words"), base.alias("base_failed"),
        first_rejection(order, text, known).isNull().alias("kept"),
    )
