"""Relevance ranking and paging."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Row, functions as F

from tillwatch.functions.text import has_word, query_words, tokens

# The usual BM25 parameters.
K1, B = 1.2, 0.75


def _lowered(docs: DataFrame, text: str) -> DataFrame:
    # Generated, the lower-case text is a column of its own, made once however often it is tested.
    return docs.where(F.col(text).isNotNull()).withColumn("_low", F.explode(F.array(F.lower(text))))


def word_counts(docs: DataFrame, text: str, keyword: str, *by: str) -> DataFrame:
    """What ranking has to know of a collection: rows, words, and rows with each word of the keyword, per `by`.

    Counts of parts, such as days, add up, so they can be kept beside a table and a new day counted by itself.
    """
    lengths = _lowered(docs, text).select(*by, tokens(F.col("_low")).alias("_bag")).select(
        *by, F.size("_bag").alias("_len"),
        *[F.array_contains("_bag", w).cast("bigint").alias(f"_has{i}") for i, w in enumerate(query_words(keyword))],
    )
    return lengths.groupBy(*by).agg(
        F.count("*").alias("rows"), F.sum("_len").alias("words"),
        *[F.sum(f"_has{i}").alias(f"df{i}") for i in range(len(query_words(keyword)))],
    )


#: Schema of the counts kept of a collection in parts, such as days: documents with each word, and, under the empty word, all
#: documents and their words.
TERMS_DDL = "{by} STRING, word STRING, rows BIGINT, words BIGINT"


def term_changes(new: DataFrame, replaced: DataFrame, text: str, by: str) -> DataFrame:
    """What documents that come in, and those they replace, change in the counts by part and word."""
    signed = new.select(by, text, F.lit(1).alias("_n")).unionByName(replaced.select(by, text, F.lit(-1).alias("_n")))
    bags = _lowered(signed, text).select(by, "_n", tokens(F.col("_low")).alias("_bag"))
    whole = F.array(F.struct(F.lit("").alias("word"), F.size("_bag").alias("size")))
    each = F.transform(F.array_distinct("_bag"), lambda word: F.struct(word.alias("word"), F.lit(0).alias("size")))
    counted = bags.select(by, "_n", F.explode(F.concat(whole, each)).alias("_term")).groupBy(by, F.col("_term.word").alias("word")).agg(
        F.sum("_n").cast("bigint").alias("rows"), F.sum(F.col("_n") * F.col("_term.size")).cast("bigint").alias("words"))
    return counted.where("rows <> 0 OR words <> 0")


def added_up(changes: DataFrame, known: DataFrame, by: str) -> DataFrame:
    """The counts after `changes`, of the parts and words that change."""
    before = known.select(F.col(by).alias("_by"), F.col("word").alias("_word"), F.col("rows").alias("_rows"), F.col("words").alias("_words"))
    same = F.col(by).eqNullSafe(F.col("_by")) & (F.col("word") == F.col("_word"))
    return changes.join(before, same, "left").select(
        by, "word", (F.col("rows") + F.coalesce("_rows", F.lit(0))).alias("rows"),
        (F.col("words") + F.coalesce("_words", F.lit(0))).alias("words"))


def kept_word_counts(terms: DataFrame, keyword: str, by: str) -> DataFrame:
    """`word_counts` from kept counts, of which only the rows of the keyword's words and the empty word are read."""
    words = query_words(keyword)

    def of(word: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("word") == word, F.col(column))), F.lit(0))

    return terms.where(F.col("word").isin("", *words)).groupBy(by).agg(
        of("", "rows").alias("rows"), of("", "words").alias("words"),
        *[of(word, "rows").alias(f"df{i}") for i, word in enumerate(words)])


def scored(docs: DataFrame, text: str, keyword: str, digits: int = 6, counts: DataFrame | None = None) -> DataFrame:
    """Rows of `docs` that hold a word of `keyword`, with their BM25 `score`.

    Term counts are taken inside each row, so ranking shuffles no text: the collection's counts come from one aggregate
    read back as a scalar subquery, and scoring is a second narrow pass that skips rows without any of the words before
    it splits them. `counts` are those of the collection, of all its parts, where `docs` is only some of it.
    """
    words = query_words(keyword)
    if not words:
        return docs.limit(0).withColumn("score", F.lit(None).cast("double"))
    low = _lowered(docs, text)
    bag = tokens(F.col("_low"))

    def times(word: str) -> Column:
        return F.size("_bag") - F.size(F.array_remove("_bag", word))

    counts = word_counts(docs, text, keyword) if counts is None else counts
    totals = counts.agg(
        F.struct(
            F.sum("rows").alias("rows"),
            (F.sum("words") / F.sum("rows")).alias("avg_len"),
            *[F.sum(f"df{i}").alias(f"df{i}") for i in range(len(words))],
        ).alias("stats")
    )
    stats = F.col("_stats")
    hits = (
        low.where(has_word(F.col("_low"), words))
        .withColumn("_bag", bag)
        .withColumn("_stats", totals.scalar())
        .withColumn("_norm", F.lit(1 - B) + F.lit(B) * F.size("_bag") / stats["avg_len"])
    )

    def weight(i: int, word: str) -> Column:
        with_word = stats[f"df{i}"]
        idf = F.log(F.lit(1.0) + (stats["rows"] - with_word + F.lit(0.5)) / (with_word + F.lit(0.5)))
        tf = times(word)
        return idf * tf * F.lit(K1 + 1) / (tf + F.lit(K1) * F.col("_norm"))

    total = reduce(add, [weight(i, w) for i, w in enumerate(words)])
    return hits.withColumn("score", F.round(total, digits)).drop("_low", "_bag", "_stats", "_norm")


def ranked(docs: DataFrame, text: str, keyword: str, id_column: str, size: int = 10) -> DataFrame:
    """The `size` best rows by score, ties by id."""
    return scored(docs, text, keyword).orderBy(F.desc("score"), F.asc(id_column)).limit(size)


def max_score(docs: DataFrame, text: str, keyword: str) -> DataFrame:
    return scored(docs, text, keyword).agg(F.max("score").alias("max_score"))


def page_after(hits: DataFrame, id_column: str, size: int, score: float | None = None, last_id: object = None) -> DataFrame:
    """The `size` best scored rows after the one with `score` and `last_id`; the first page without them.

    A reader that turns pages passes on the last row it has seen, so page a thousand costs what the first one costs.
    """
    if score is not None:
        hits = hits.where((F.col("score") < score) | ((F.col("score") == score) & (F.col(id_column) > F.lit(last_id))))
    return hits.orderBy(F.desc("score"), F.asc(id_column)).limit(size)


def cursor(row: Row, id_column: str) -> str:
    """Where a page ended, as a token that the next page is asked for with."""
    return base64.urlsafe_b64encode(json.dumps([row["score"], row[id_column]]).encode()).decode()


def next_page(hits: DataFrame, id_column: str, size: int, token: str | None = None) -> DataFrame:
    """The page after the one that ended at `token`; the first page without it."""
    score, last_id = json.loads(base64.urlsafe_b64decode(token)) if token else (None, None)
    return page_after(hits, id_column, size, score, last_id)


def page(df: DataFrame, order: Sequence[str | Column], number: int, size: int) -> DataFrame:
    """Page `number` (from 1) of `size` rows in a total order, each with the `total` of all rows.

    `df` is evaluated twice, for its rows and their number; where it is costly, pass it stored (`session.kept`).
    """
    total = df.agg(F.count("*").alias("total"))
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    # A one-row DataFrame as a scalar subquery: evaluated once, no join.
    return rows.withColumn("total", total.scalar())
