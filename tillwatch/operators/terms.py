"""Counts per value and their top k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def top_terms(df: DataFrame, column: str, k: int) -> DataFrame:
    """The `k` most frequent values of `column` with their counts; nulls are no value, ties go to the smaller one."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def terms_of(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The top terms of several columns of the same rows: column, value (as text) and its count."""
    found = [
        top_terms(df, column, k).select(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), "n")
        for column in columns
    ]
    return reduce(DataFrame.unionByName, found)
