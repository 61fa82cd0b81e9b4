"""One row per key.

Asked for place 1 only, Spark limits each group in every task before the shuffle and again after it, so a key that holds
a large part of all rows sends one row per task. (Streams have no such windows; they take min_by.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def apart(keys: Sequence[str]) -> Column:
    """A number that follows from the keys, to group by beside them.

    Groups stay the same, but their rows are hashed by one more column than a join on the keys asks for. So the join
    shuffles them anew, which is what lets the adaptive skew join split the hot keys of its other side.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 20)).alias("_apart")


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], joined: bool) -> DataFrame:
    group = [*keys, apart(keys)] if joined else keys
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def earliest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], joined: bool = False
) -> DataFrame:
    """The row with the smallest `order` of each key; `order` must not tie for the result to be fixed.

    `joined` says that the result is next joined on its keys, to rows that may be skewed.
    """
    return _first(df, keys, [F.asc_nulls_first(c) for c in order], joined)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], joined: bool = False
) -> DataFrame:
    """The row with the greatest `order` of each key."""
    return _first(df, keys, [F.desc_nulls_last(c) for c in order], joined)


def unseen(rows: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in `seen`.

    `seen` is cut to one row per key, so a hot key only weighs on the `rows` side, which a left-anti join lets Spark
    split over several tasks.
    """
    known = seen.groupBy(*keys, apart(keys)).agg(F.lit(1)).select(*keys)
    return rows.join(known, list(keys), "left_anti")
