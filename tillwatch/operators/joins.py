"""Order, detail and user joins.

No side is broadcast by hint: Spark compares its size with spark.sql.autoBroadcastJoinThreshold, at planning and again
at run time, and shuffles both sides beyond it. Inner, left and left-anti joins leave the hot side free to be split
by the adaptive skew join; a full outer join does not, so it is put together from those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.times import age_years


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """`left` full outer join `right`, where `right` may hold many rows per key.

    Every right row with its left row or none, plus the left rows that no right row names.
    """
    on = F.col(left_key) == F.col(right_key)
    named = right.select(F.col(right_key).alias("_named")).where(F.col("_named").isNotNull()).distinct()
    matched = right.join(left, on, "left")
    lone = left.join(named, F.col(left_key) == F.col("_named"), "left_anti")
    return matched.unionByName(lone, allowMissingColumns=True)


def within(left_time: str | Column, right_time: str | Column, seconds: int) -> Column:
    """True where two times lie at most `seconds` apart."""
    left = F.col(left_time) if isinstance(left_time, str) else left_time
    right = F.col(right_time) if isinstance(right_time, str) else right_time
    reach = F.expr(f"INTERVAL {int(seconds)} SECONDS")
    return right.between(left - reach, left + reach)


def interval_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str, seconds: int
) -> DataFrame:
    """Pairs with equal keys whose times lie at most `seconds` apart."""
    return left.join(right, (F.col(left_key) == F.col(right_key)) & within(left_time, right_time, seconds), "inner")


def with_users(sales: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Left lookup of the user of each sale; `users` holds one row per id.

    A sale without a user stays: gender and level null, age 0.
    """
    looked_up = users.select(
        F.col("id").alias("_id"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday"), as_of).alias("_age"),
        "user_level",
    )
    return (
        sales.join(looked_up, F.col("user_id") == F.col("_id"), "left")
        .withColumn("user_age", F.coalesce("_age", F.lit(0)))
        .drop("_id", "_age")
    )
