"""Sale detail: each order line with its order and its user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.operators.joins import full_outer, with_users
from tillwatch.operators.keyed import latest_per_key

COLUMNS = (
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
)


def order_side(orders: DataFrame, *extra: str) -> DataFrame:
    return orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id", F.col("create_date").alias("dt"), *extra
    )


def detail_side(details: DataFrame, *extra: str) -> DataFrame:
    return details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("_order"), "sku_id",
        F.col("order_price").try_cast("double").alias("sku_price"), "sku_name", *extra,
    )


def wide(pairs: DataFrame, users: DataFrame, as_of: Column | None = None, *extra: str) -> DataFrame:
    """Matched pairs with their user, in the wide layout, under `order-detail` ids."""
    return _laid_out(with_users(pairs, users, as_of), *extra)


def _laid_out(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(F.concat_ws("-", "order_id", "order_detail_id").alias("doc_id"), *COLUMNS, *extra)


def sale_detail(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Details that come twice count once; orders hold one row per id, users one per id.

    Users are looked up for orders, before the lines multiply them, so lines are shuffled for their order only. Copies
    go after the join: by then rows of an order are together and a filter on orders has cut the lines. Where one order
    is hot, Spark splits its join and shuffles the copies by line, after a first cut in each task.
    """
    known = with_users(order_side(orders), users, as_of)
    pairs = known.join(detail_side(details), F.col("order_id") == F.col("_order"), "inner").drop("_order")
    lines = latest_per_key(pairs, ["order_id", "order_detail_id"], ["sku_price", "sku_id", "sku_name"])
    return _laid_out(lines)


def sale_users(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The rows of `sale_detail` with their user and day only, for counts that ask for nothing of the line.

    Copies of a detail differ in line columns alone, so they fall together by plain hashing, with no sort by price.
    """
    known = with_users(order_side(orders), users, as_of)
    lines = details.select(F.col("id").alias("order_detail_id"), F.col("order_id").alias("_order")).distinct()
    pairs = known.join(lines, F.col("order_id") == F.col("_order"), "inner")
    return pairs.select("order_id", "order_detail_id", "dt", "user_gender", "user_age", "user_level")


def order_coverage(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Which orders and details found each other: every pair, every order and every detail left alone."""
    left = orders.select(F.col("id").alias("order_id"))
    right = details.select(F.col("id").alias("detail_id"), F.col("order_id").alias("_order"))
    both = full_outer(left, right, "order_id", "_order")
    side = (
        F.when(F.col("order_id").isNull(), "detail only").when(F.col("detail_id").isNull(), "order only").otherwise("both")
    )
    return both.select(F.coalesce("order_id", "_order").alias("order_id"), "detail_id", side.alias("side"))
