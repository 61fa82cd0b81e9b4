"""Order amounts per day, hour and province."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.json import bad_lines, parse
from tillwatch.functions.shares import bucket
from tillwatch.functions.text import mask_prefix
from tillwatch.functions.times import readable, text_day, text_hour
from tillwatch.records import ORDER_RECORD
from tillwatch.sources.tables import on_day

# Characters kept and stars put in a phone number, by the order store and by the sale detail.
ORDER_MASK, SALE_MASK = (3, 8), (4, 7)
MONEY = "decimal(38,2)"


def read_orders(lines: DataFrame, mask: tuple[int, int] = ORDER_MASK, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order lines as rows with day and hour, phone masked; lines without a readable time or amount are `bad_orders`."""
    rows = parse(lines, ORDER_RECORD, keep=keep).where(readable(F.col("create_time")) & F.col("total_amount").try_cast(MONEY).isNotNull())
    return rows.withColumns({
        "create_date": text_day(F.col("create_time")),
        "create_hour": text_hour(F.col("create_time")),
        "consignee_tel": mask_prefix(F.col("consignee_tel"), *mask),
    })


def bad_orders(lines: DataFrame) -> DataFrame:
    """The lines that `read_orders` leaves out, whole."""
    return bad_lines(lines, ORDER_RECORD, good=lambda order: (
        readable(order["create_time"]) & order["total_amount"].try_cast("double").try_cast(MONEY).isNotNull()))


def amount(money: str | Column = "total_amount") -> Column:
    """An exact sum of money with two decimals: double addition would depend on the order rows arrive in.

    No amount is too large to sum; a total beyond 36 digits is null.
    """
    return F.try_sum(F.col(money).try_cast(MONEY) if isinstance(money, str) else money).cast("double")


def amount_total(orders: DataFrame, day: str | None = None) -> DataFrame:
    """Amount per day; of one day when it is given (one row, null if there are none)."""
    if day is not None:
        return on_day(orders, "create_date", day).agg(amount().alias("amount"))
    return orders.groupBy("create_date").agg(amount().alias("amount"))


def amount_hourly(orders: DataFrame, day: str | None = None) -> DataFrame:
    rows = orders if day is None else on_day(orders, "create_date", day)
    return rows.groupBy("create_date", "create_hour").agg(amount().alias("amount"))


def by_province(orders: DataFrame, province: str = "province_id") -> DataFrame:
    """Orders and amount per province, with the 100-wide bucket (0 to 500) a map colours them by."""
    groups = orders.groupBy(province).agg(F.count("*").alias("n_orders"), amount().alias("amount"))
    return _with_bucket(groups)


def by_user_province(orders: DataFrame, users: DataFrame, province: str) -> DataFrame:
    """The same where the province is the user's: `users` maps `id` to `province`.

    Orders are summed per user before they meet the users, so the join carries one row per user however many orders
    one of them holds. Orders whose user or province is unknown come under a null province.
    """
    money = F.col("total_amount").try_cast(MONEY)
    per_user = orders.groupBy("user_id").agg(F.count("*").alias("n"), F.try_sum(money).alias("money"))
    placed = per_user.join(users.select(F.col("id").alias("user_id"), province), "user_id", "left")
    return _with_bucket(placed.groupBy(province).agg(F.sum("n").alias("n_orders"), F.try_sum("money").cast("double").alias("amount")))


def _with_bucket(groups: DataFrame) -> DataFrame:
    return groups.withColumn("bucket", bucket(F.col("n_orders"), 100, 500))
