"""Daily active devices: one row per day and device, its earliest log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwatch.functions.json import bad_lines, parse
from tillwatch.functions.times import epoch_day, epoch_hour
from tillwatch.operators.keyed import earliest_per_key
from tillwatch.records import Record
from tillwatch.sources.tables import on_day


def read_logs(lines: DataFrame, record: Record, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log lines as rows with day and hour; lines without a readable time are `bad_logs`."""
    rows = parse(lines, record, keep=keep).where(F.col("ts").isNotNull())
    return rows.withColumns({"logDate": epoch_day(F.col("ts")), "logHour": epoch_hour(F.col("ts"))})


def bad_logs(lines: DataFrame, record: Record) -> DataFrame:
    """The lines that `read_logs` leaves out, whole."""
    return bad_lines(lines, record, good=lambda log: log["ts"].try_cast("bigint").isNotNull())


def daily_active(logs: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    return earliest_per_key(logs, ["logDate", "mid"], list(order))


def active_hours(logs: DataFrame) -> DataFrame:
    """`daily_active` for reports that ask for no more than the hour: it follows from the earliest time, a number, so
    rows are hashed and not sorted."""
    first = logs.groupBy("logDate", "mid").agg(F.min("ts").alias("ts"))
    return first.withColumn("logHour", epoch_hour(F.col("ts")))


def active_total(active: DataFrame, day: str | None = None) -> DataFrame:
    """Devices per day; of one day when it is given (one row, 0 if there are none)."""
    if day is not None:
        return on_day(active, "logDate", day).agg(F.count("*").alias("total"))
    return active.groupBy("logDate").agg(F.count("*").alias("total"))


def active_hourly(active: DataFrame, day: str | None = None) -> DataFrame:
    rows = active if day is None else on_day(active, "logDate", day)
    return rows.groupBy("logDate", "logHour").agg(F.count("*").alias("n"))


def new_devices(active: DataFrame, day: str | None = None) -> DataFrame:
    """Devices by the first day they were ever active."""
    first = active.groupBy("mid").agg(F.min("logDate").alias("logDate"))
    return active_total(first, day)
