"""Hour-by-hour curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.times import next_day, previous_day


def hour_map(hourly: DataFrame, day: str, hour: str, value: str) -> DataFrame:
    """One row per day with a map hour -> value; an entry per hour, so at most 24 of them."""
    entries = F.sort_array(F.collect_list(F.struct(hour, value)))
    return hourly.groupBy(day).agg(F.map_from_entries(entries).alias("hours"))


def _hours() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.lpad(h.cast("string"), 2, "0"))


def hour_spine(days: DataFrame, day: str) -> DataFrame:
    """Hours 00 to 23 of each day."""
    return days.select(day, F.explode(_hours()).alias("hour"))


def day_against_previous(
    hourly: DataFrame, day: str, hour: str, value: str, only: str | None = None
) -> DataFrame:
    """`day`, `hour`, `today`, `yesterday` for the 24 hours of each day, or of the day `only`; gaps are 0.

    Each hourly value counts for its own day and for the next one, and asks for the zeros of its day, so both curves
    and the gaps come from one aggregate over one pass instead of a self-join and a join with the hours.
    """
    kind = hourly.schema[value].dataType
    zero, none = F.lit(0).cast(kind), F.lit(None).cast(kind)

    def cell(of: Column, at: Column, today: Column, yesterday: Column, asked: bool) -> Column:
        return F.struct(
            of.alias("day"), at.alias("hour"), today.alias("today"), yesterday.alias("yesterday"), F.lit(asked).alias("asked")
        )

    d, h, v = F.col(day), F.col(hour), F.col(value)
    if only is not None:
        hourly = hourly.where(d.isin(F.lit(only), previous_day(F.lit(only))))
    gaps = F.transform(_hours(), lambda x: cell(d, x, none, none, True))
    cells = F.concat(F.array(cell(d, h, v, none, True), cell(next_day(d), h, none, v, False)), gaps)
    rows = hourly.select(F.inline(cells))
    if only is not None:
        asked = hour_spine(hourly.sparkSession.range(1).select(F.lit(only).alias("day")), "day")
        rows = rows.where(F.col("day") == only).unionByName(
            asked.select("day", "hour", none.alias("today"), none.alias("yesterday"), F.lit(True).alias("asked"))
        )
    both = rows.groupBy("day", "hour").agg(
        F.coalesce(F.sum("today"), zero).alias("today"),
        F.coalesce(F.sum("yesterday"), zero).alias("yesterday"),
        F.max("asked").alias("asked"),
    )
    return both.where("asked").drop("asked")
