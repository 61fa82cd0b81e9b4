"""Posted log lines -> stamped, by topic, and by day for the raw log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.functions.json import stamp
from tillwatch.functions.times import epoch_day
from tillwatch.sources.topics import log_topic


def stamped(lines: DataFrame, arrived_ms: Column) -> DataFrame:
    """`value` with its arrival time put in, the day of arrival in `dt`, and its `topic`; a line that is no JSON object
    keeps its text and gets no topic."""
    value = stamp(F.col("value"), arrived_ms)
    return lines.withColumn("dt", epoch_day(arrived_ms)).withColumn("_v", value).select(
        *[c for c in lines.columns if c != "value"],
        "dt",
        F.coalesce("_v", "value").alias("value"),
        F.when(F.col("_v").isNotNull(), log_topic(F.col("_v"))).alias("topic"),
    )
