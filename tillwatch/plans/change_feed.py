"""Database change entries -> one JSON line per inserted row, by topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwatch.functions.json import image_json
from tillwatch.records import CHANGE_TABLES


def routed(changes: DataFrame, include_updates: bool = False) -> DataFrame:
    """(topic, value): after-images of the rows inserted into the three watched tables; the topic is the table.

    Updates are left out unless asked for, deletes and entries without row data always.
    """
    kinds = ["INSERT", "UPDATE"] if include_updates else ["INSERT"]
    kept = changes.where(
        (F.col("entry_type") == "ROWDATA") & F.col("event_type").isin(kinds) & F.col("table").isin(*CHANGE_TABLES)
    )
    rows = kept.select(F.col("table").alias("topic"), F.explode("row_datas").alias("row"))
    return rows.select("topic", image_json(F.col("row.after")).alias("value"))
