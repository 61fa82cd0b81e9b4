"""Stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# Fixed value: the type that stored documents carry.
DOC_TYPE = "_doc"


def read_table(spark: SparkSession, path: str, form: str = "parquet", **options: str) -> DataFrame:
    """A table of files, or a database table with form='jdbc' and its options (url, dbtable, partitionColumn, ...)."""
    reader = spark.read.format(form).options(**options)
    return reader.load() if form == "jdbc" else reader.load(path)


def on_day(df: DataFrame, column: str, day: str | Column) -> DataFrame:
    """Rows of one day; an equality on the stored column, so it prunes folders and row groups."""
    return df.where(F.col(column) == (F.lit(day) if isinstance(day, str) else day))


def scan_all(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """All tables as one: each row with its table name, type, id, score and its fields as a JSON document.

    `tables` maps a name to (rows, id column). A scan matches every row alike, so all score 1.
    """
    def tagged(name: str, rows: DataFrame, key: Column) -> DataFrame:
        return rows.select(
            F.lit(name).alias("index"), F.lit(DOC_TYPE).alias("type"), key.cast("string").alias("id"),
            F.lit(1.0).alias("score"), F.to_json(F.struct("*")).alias("source"),
        )

    return reduce(DataFrame.unionByName, [tagged(n, rows, key) for n, (rows, key) in tables.items()])


def union_all(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables with their own columns side by side, missing ones null, and the table name in `index`."""
    tagged = [rows.withColumn("index", F.lit(name)) for name, rows in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def hit_json(rows: DataFrame, index: str, key: Column) -> DataFrame:
    """Each scored row as one JSON object, with its `index`, `type`, `id` and `score` among its fields."""
    named = rows.select(
        *[name for name in rows.columns if name != "score"], F.lit(index).alias("index"), F.lit(DOC_TYPE).alias("type"),
        key.cast("string").alias("id"), "score",
    )
    return named.select(F.to_json(F.struct("*")).alias("hit"))
