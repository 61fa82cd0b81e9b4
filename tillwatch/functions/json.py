"""JSON in and out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.records import Record

_RAW = "_raw"


def _parsed(value: Column, record: Record) -> Column:
    return F.from_json(value, f"{record.wire_ddl()}, {_RAW} STRING", {"columnNameOfCorruptRecord": _RAW})


def parse(df: DataFrame, record: Record, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of `record`, one row per well-formed line; `keep` names columns to carry along."""
    # A generated row is a column of its own: the filter below reads it, where one on the expression would parse again.
    rows = df.select(*keep, F.explode(F.array(_parsed(F.col(value), record))).alias("_j")).where(
        F.col("_j").isNotNull() & F.col(f"_j.{_RAW}").isNull()
    )
    fields = [
        F.col(f"_j.{f}").try_cast(record.numbers[f]).alias(f) if f in record.numbers else F.col(f"_j.{f}")
        for f in record.wire
    ]
    return rows.select(*keep, *fields)


def bad_lines(df: DataFrame, record: Record, value: str = "value", good: Callable[[Column], Column] | None = None) -> DataFrame:
    """The lines `parse` leaves out, whole, for a side output; with `good`, also those whose fields it turns down.

    `good` gets the parsed record; null counts as false.
    """
    j = _parsed(F.col(value), record)
    bad = j.isNull() | j.getField(_RAW).isNotNull()
    if good is not None:
        bad = bad | ~F.coalesce(good(j), F.lit(False))
    return df.where(bad)


def stamp(value: Column, millis: Column) -> Column:
    """Put `ts` into a JSON object, over a `ts` the client may have sent; null where it is no object.

    The other values stay as they were sent: numbers unquoted, objects nested.
    """
    sent = F.from_json(value, "MAP<STRING, VARIANT>")
    rest = F.map_filter(sent, lambda key, _: key != "ts")
    return F.to_json(F.map_concat(rest, F.create_map(F.lit("ts"), millis.cast("bigint").cast("variant"))))


def row_json(*cols: str | Column) -> Column:
    """The named columns (all by default) as one JSON object."""
    return F.to_json(F.struct(*(cols or ("*",))))


def image_json(after: Column) -> Column:
    """A row image, an array of (name, value), as a flat JSON object of texts."""
    return F.to_json(F.map_from_entries(after), {"ignoreNullFields": "false"})
