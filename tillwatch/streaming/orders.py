"""Orders and users as streams: the newest row per id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillwatch.records import ORDER_RECORD, USER_RECORD
from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.streaming.run import start


def order_table(path: str, by_day: bool = True) -> KeyedTable:
    """Orders by id. An order's day of creation never changes, so the table can be cut by it."""
    schema = f"{ORDER_RECORD.ddl()}, arrived TIMESTAMP"
    return KeyedTable(path, schema, ["id"], ["arrived"], ["create_date"] if by_day else [])


def user_table(path: str, buckets: int = 0) -> KeyedTable:
    return KeyedTable(path, f"{USER_RECORD.ddl()}, arrived TIMESTAMP", ["id"], ["arrived"], buckets=buckets)


def run_upserts(
    rows: DataFrame, table: KeyedTable, checkpoint: str, fold_every: int | None = None, **how,
) -> StreamingQuery:
    """Keep `table` at the newest row per key. No state: the table resolves keys when it is read.

    Every `fold_every` batches they are folded, which bounds what each read costs.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id)
        if fold_every and (batch_id + 1) % fold_every == 0:
            table.fold(batch.sparkSession, batch_id)

    return start(rows, save, checkpoint, **how)
