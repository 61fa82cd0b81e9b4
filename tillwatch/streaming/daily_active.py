"""Daily active devices as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.records import STARTUP_LOG
from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.streaming.run import start


def earliest_so_far(
    logs: DataFrame, columns: tuple[str, ...], order: tuple[str, ...] = ("ts",), late: str = "10 minutes"
) -> DataFrame:
    """The earliest log of each day and device, in update mode: a row for each device a batch touched.

    The day's window is part of the key, so state is dropped once the watermark has passed the day. Windows are UTC
    days; in other zones a day may reach over two of them, and the keyed table keeps the earlier row.
    """
    watched = logs.withWatermark("event_time", late)
    row = F.min_by(F.struct(*columns), F.struct(*order))
    groups = watched.groupBy(F.window("event_time", "1 day").alias("_w"), "logDate", "mid")
    return groups.agg(row.alias("_row")).select("logDate", "mid", "_row.*")


def first_arrivals(logs: DataFrame, late: str = "10 minutes", salts: int = 4) -> DataFrame:
    """Day and device when first seen, appended at once; which log was earliest is not kept.

    Duplicates are dropped under a salt first: dropping them sends every row to its key's task, and a busy device would
    send all of its rows to one.
    """
    watched = logs.withWatermark("event_time", late)
    salt = F.pmod(F.xxhash64("ts"), F.lit(salts)).alias("_salt")
    days = watched.select(F.window("event_time", "1 day").alias("_w"), "logDate", "mid", salt)
    keys = ["_w", "logDate", "mid"]
    return days.dropDuplicates([*keys, "_salt"]).dropDuplicates(keys).select("logDate", "mid")


def first_seen_table(path: str, buckets: int = 0) -> KeyedTable:
    """The first day of each device, in folders by day and, so that devices are found in any of them, by `buckets` of devices.

    `n` is 0 where an earlier day has come in later.
    """
    return KeyedTable(path, "logDate STRING, mid STRING, n INT", ["mid"], [], ["logDate"], buckets=buckets, bucket_by=["mid"])


def first_seen_changes(batch: DataFrame, known: DataFrame) -> DataFrame:
    """What the (day, device) rows of a batch change in the first days known: new ones, and those they take back."""
    first = batch.groupBy("mid").agg(F.min("logDate").alias("_day"))
    before = known.where("n = 1").select(F.col("mid").alias("_mid"), F.col("logDate").alias("_known"))
    found = first.join(before, F.col("mid") == F.col("_mid"), "left").where(F.col("_known").isNull() | (F.col("_day") < F.col("_known")))
    days = F.array(
        F.struct(F.col("_day").alias("logDate"), F.lit(1).alias("n")), F.struct(F.col("_known").alias("logDate"), F.lit(0).alias("n")))
    return found.select("mid", F.inline(days)).where(F.col("logDate").isNotNull())


def run_first_seen(
    logs: DataFrame, table: KeyedTable, checkpoint: str, late: str = "10 minutes", salts: int = 4, fold_every: int | None = None, **how,
) -> StreamingQuery:
    """Keep the first day of each device, so that a day's new devices are counted in that day's folder alone.

    A batch is held against the table as it stood before it, in the buckets of its devices, so one that runs again writes
    the same rows again. Every `fold_every` batches the table is folded.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("logDate", "mid").persist()
        try:
            table.upsert(first_seen_changes(rows, table.lookup(rows, ["mid"], before=batch_id)), batch_id, unique=True)
        finally:
            rows.unpersist()
        if fold_every and (batch_id + 1) % fold_every == 0:
            table.fold(batch.sparkSession, batch_id)

    return start(first_arrivals(logs, late, salts), save, checkpoint, **how)


def active_table(path: str, schema: str = STARTUP_LOG.ddl(), order: tuple[str, ...] = ("ts",), by_day: bool = True) -> KeyedTable:
    """`mid`, `logDate` and the log's columns, the earliest log winning whichever batch brings it."""
    return KeyedTable(path, schema, ["logDate", "mid"], list(order), ["logDate"] if by_day else [], keep="first")


def run_daily_active(
    logs: DataFrame, columns: tuple[str, ...], table: KeyedTable, checkpoint: str, late: str = "10 minutes", **how
) -> StreamingQuery:
    def save(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, unique=True)

    updates = earliest_so_far(logs, columns, tuple(table.order), late)
    return start(updates, save, checkpoint, mode="update", **how)
