"""Rows of two streams that wait for each other in folders by micro-batch, joined as tables.

In a state store each row of a join of streams is looked up and written by itself, and every batch walks through all that
waits to find what is over. Here a batch is stored once and joined to the folders within its reach by an ordinary join, which
is adaptive like any other; folders that are out of reach are not opened again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructType

from tillwatch.sources.keyed_table import KeyedTable

#: Folder a row of a side came in.
LEFT_BATCH, RIGHT_BATCH = "_left_batch", "_right_batch"
_SIDE = "_side"
_MARKS_DDL = "what STRING, newest_left BIGINT, newest_right BIGINT, passed BIGINT, held ARRAY<STRUCT<batch: BIGINT, newest: BIGINT>>"
_NO_MARKS = {"newest_left": None, "newest_right": None, "passed": 0, "held": []}


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two streams as one, each row under its side."""
    return left.withColumn(_SIDE, F.lit(0)).unionByName(right.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True)


def left_of(batch: DataFrame) -> DataFrame:
    return batch.where(F.col(_SIDE) == 0)


class Met(NamedTuple):
    """The sides a batch is joined over, and the watermarks (milliseconds) before it and with it."""

    left: DataFrame
    right: DataFrame
    before: int
    now: int


class WaitingSides:
    """What came on both sides, as far as rows to come can reach it.

    `times` names the arrival column of either side, `late` is how far the watermark stays behind the lesser of the sides'
    newest arrivals. Rows behind the watermark are left out: with `settles`, the one that the batches before have set,
    else, as where streams are joined in state, the one that the batch before worked with. `settles` also keeps rows twice
    as long, so that a batch can tell which of those that are over found nothing.
    """

    def __init__(self, path: str, times: tuple[str, str], seconds: int, late: str, settles: bool = False):
        self.path, self.times, self.settles = path, times, settles
        self.reach, self.late = 1000 * seconds, late
        self.marks = KeyedTable(f"{path}/marks", _MARKS_DDL, ["what"], [])

    def take(self, batch: DataFrame, batch_id: int, left: Sequence[str], right: Sequence[str], fold_every: int = 100) -> Met:
        """Store the columns `left` and `right` of a batch of `both`, and give the sides with all that is in reach of it.

        A batch that runs again replaces its own folder and marks.
        """
        spark = batch.sparkSession
        before = self.marks.read(spark, before=batch_id).first() or _NO_MARKS
        late = spark.range(1).select(F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {self.late})")).first()[0]

        def watermark(newest: Sequence[int | None]) -> int:
            return max(0, before["passed"], min(0 if own is None else own - late for own in newest))

        known = [before["newest_left"], before["newest_right"]]
        passed = watermark(known)
        least = passed if self.settles else before["passed"]
        arrived = F.when(F.col(_SIDE) == 0, F.col(self.times[0])).otherwise(F.col(self.times[1]))
        rows = batch.where(arrived > F.timestamp_millis(F.lit(least))).select(*left, *right, _SIDE)
        rows.write.mode("overwrite").partitionBy(_SIDE).parquet(f"{self.path}/rows/batch={batch_id}")

        own = self._stored(rows, [batch_id]).agg(*[F.unix_millis(F.max(time)) for time in self.times]).first()
        newest = [max([at for at in pair if at is not None], default=None) for pair in zip(known, own)]
        first = least - self.reach * (2 if self.settles else 1)
        held = [(kept["batch"], kept["newest"]) for kept in before["held"] if kept["newest"] >= first]
        if any(at is not None for at in own):
            held.append((batch_id, max(at for at in own if at is not None)))
        self.marks.upsert(spark.createDataFrame([("sides", *newest, passed, held)], _MARKS_DDL), batch_id, unique=True)
        if (batch_id + 1) % fold_every == 0:
            self.marks.fold(spark, batch_id)

        near = self._stored(rows, sorted({batch_id, *(number for number, _ in held)}))
        since = F.timestamp_millis(F.lit(first))
        sides = [
            near.where((F.col(_SIDE) == side) & (F.col(time) >= since)).select(*columns, F.col("batch").alias(name))
            for side, time, columns, name in zip((0, 1), self.times, (left, right), (LEFT_BATCH, RIGHT_BATCH))
        ]
        return Met(*sides, passed, watermark(newest))

    def _stored(self, rows: DataFrame, batches: Sequence[int]) -> DataFrame:
        folder = f"{self.path}/rows"
        schema = StructType([*rows.schema]).add("batch", LongType())
        return rows.sparkSession.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/batch={own}" for own in batches])

    def is_new(self, batch_id: int) -> Column:
        """Of pairs: one of the two came with the batch."""
        return (F.col(LEFT_BATCH) == batch_id) | (F.col(RIGHT_BATCH) == batch_id)

    def is_over(self, met: Met) -> Column:
        """Of rows that found nothing: the batch's watermark has passed their reach, the one before had not."""
        at = F.coalesce(*self.times)
        last, now = (F.timestamp_millis(F.lit(mark - self.reach - 1)) for mark in (met.before, met.now))
        return (at > last) & (at <= now)
