"""Rows that come later than a stream's watermark allows: set aside instead of dropped unseen.

Spark counts the rows that a watermark drops but keeps none, and which ones they are depends on how batches fell. So lateness
is decided before the streams with state, once for all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.streaming.run import start


def run_split_late(
    rows: DataFrame, path: str, checkpoint: str, window: str, late: str, time: str = "event_time", fold_every: int = 100, **how,
) -> StreamingQuery:
    """Store the rows of each micro-batch under `kept`, those whose `window` was over before the batch came under `late`.

    A window is over once the newest time of the batches before is `late` past its end. Streams of such windows that read
    `kept` with a watermark of at least `late`, no part of a batch before another, drop nothing. Times are compared to the
    millisecond, as watermarks are; a row without a time belongs to no window and is kept. Batches are kept apart, so one
    that runs again replaces its own.
    """
    seen = KeyedTable(f"{path}/seen", "what STRING, milli BIGINT", ["what"], [])
    milli = F.unix_millis(time)

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, batch.persist()
        try:
            newest = seen.read(spark, before=batch_id).agg(F.max("milli")).first()[0]
            over = F.window(time, window).getField("end") + F.expr(f"INTERVAL {late}")
            behind = F.lit(False) if newest is None else F.unix_millis(over) <= newest
            behind = F.coalesce(behind, F.lit(False))
            for part, wanted in (("kept", ~behind), ("late", behind)):
                own.where(wanted).write.mode("overwrite").parquet(f"{path}/{part}/batch={batch_id}")
            latest = own.agg(F.max(milli).alias("milli")).select(
                F.lit("newest").alias("what"), F.greatest("milli", F.lit(newest).cast("bigint")).alias("milli"))
            seen.upsert(latest, batch_id, unique=True)
        finally:
            own.unpersist()
        if (batch_id + 1) % fold_every == 0:
            seen.fold(batch.sparkSession, batch_id)

    return start(rows, save, checkpoint, **how)
