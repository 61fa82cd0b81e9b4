"""Starting a stream, live or over what there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillwatch.records import BATCH_INTERVAL


_ADAPTIVE = "spark.sql.adaptive.enabled"


def _adaptive(each: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Turn adaptive execution on for what is done with a batch.

    Spark turns it off for a stream with state, whose partitions must stay as they are. The batch handed over is past
    that; lookups and writes made with it may have their hot keys split like any other job's.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(_ADAPTIVE)
        conf.set(_ADAPTIVE, "true")
        try:
            each(batch, batch_id)
        finally:
            conf.set(_ADAPTIVE, before)

    return run


def start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    interval: str | None = BATCH_INTERVAL, name: str | None = None,
) -> StreamingQuery:
    """Run `each` on every micro-batch; `interval=None` takes what is there now and ends.

    The checkpoint keeps offsets and state; `each` must write a batch id to the same place each time, so that a batch
    repeated after a failure leaves no second copy.
    """
    writer = stream.writeStream.foreachBatch(_adaptive(each)).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


#: Rows and seconds of each micro-batch of the stream that `finish` has seen last.
last_batches: list[tuple[int, float]] = []


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a stream that ends by itself; its failure is raised here."""
    query.awaitTermination()
    last_batches[:] = [(own.numInputRows, own.batchDuration / 1000) for own in query.recentProgress]
    return query


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a stream with an interval read all there is at its own pace, then stop it; its failure is raised here."""
    try:
        query.processAllAvailable()
        last_batches[:] = [(own.numInputRows, own.batchDuration / 1000) for own in query.recentProgress]
    finally:
        query.stop()
    return query
