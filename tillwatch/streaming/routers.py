"""Log lines and change entries to their topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.plans.change_feed import routed
from tillwatch.plans.log_feed import stamped
from tillwatch.sources.topics import write_daily_log, write_topics
from tillwatch.streaming.run import start


def run_log_router(
    lines: DataFrame, arrived_ms: Column, topics: str, raw_log: str, checkpoint: str, kind: str = "text", **how
) -> StreamingQuery:
    """Stamp each line, append it to the day's raw log and send it to its topic.

    The batch is kept for its two writers, so that both see the same arrival times.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            write_daily_log(rows, raw_log, batch_id)
            write_topics(rows.where(F.col("topic").isNotNull()), kind, topics, batch_id)
        finally:
            rows.unpersist()

    return start(stamped(lines, arrived_ms), save, checkpoint, **how)


def run_change_router(
    changes: DataFrame, topics: str, checkpoint: str, kind: str = "text", include_updates: bool = False, **how
) -> StreamingQuery:
    """Send the rows of a change feed to the topic of their table."""
    def save(batch: DataFrame, batch_id: int) -> None:
        write_topics(batch, kind, topics, batch_id)

    return start(routed(changes, include_updates), save, checkpoint, **how)


def run_bad_lines(bad: DataFrame, path: str, checkpoint: str, **how) -> StreamingQuery:
    """Set aside the lines that a reader leaves out, whole: those of `bad_logs`, `bad_orders` or `bad_lines`."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.select("value").write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return start(bad.where(F.col("value").isNotNull()), save, checkpoint, **how)


def counted(rows: DataFrame, name: str = "rows") -> DataFrame:
    """The rows, counted on their way to whatever the stream does with them: no job of its own counts a batch."""
    return rows.observe(name, F.count(F.lit(1)).alias("n"))


def batch_counts(query: StreamingQuery, spark: SparkSession, name: str = "rows") -> DataFrame:
    """batch_id and n, the rows of each micro-batch of a `counted` stream, as far back as the session keeps its progress
    (spark.sql.streaming.numRecentProgressUpdates)."""
    found = {own.batchId: own.observedMetrics[name]["n"] for own in query.recentProgress if name in own.observedMetrics}
    return spark.createDataFrame(list(found.items()), "batch_id BIGINT, n BIGINT")


def run_batch_counts(rows: DataFrame, path: str, checkpoint: str, **how) -> StreamingQuery:
    """Append the lines of each micro-batch to a folder, and count them on the way (`batch_counts`)."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return start(counted(rows), save, checkpoint, **how)
