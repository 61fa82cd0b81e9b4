"""Coupon-abuse alerts as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.operators.alerts import (
    KINDS, alert_events, alert_headers, members_of_slides, throttle, windows_of_slides,
)
from tillwatch.records import ALERT_INTERVAL, ALERT_PERIOD, ALERT_SLIDE, ALERT_USERS, ALERT_WINDOW
from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.streaming.run import start

MEMBERS_DDL = (
    "window_start TIMESTAMP, window_end TIMESTAMP, mid STRING, ts BIGINT, evid STRING, uid STRING, itemid STRING, n BIGINT"
)
MEMBER = ("mid", "ts", "evid", "uid", "itemid")
HEADERS_DDL = "doc_id STRING, mid STRING, n_users BIGINT, n_items BIGINT, n_events BIGINT, ts BIGINT"
EVENTS_DDL = "doc_id STRING, ts BIGINT, event_ts BIGINT, evid STRING, uid STRING, itemid STRING, n BIGINT"


def member_counts(events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE) -> DataFrame:
    """What happened in each window or slide of each device, one row per (time, kind, user, item).

    The key goes down to the item, so a busy device is spread over many tasks.
    """
    groups = events.groupBy(F.window("event_time", window, slide).alias("w"), *MEMBER)
    return groups.agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *MEMBER, "n"
    )


def window_member_counts(
    events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE, late: str = "10 seconds"
) -> DataFrame:
    """`member_counts` of a stream: the one stateful step of the live alerts, whose state goes when the watermark has
    passed the window."""
    return member_counts(events.withWatermark("event_time", late), window, slide)


def alert_tables(path: str) -> tuple[KeyedTable, KeyedTable]:
    """Alert headers by `device_minute`, a later window replacing an earlier one, and the events of every version."""
    return (
        KeyedTable(f"{path}/alerts", HEADERS_DDL, ["doc_id"], ["ts"]),
        KeyedTable(f"{path}/events", EVENTS_DDL, ["doc_id", "ts", "event_ts", "evid", "uid", "itemid"], []),
    )


class Slides:
    """What has been counted of slides that are over, in folders by span (a window's length of time) and batch.

    A slide is over once, so its rows come in one batch; a batch that runs again replaces its own folders.
    """

    def __init__(self, path: str, window_seconds: int):
        self.path, self.window_seconds = path, window_seconds
        self.ends = KeyedTable(f"{path}/ends", "what STRING, second BIGINT", ["what"], [])

    def add(self, rows: DataFrame, batch_id: int) -> None:
        span = F.floor(F.unix_seconds("window_start") / self.window_seconds)
        out = rows.withColumns({"span": span, "batch": F.lit(batch_id).cast("bigint")})
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("span", "batch").parquet(f"{self.path}/rows")

    def since(self, spark: SparkSession, second: int, batch_id: int) -> DataFrame:
        """The slides that start at `second` or later, of the batches up to `batch_id`; spans before it are not read."""
        rows = spark.read.schema(f"{MEMBERS_DDL}, span BIGINT, batch BIGINT").parquet(f"{self.path}/rows")
        wanted = (F.col("span") >= second // self.window_seconds) & (F.col("batch") <= batch_id)
        return rows.where(wanted & (F.unix_seconds("window_start") >= second)).drop("span", "batch")

    def last_end(self, spark: SparkSession, batch_id: int) -> int | None:
        """Up to when slides were over before the batch `batch_id`."""
        return self.ends.read(spark, before=batch_id).agg(F.max("second")).first()[0]

    def close(self, spark: SparkSession, second: int, batch_id: int, fold_every: int = 100) -> None:
        self.ends.upsert(spark.range(1).select(F.lit("over").alias("what"), F.lit(second).cast("bigint").alias("second")), batch_id)
        if (batch_id + 1) % fold_every == 0:
            self.ends.fold(spark, batch_id)


def _seconds(spark: SparkSession, interval: str) -> int:
    zero = "TIMESTAMP '1970-01-01 00:00:00 UTC'"
    return spark.range(1).select(F.expr(f"unix_seconds({zero} + INTERVAL {interval}) - unix_seconds({zero})")).first()[0]


def run_alerts(
    events: DataFrame, tables: tuple[KeyedTable, KeyedTable], checkpoint: str, window: str = ALERT_WINDOW,
    slide: str = ALERT_SLIDE, period: str = ALERT_PERIOD, late: str = "10 seconds", least: int = ALERT_USERS,
    kinds: tuple[str, str] = KINDS, interval: str | None = ALERT_INTERVAL,
) -> StreamingQuery:
    """Store an alert, its header and its events, once its window is over and a slide has closed since its start.

    State holds each event once, in its slide. Slides that are over are stored beside the alerts; a batch puts windows
    together that end in the slides it closes, from the slides of one window's length before them. An event that comes later
    than its slide allows counts in no window. Events carry their alert's time, so readers that join them to the headers
    see those of the version that stands.
    """
    headers, rows = tables
    spark = events.sparkSession
    window_seconds, slide_seconds = _seconds(spark, window), _seconds(spark, slide)
    slides = Slides(f"{headers.path}-slides", window_seconds)

    def save(batch: DataFrame, batch_id: int) -> None:
        session, over = batch.sparkSession, batch.persist()
        try:
            bounds = over.agg(F.min(F.unix_seconds("window_start")), F.max(F.unix_seconds("window_end"))).first()
            if bounds[0] is None:
                return
            last = slides.last_end(session, batch_id)
            done, end = bounds[0] if last is None else last, bounds[1]
            slides.add(over, batch_id)
            members = slides.since(session, min(done + slide_seconds - window_seconds, bounds[0]), batch_id)
            ends = F.unix_seconds("window_end")
            windows = windows_of_slides(members, window_seconds, slide_seconds, least, kinds).where((ends > done) & (ends <= end))
            found = members_of_slides(throttle(windows, period), members, slide_seconds).persist()
            rows.upsert(alert_events(found), batch_id, unique=True)
            headers.upsert(alert_headers(found, kinds), batch_id, unique=True)
            found.unpersist()
            slides.close(session, end, batch_id)
        finally:
            over.unpersist()

    return start(window_member_counts(events, slide, slide, late), save, checkpoint, interval=interval)


def member_table(path: str) -> KeyedTable:
    """Members counted per slide, added up over the batches that brought them."""
    return KeyedTable(path, MEMBERS_DDL, ["window_start", "window_end", *MEMBER], ["n"], keep="sum")


def run_member_replay(
    events: DataFrame, table: KeyedTable, checkpoint: str, slide: str = ALERT_SLIDE, late: str = "10 seconds"
) -> StreamingQuery:
    """Replay stored events to the end, with the members of slides that are still open then.

    Members are counted per slide, each event once; `operators.alerts.windows_of_slides` puts slides together to windows.
    A batch counts its own events and nothing waits in state: the table adds batches up. Events whose slide was over are
    left out, as a stream with a watermark does: by the newest time that came before the batch before, less `late`.
    """
    marks = KeyedTable(f"{table.path}-marks", "what STRING, newest BIGINT, passed BIGINT", ["what"], [])
    late_ms = events.sparkSession.range(1).select(
        F.expr(f"unix_millis(timestamp_millis(0) + INTERVAL {late})")).first()[0]

    def save(batch: DataFrame, batch_id: int, fold_every: int = 100) -> None:
        spark = batch.sparkSession
        before = marks.read(spark, before=batch_id).first()
        known, over = (before["newest"], before["passed"]) if before else (None, 0)
        members = member_counts(batch, slide, slide).where(F.col("window_end") > F.timestamp_millis(F.lit(over)))
        table.upsert(members, batch_id, unique=True)
        newest = F.greatest(F.unix_millis(F.max("event_time")), F.lit(known).cast("bigint"))
        passed = over if known is None else max(over, known - late_ms)
        marks.upsert(batch.agg(newest.alias("newest")).select(
            F.lit("events").alias("what"), "newest", F.lit(passed).cast("bigint").alias("passed")), batch_id, unique=True)
        if (batch_id + 1) % fold_every == 0:
            marks.fold(spark, batch_id)

    return start(events.select("event_time", *MEMBER), save, checkpoint, interval=None)
