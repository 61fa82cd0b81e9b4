"""Coupon abuse on one device: in a sliding window, coupons by several users and no browsing.

Nothing gathers the events of a device. Users are counted in two steps, distinct (window, device, user) first, so a
device with a large part of all events is spread over its users. An alert is stored as one header row and its events as
rows of their own, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwatch.functions.times import epoch_minute
from tillwatch.records import ALERT_PERIOD, ALERT_SLIDE, ALERT_USERS, ALERT_WINDOW, BROWSE, COUPON

KINDS = (COUPON, BROWSE)
_ALERT = ("doc_id", "window_start", "window_end", "mid")


def window_users(
    events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE, kinds: tuple[str, str] = KINDS
) -> DataFrame:
    """(window, device, user) with two flags, from the two event kinds that decide an alert."""
    coupon, browse = kinds
    kind = F.col("evid")
    return (
        events.where(kind.isin(coupon, browse))
        .groupBy(F.window("event_time", window, slide).alias("w"), "mid", "uid")
        .agg(F.max(kind == coupon).alias("took"), F.max(kind == browse).alias("browsed"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "mid", "uid", "took", "browsed")
    )


def alert_windows(users: DataFrame, least: int = ALERT_USERS) -> DataFrame:
    """Windows of a device with coupons by at least `least` users and no browsing. A null user is no user."""
    took = F.col("took") & F.col("uid").isNotNull()
    return (
        users.groupBy("window_start", "window_end", "mid")
        .agg(F.count_if(took).alias("n_users"), F.max("browsed").alias("browsed"))
        .where((F.col("n_users") >= least) & ~F.col("browsed"))
        .drop("browsed")
    )


def period_of(window_end: Column, period: str = ALERT_PERIOD) -> Column:
    """Start of the period an alert falls in: that of the last instant of its window."""
    return F.window(_last_instant(window_end), period).getField("start")


def _last_instant(window_end: Column) -> Column:
    return window_end - F.expr("INTERVAL 1 MICROSECOND")


def throttle(windows: DataFrame, period: str = ALERT_PERIOD) -> DataFrame:
    """One alert per device and period, the last window's."""
    return (
        windows.withColumn("_end", F.col("window_end"))
        .groupBy(period_of(F.col("window_end"), period).alias("period"), "mid")
        .agg(
            F.max("window_start").alias("window_start"),
            F.max("_end").alias("window_end"),
            F.max_by("n_users", "_end").alias("n_users"),
        )
        .withColumn("doc_id", alert_id(F.col("mid"), F.col("period")))
    )


def alert_id(mid: Column, period: Column) -> Column:
    """`device_minute`, the key alerts are stored under."""
    return F.concat_ws("_", mid, epoch_minute(F.unix_millis(period)).cast("string"))


def window_members(events: DataFrame, alerts: DataFrame, slide_seconds: int) -> DataFrame:
    """The events behind the given alerts, one row per distinct (alert, time, kind, user, item) with its count.

    Windows start and end on slides, so events meet windows by equality on (device, slide) instead of by range, and a
    hot device is split over its slides.
    """
    first, last = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    slides = F.sequence(first, last - slide_seconds, F.lit(slide_seconds).cast("bigint"))
    spans = alerts.select(*_ALERT, F.explode(slides).alias("_slide"))
    second = F.unix_seconds("event_time")
    at = events.select(
        F.col("mid").alias("_mid"), "evid", "uid", "itemid", "ts",
        (second - F.pmod(second, F.lit(slide_seconds))).alias("_at"),
    )
    found = at.join(spans, (F.col("mid") == F.col("_mid")) & (F.col("_at") == F.col("_slide")), "inner")
    return found.groupBy(*_ALERT, "ts", "evid", "uid", "itemid").agg(F.count("*").alias("n"))


def members_of(alerts: DataFrame, members: DataFrame) -> DataFrame:
    """The same from members counted for all windows."""
    return members.drop("window_end").join(alerts.select(*_ALERT), ["window_start", "mid"], "inner")


def users_of_members(members: DataFrame, kinds: tuple[str, str] = KINDS) -> DataFrame:
    """`window_users` from counted members."""
    coupon, browse = kinds
    kind = F.col("evid")
    return (
        members.where(kind.isin(coupon, browse))
        .groupBy("window_start", "window_end", "mid", "uid")
        .agg(F.max(kind == coupon).alias("took"), F.max(kind == browse).alias("browsed"))
    )


def over_windows(members: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Members counted per slide as rows of every window that covers their slide."""
    back = F.sequence(F.lit(0), F.lit(window_seconds - slide_seconds), F.lit(slide_seconds))
    start = F.unix_seconds("window_start") - F.col("_back")
    spread = members.withColumn("_back", F.explode(back))
    return spread.withColumns({
        "window_start": F.timestamp_seconds(start), "window_end": F.timestamp_seconds(start + window_seconds)
    }).drop("_back")


def windows_of_slides(
    members: DataFrame, window_seconds: int, slide_seconds: int, least: int = ALERT_USERS, kinds: tuple[str, str] = KINDS
) -> DataFrame:
    """`alert_windows` of all windows from members counted per slide; `least` is 1 or more.

    No row is made for each window that a slide is in: a user counts from the first window that covers their slide to the
    last one that their next slide is not in, so it takes the two window starts where the number of users changes.
    Running sums over these give the windows that alert. A device has a row per slide of time in them, however many events.
    """
    back = (window_seconds - slide_seconds) // slide_seconds * slide_seconds
    at, user = F.col("_at"), (F.col("took") & F.col("uid").isNotNull()).cast("int")
    browsed, none = F.col("browsed").cast("int"), F.lit(0)
    following = F.lead("_at").over(Window.partitionBy("mid", "uid", "took").orderBy("_at"))
    users = users_of_members(members, kinds).withColumn("_at", F.unix_seconds("window_start")).withColumn("_next", following)

    def change(second: Column, users: Column, browsers: Column) -> Column:
        return F.struct(second.alias("_at"), users.alias("_users"), browsers.alias("_browsers"))

    changes = users.select("mid", F.inline(F.array(
        change(at - back, user, browsed),
        change(F.least(at + slide_seconds, F.col("_next") - back), -user, none),
        change(at + slide_seconds, none, -browsed),
    ))).where((F.col("_users") != 0) | (F.col("_browsers") != 0))
    sums = changes.groupBy("mid", "_at").agg(F.sum("_users").alias("_users"), F.sum("_browsers").alias("_browsers"))
    order = Window.partitionBy("mid").orderBy("_at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = sums.select(
        "mid", "_at", F.lead("_at").over(order).alias("_until"), F.sum("_users").over(so_far).alias("n_users"),
        F.sum("_browsers").over(so_far).alias("_browsers"),
    ).where((F.col("n_users") >= least) & (F.col("_browsers") == 0))
    step = F.lit(slide_seconds).cast("bigint")
    starts = spans.select("mid", "n_users", F.explode(F.sequence("_at", F.col("_until") - step, step)).alias("_start"))
    return starts.select(
        F.timestamp_seconds("_start").alias("window_start"),
        F.timestamp_seconds(F.col("_start") + window_seconds).alias("window_end"), "mid", "n_users",
    )


def members_of_slides(alerts: DataFrame, members: DataFrame, slide_seconds: int) -> DataFrame:
    """The members of each alert from those counted per slide, which meet by equality on (device, slide)."""
    first, last = F.unix_seconds("window_start"), F.unix_seconds("window_end")
    slides = F.sequence(first, last - slide_seconds, F.lit(slide_seconds).cast("bigint"))
    spans = alerts.select(*_ALERT, F.explode(slides).alias("_slide"))
    at = members.select(F.col("mid").alias("_mid"), "ts", "evid", "uid", "itemid", "n", F.unix_seconds("window_start").alias("_at"))
    return at.join(spans, (F.col("mid") == F.col("_mid")) & (F.col("_at") == F.col("_slide")), "inner").drop("_mid", "_at", "_slide")


def alert_headers(members: DataFrame, kinds: tuple[str, str] = KINDS) -> DataFrame:
    """One row per alert, from its members: how many users and items took coupons, how many events, and its time."""
    coupon = F.col("evid") == kinds[0]
    return members.groupBy("doc_id", "mid", "window_end").agg(
        F.count_distinct(F.when(coupon, F.col("uid"))).alias("n_users"),
        F.count_distinct(F.when(coupon, F.col("itemid"))).alias("n_items"),
        F.sum("n").alias("n_events"),
    ).withColumn("ts", F.unix_millis(_last_instant(F.col("window_end")))).drop("window_end")


def alert_events(members: DataFrame) -> DataFrame:
    """The events of each alert, one row per time, kind, user and item with its count, under the alert's id and time."""
    return members.select(
        "doc_id", F.unix_millis(_last_instant(F.col("window_end"))).alias("ts"), F.col("ts").alias("event_ts"),
        "evid", "uid", "itemid", "n",
    )


def as_documents(headers: DataFrame, events: DataFrame, kinds: tuple[str, str] = KINDS) -> DataFrame:
    """Alerts with their users, items and events as lists: a view for the alerts a reader asks for.

    Headers and event rows are what is stored, whatever an alert's size. Filter the headers by id before the lists are
    made: an alert's lists stand in one row. Events come in time order, those of one instant by kind.
    """
    coupon = F.col("evid") == kinds[0]
    timed = F.sort_array(F.collect_list(F.struct("event_ts", "evid", F.col("n").cast("int").alias("n"))))
    lists = headers.select("doc_id", "mid", "ts").join(events, ["doc_id", "ts"], "inner").groupBy("doc_id", "mid", "ts").agg(
        F.sort_array(F.collect_set(F.when(coupon, F.col("uid")))).alias("uids"),
        F.sort_array(F.collect_set(F.when(coupon, F.col("itemid")))).alias("itemIds"),
        F.flatten(F.transform(timed, lambda e: F.array_repeat(e["evid"], e["n"]))).alias("events"),
    )
    return lists.select("doc_id", "mid", "uids", "itemIds", "events", "ts")
