"""Coupon-abuse alerts over stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwatch.operators.alerts import (
    KINDS, alert_events, alert_headers, alert_windows, as_documents, throttle, window_members, window_users,
)
from tillwatch.records import ALERT_PERIOD, ALERT_SLIDE, ALERT_USERS, ALERT_WINDOW


def alerts(
    events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE, period: str = ALERT_PERIOD,
    least: int = ALERT_USERS, kinds: tuple[str, str] = KINDS,
) -> DataFrame:
    """One alert per device and period: its last alerting window."""
    return throttle(alert_windows(window_users(events, window, slide, kinds), least), period)


def stored_alerts(
    events: DataFrame, window: str = ALERT_WINDOW, slide: str = ALERT_SLIDE, slide_seconds: int = 5,
    period: str = ALERT_PERIOD, least: int = ALERT_USERS, kinds: tuple[str, str] = KINDS,
) -> tuple[DataFrame, DataFrame]:
    """The alerts as they are stored: header rows, and the rows of the events behind them.

    Only windows that alert are joined back to the events; the wide event rows are never spread over the windows.
    """
    members = window_members(events, alerts(events, window, slide, period, least, kinds), slide_seconds)
    return alert_headers(members, kinds), alert_events(members)


def documents(events: DataFrame, *how, kinds: tuple[str, str] = KINDS, **settings) -> DataFrame:
    """The alerts with the users, items and events behind them as lists."""
    headers, rows = stored_alerts(events, *how, kinds=kinds, **settings)
    return as_documents(headers, rows, kinds)


def member_counts(
    events: DataFrame, found: DataFrame, slide_seconds: int, kinds: tuple[str, str] = KINDS
) -> DataFrame:
    """Per alert: distinct items that took coupons and number of events."""
    members = window_members(events, found, slide_seconds)
    coupon = F.col("evid") == kinds[0]
    return members.groupBy("window_start", "mid").agg(
        F.count_distinct(F.when(coupon, F.col("itemid"))).alias("n_items"), F.sum("n").alias("n_events")
    )
