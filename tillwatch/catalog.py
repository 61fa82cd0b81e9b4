"""Every operator and pipeline as a query over the test tables. Each reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.functions.json import parse, row_json
from tillwatch.functions.text import mask_prefix, match_all, match_any
from tillwatch.functions.times import age_years
from tillwatch.operators.alerts import alert_windows, as_documents, throttle, window_users, windows_of_slides
from tillwatch.operators.hours import day_against_previous, hour_map
from tillwatch.operators.joins import interval_join
from tillwatch.operators.keyed import latest_per_key, unseen
from tillwatch.operators.search import cursor, max_score, next_page, page, ranked, scored
from tillwatch.operators.terms import terms_of, top_terms
from tillwatch.plans import change_feed, coupon_alert, daily_active, log_feed, order_amount, reports, sale_detail
from tillwatch.records import (
    BATCH_INTERVAL, DETAIL_RECORD, EVENT_LOG, ORDER_DETAIL, ORDER_INFO, STARTUP_LOG, USER_INFO, USER_RECORD,
)
from tillwatch.session import kept, prepare, shared_dir, stream_session
from tillwatch.sources import shop_tables as shop
from tillwatch.sources.keyed_table import KeyedTable, one_document
from tillwatch.sources.tables import hit_json, scan_all, union_all
from tillwatch.sources.topics import of_topic, read_files, read_topics
from tillwatch.streaming import coupon_alert as alert_stream_, daily_active as active_stream, orders as order_stream
from tillwatch.streaming import routers, sale_detail as sale_stream_
from tillwatch.streaming.late import run_split_late
from tillwatch.streaming.run import drain, finish

# Parameters of the registered queries; the SQL they are checked with uses the same ones.
AS_OF = "2001-08-01"
CURVE_DAY = "2024-01-10"
KEPT_DAY = "1997-05-20"
REPORT_DAY, REPORT_WORD, REPORT_WORDS = "1998-10-03", "red", "red ring"
SEARCH = "elle und the"
PAGED, PAGE_SIZE = "red plate", 40
JOIN_SECONDS = 300 * 86400
# Devices of the test data log about twice a day, so windows are days and hours, not seconds.
WINDOW, SLIDE, PERIOD = "3 days", "6 hours", "1 day"
ALERT_LATE = "1 hour"
DELIVERED = "2024-01-30 23:00:00"
WINDOW_SECONDS, SLIDE_SECONDS = 3 * 86400, 6 * 3600
_SECOND = "yyyy-MM-dd HH:mm:ss"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return shop.logs(shop.table(spark, sf, "events"))


def _active(spark: SparkSession, sf: str) -> DataFrame:
    logs = _logs(spark, sf).select("logDate", "mid", "uid", "logHour", "ts", "event_id")
    return daily_active.daily_active(logs, ("ts", "event_id"))


def _hours(spark: SparkSession, sf: str) -> DataFrame:
    return daily_active.active_hours(_logs(spark, sf))


def _purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases as orders: the order table only knows midnights, hours come from here."""
    return _logs(spark, sf).where(F.col("evid") == shop.KINDS[0]).select(
        F.col("logDate").alias("create_date"), F.col("logHour").alias("create_hour"), F.col("value").alias("total_amount")
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return shop.orders(shop.table(spark, sf, "orders"))


def _details(spark: SparkSession, sf: str) -> DataFrame:
    return shop.details(shop.table(spark, sf, "lineitem"))


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return shop.users(shop.table(spark, sf, "customer"))


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    named = shop.named(_details(spark, sf), shop.table(spark, sf, "part"))
    return sale_detail.sale_detail(_orders(spark, sf), named, _users(spark, sf), F.lit(AS_OF).cast("timestamp"))


def _sale_users(spark: SparkSession, sf: str) -> DataFrame:
    return sale_detail.sale_users(
        _orders(spark, sf), _details(spark, sf), _users(spark, sf), F.lit(AS_OF).cast("timestamp"))


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    entries = shop.order_changes(shop.table(spark, sf, "orders"))
    entries = entries.unionByName(shop.detail_changes(shop.table(spark, sf, "lineitem")))
    entries = entries.unionByName(shop.user_changes(shop.table(spark, sf, "customer")))
    return entries.unionByName(shop.other_changes(shop.table(spark, sf, "nation"), shop.table(spark, sf, "region")))


def _topic(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return change_feed.routed(_changes(spark, sf)).where(F.col("topic") == name).select("value")


# Log lines


@_query
def log_route(spark, sf):
    """Each posted line, stamped, with its topic by text and by type."""
    lines = log_feed.stamped(shop.log_lines(shop.table(spark, sf, "events")), F.col("arrived_ms"))
    strict = log_feed.log_topic(F.col("value"), strict=True)
    return lines.select("event_id", "dt", "topic", strict.alias("strict_topic"), "value")


@_query
def event_parse(spark, sf):
    """Stamped lines read back as event logs."""
    lines = log_feed.stamped(shop.log_lines(shop.table(spark, sf, "events")), F.col("arrived_ms"))
    rows = daily_active.read_logs(lines, EVENT_LOG, keep=("event_id",))
    return rows.select("event_id", "mid", "uid", "type", "evid", "itemid", "ts", "logDate", "logHour")


@_query
def startup_parse(spark, sf):
    """Lines of the start topic read back as startup logs."""
    lines = log_feed.stamped(shop.log_lines(shop.table(spark, sf, "events")), F.col("arrived_ms"))
    rows = daily_active.read_logs(lines.where(F.col("topic") == "startup_log"), STARTUP_LOG, keep=("event_id",))
    return rows.select("event_id", "mid", "uid", "logType", "ts", "logDate", "logHour")


# Change feed


@_query
def cdc_route(spark, sf):
    """One JSON line per inserted row of the watched tables."""
    return change_feed.routed(_changes(spark, sf))


def _broken_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Stamped lines of which every seventh has no readable time and every eleventh is cut short."""
    lines = log_feed.stamped(shop.log_lines(shop.table(spark, sf, "events")), F.col("arrived_ms"))
    value, key = F.col("value"), F.col("event_id")
    return lines.withColumn("value", F.when(key % 11 == 0, F.left(value, F.lit(20))).when(
        key % 7 == 0, F.regexp_replace(value, r'"ts":\d+', '"ts":"soon"')).otherwise(value))


@_query
def log_split(spark, sf):
    """Devices and logs per day of lines of which some are bad, and how many those are."""
    lines = _broken_logs(spark, sf)
    good = daily_active.read_logs(lines, EVENT_LOG).groupBy("logDate").agg(
        F.count("*").alias("n_lines"), F.count_distinct("mid").alias("devices"))
    bad = daily_active.bad_logs(lines, EVENT_LOG).agg(F.lit("bad").alias("logDate"), F.count("*").alias("n_lines"))
    return good.unionByName(bad.withColumn("devices", F.lit(0).cast("bigint")))


@_query
def order_split(spark, sf):
    """Orders and amount per hour where some lines have a huge amount, no time, no readable amount, or no end."""
    rows, key = _orders(spark, sf), F.col("id").cast("bigint")
    odd = rows.withColumns({
        "total_amount": F.when(key % 13 == 0, "1e17").when(key % 17 == 0, "much").otherwise(F.col("total_amount").cast("string")),
        "create_time": F.when(key % 7 == 0, F.col("create_date")).otherwise(F.col("create_time")),
    })
    value = row_json("id", "user_id", "order_status", "total_amount", "create_time")
    lines = odd.select(F.when(key % 11 == 0, F.left(value, F.lit(20))).otherwise(value).alias("value"))
    hourly = order_amount.read_orders(lines).groupBy("create_date", "create_hour").agg(
        F.count("*").alias("n"), order_amount.amount().alias("amount"))
    bad = order_amount.bad_orders(lines).agg(
        F.lit("bad").alias("create_date"), F.lit(None).cast("string").alias("create_hour"), F.count("*").alias("n"),
        F.lit(None).cast("double").alias("amount"))
    return hourly.unionByName(bad)


@_query
def order_parse(spark, sf):
    """Order lines of the change feed as orders."""
    rows = order_amount.read_orders(_topic(spark, sf, ORDER_INFO))
    return rows.select("id", "user_id", "order_status", "total_amount", "create_date", "create_hour")


@_query
def detail_parse(spark, sf):
    rows = parse(_topic(spark, sf, ORDER_DETAIL), DETAIL_RECORD)
    return rows.select("id", "order_id", "sku_id", F.col("order_price").try_cast("double").alias("sku_price"), "sku_num")


@_query
def user_parse(spark, sf):
    return parse(_topic(spark, sf, USER_INFO), USER_RECORD)


@_query
def phone_mask(spark, sf):
    """Both mask forms, over customer names as the tables hold no phone numbers."""
    return shop.table(spark, sf, "customer").select(
        "c_custkey",
        mask_prefix(F.col("c_name"), *order_amount.ORDER_MASK).alias("order_mask"),
        mask_prefix(F.col("c_name"), *order_amount.SALE_MASK).alias("sale_mask"),
    )


# Daily active devices


@_query
def dau_rows(spark, sf):
    return _active(spark, sf)


@_query
def dau_total(spark, sf):
    return daily_active.active_total(_hours(spark, sf))


@_query
def dau_hourly(spark, sf):
    return daily_active.active_hourly(_hours(spark, sf))


@_query
def hourly_map(spark, sf):
    """The map hour -> devices of each day, as JSON."""
    maps = hour_map(daily_active.active_hourly(_hours(spark, sf)), "logDate", "logHour", "n")
    return maps.select("logDate", F.to_json("hours").alias("hours"))


@_query
def new_devices(spark, sf):
    return daily_active.new_devices(_hours(spark, sf))


@_query
def seen_anti(spark, sf):
    """Afternoon logs of devices that logged nothing in the morning of that day."""
    logs = _logs(spark, sf).select("event_id", "logDate", "logHour", "mid")
    early = F.col("logHour") < "12"
    return unseen(logs.where(~early), logs.where(early), ["logDate", "mid"]).select("event_id", "logDate", "mid")


@_query
def hourly_compare(spark, sf):
    """Devices per hour of every day against the day before."""
    hourly = daily_active.active_hourly(_hours(spark, sf))
    return day_against_previous(hourly, "logDate", "logHour", "n")


# Order amounts


@_query
def gmv_daily(spark, sf):
    return order_amount.amount_total(_purchases(spark, sf))


@_query
def gmv_hourly(spark, sf):
    return order_amount.amount_hourly(_purchases(spark, sf))


@_query
def gmv_by_order_date(spark, sf):
    """Order amount per day, an order that came twice counted once."""
    rows = latest_per_key(_orders(spark, sf).select("id", "create_date", "total_amount"), ["id"], ["create_date", "total_amount"])
    return order_amount.amount_total(rows)


@_query
def amount_compare(spark, sf):
    """Amounts per hour of every day against the day before."""
    hourly = order_amount.amount_hourly(_purchases(spark, sf))
    return day_against_previous(hourly, "create_date", "create_hour", "amount")


@_query
def kpi_list(spark, sf):
    """The three figures of every day."""
    return reports.kpis_by_day(_hours(spark, sf), _purchases(spark, sf))


@_query
def day_curves(spark, sf):
    """Both metrics of one day and the day before, as maps hour -> value."""
    active, orders = _hours(spark, sf), _purchases(spark, sf)
    both = [
        reports.hourly_curves(metric, active, orders, CURVE_DAY).select(
            F.lit(metric).alias("metric"), F.to_json("today").alias("today"), F.to_json("yesterday").alias("yesterday")
        )
        for metric in ("dau", "order_amount")
    ]
    return both[0].unionByName(both[1])


@_query
def orders_by_province(spark, sf):
    customers, nations = shop.table(spark, sf, "customer"), shop.table(spark, sf, "nation")
    places = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("n_name").alias("province")
    )
    return order_amount.by_user_province(_orders(spark, sf), places, "province")


# Sale detail


@_query
def sale_full_outer(spark, sf):
    return sale_detail.order_coverage(_orders(spark, sf), _details(spark, sf))


@_query
def sale_wide(spark, sf):
    return _sales(spark, sf)


@_query
def sale_interval_join(spark, sf):
    """Order-detail pairs whose dates lie within the limit."""
    left = _orders(spark, sf).select(F.col("id").alias("order_id"), F.col("arrived").alias("_oat"))
    right = _details(spark, sf).select(F.col("id").alias("detail_id"), F.col("order_id").alias("_order"), F.col("arrived").alias("_dat"))
    return interval_join(left, right, "order_id", "_order", "_oat", "_dat", JOIN_SECONDS).select("order_id", "detail_id")


@_query
def user_age(spark, sf):
    return _users(spark, sf).select("id", "birthday", age_years(F.col("birthday"), F.lit(AS_OF).cast("timestamp")).alias("age"))


@_query
def terms_gender(spark, sf):
    return top_terms(_sale_users(spark, sf), "user_gender", 2)


@_query
def terms_age(spark, sf):
    return top_terms(_sale_users(spark, sf), "user_age", 100)


@_query
def terms_name(spark, sf):
    return top_terms(_sales(spark, sf), "sku_name", 10)


@_query
def gender_ratio(spark, sf):
    """Gender shares of every day."""
    return reports.gender_shares(_sale_users(spark, sf), ("dt",))


@_query
def age_ratio(spark, sf):
    """Age shares of every day."""
    return reports.age_shares(_sale_users(spark, sf), ("dt",))


@_query
def sale_page(spark, sf):
    """Third page of all sale rows, with their total."""
    return page(kept(_sales(spark, sf).select("doc_id", "dt", "sku_name", "sku_price")), ["doc_id"], 3, 20)


@_query
def sale_report_summary(spark, sf):
    """Total and shares of the report for one day and keyword."""
    hits = reports.sale_hits(_sales(spark, sf), REPORT_DAY, REPORT_WORD)
    blocks = reports.sale_summary(hits).select("total", F.posexplode("stat").alias("block", "stat"))
    return blocks.select("total", F.col("stat.title").alias("title"), F.posexplode("stat.options").alias("pos", "o")).select(
        "total", "title", "pos", F.col("o.name").alias("name"), F.col("o.value").alias("value")
    )


@_query
def sale_report_page(spark, sf):
    """First page of the report for one day and keyword."""
    rows = reports.sale_page(_sales(spark, sf), REPORT_DAY, REPORT_WORD, 1, 20)
    return rows.select("doc_id", "sku_name", "user_gender", "user_age", "score")


@_query
def sale_report_words(spark, sf):
    """First page of the report for a day and two words, ranked with the word counts of all days."""
    rows = reports.sale_page(_sales(spark, sf), REPORT_DAY, REPORT_WORDS, 1, 20)
    return rows.select("doc_id", "sku_name", "score")


@_query
def sale_report(spark, sf):
    """The report document, read again from its JSON, for a day and word, and for blank parameters."""
    sales = kept(_sales(spark, sf))
    layout = "total BIGINT, stat ARRAY<STRUCT<title: STRING, options: ARRAY<STRUCT<name: STRING, value: DOUBLE>>>>, detail ARRAY<STRUCT<doc_id: STRING>>"
    found = [
        reports.sale_report(sales, day, word).select(F.lit(name).alias("asked"), F.from_json("report", layout).alias("r"))
        for name, day, word in (("day", REPORT_DAY, REPORT_WORD), ("blank", "", None))
    ]
    return found[0].unionByName(found[1]).select(
        "asked", F.col("r.total").alias("total"), F.array_join("r.detail.doc_id", ",").alias("doc_ids"),
        F.col("r.stat")[0]["options"][0]["value"].alias("under_20"), F.col("r.stat")[1]["options"][1]["value"].alias("women"),
    )


# Search


@_query
def match_and(spark, sf):
    parts = shop.table(spark, sf, "part")
    return parts.where(match_all(F.col("p_name"), "red plate")).select("p_partkey", "p_name")


@_query
def match_or(spark, sf):
    parts = shop.table(spark, sf, "part")
    return parts.where(match_any(F.col("p_name"), "Red plate")).select("p_partkey", "p_name")


# The words of the part names as Chinese words, to search in.
HAN_WORDS = {"red": "红色", "plate": "盘子", "ring": "戒指", "blue": "蓝色", "widget": "部件", "bolt": "螺栓", "gear": "齿轮"}
HAN_KEYWORD = "红盘"


@_query
def match_han(spark, sf):
    """Part names carried into Chinese, found by single characters: all of them, or any."""
    name = F.col("p_name")
    for word, han in HAN_WORDS.items():
        name = F.replace(name, F.lit(word), F.lit(han))
    parts = shop.table(spark, sf, "part").select("p_partkey", F.replace(name, F.lit(" "), F.lit("")).alias("name"))
    return parts.where(match_any(F.col("name"), HAN_KEYWORD)).withColumn("all_of_them", match_all(F.col("name"), HAN_KEYWORD))


@_query
def bool_filter(spark, sf):
    """An exact term and a full-text match together."""
    parts = shop.table(spark, sf, "part")
    both = (F.col("p_type") == "ECONOMY") & match_any(F.col("p_name"), "red plate")
    return parts.where(both).select("p_partkey", "p_name", "p_type")


@_query
def bm25_rank(spark, sf):
    return ranked(shop.table(spark, sf, "documents").select("doc_id", "text"), "text", SEARCH, "doc_id", 20).select("doc_id", "score")


@_query
def search_pages(spark, sf):
    """All pages of a search, each asked for with the token that the page before it ended with."""
    parts = shop.table(spark, sf, "part").select("p_partkey", "p_name")
    hits = kept(scored(parts, "p_name", PAGED).where(match_all(F.col("p_name"), PAGED)))
    found, token, number = None, None, 1
    while True:
        shown = next_page(hits, "p_partkey", PAGE_SIZE, token)
        rows = shown.select("p_partkey", "score", F.lit(number).alias("page"))
        found = rows if found is None else found.unionByName(rows)
        # Only the row that a page ends with comes to the driver.
        last = shown.orderBy(F.asc("score"), F.desc("p_partkey")).first()
        if last is None:
            return found
        token, number = cursor(last, "p_partkey"), number + 1


@_query
def bm25_max(spark, sf):
    return max_score(shop.table(spark, sf, "documents").select("text"), "text", SEARCH)


@_query
def union_index_scan(spark, sf):
    """Parts, users and provinces as one index of JSON documents."""
    return scan_all({
        "part": (shop.table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), F.col("p_partkey")),
        "user": (_users(spark, sf), F.col("id")),
        "nation": (shop.table(spark, sf, "nation"), F.col("n_nationkey")),
    })


@_query
def hit_rows(spark, sf):
    """Ranked articles as JSON objects, the hit's own fields among the article's."""
    best = ranked(shop.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "red plate", "p_partkey", 10)
    return hit_json(best, "part", F.col("p_partkey")).withColumn("rank_id", F.get_json_object("hit", "$.id"))


@_query
def match_terms(spark, sf):
    """The most frequent brands and types among the articles that a search finds."""
    parts = shop.table(spark, sf, "part")
    return terms_of(parts.where(match_any(F.col("p_name"), "red plate")), ["p_brand", "p_type"], 5)


@_query
def union_columns(spark, sf):
    """The same tables with their columns side by side."""
    return union_all({
        "part": shop.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type"),
        "user": shop.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"),
    })


# Alerts


def _few_items(logs: DataFrame) -> DataFrame:
    return logs.withColumn("itemid", (F.col("event_id") % 5).cast("string"))


def _listed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({c: F.array_join(c, ",") for c in ("uids", "itemIds", "events")})


@_query
def alert_windows_all(spark, sf):
    rows = alert_windows(window_users(_logs(spark, sf), WINDOW, SLIDE, shop.KINDS))
    return rows.select(F.date_format("window_start", _SECOND).alias("window_start"), "mid", "n_users")


@_query
def alert_throttled(spark, sf):
    rows = coupon_alert.alerts(_logs(spark, sf), WINDOW, SLIDE, PERIOD, kinds=shop.KINDS)
    return rows.select(
        F.date_format("period", "yyyy-MM-dd").alias("day"), "mid", F.date_format("window_start", _SECOND).alias("window_start"), "n_users"
    )


@_query
def alert_member_counts(spark, sf):
    logs = _logs(spark, sf)
    found = coupon_alert.alerts(logs, WINDOW, SLIDE, PERIOD, kinds=shop.KINDS)
    counts = coupon_alert.member_counts(logs, found, SLIDE_SECONDS, shop.KINDS)
    return counts.select(F.date_format("window_start", _SECOND).alias("window_start"), "mid", "n_items", "n_events")


@_query
def alert_documents(spark, sf):
    """Alerts with their lists; items are few, so that the same ones come again, as in a shop."""
    logs = _few_items(_logs(spark, sf))
    return _listed(coupon_alert.documents(logs, WINDOW, SLIDE, SLIDE_SECONDS, PERIOD, kinds=shop.KINDS))


@_query
def alert_headers(spark, sf):
    """The header rows that alerts are stored as."""
    return coupon_alert.stored_alerts(
        _few_items(_logs(spark, sf)), WINDOW, SLIDE, SLIDE_SECONDS, PERIOD, kinds=shop.KINDS)[0]


# Keyed tables


@_query
def user_latest(spark, sf):
    """Each user's newest row in a feed where every order sends one."""
    feed = shop.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("user_level"), "o_orderdate", "o_orderkey"
    )
    return latest_per_key(feed, ["id"], ["o_orderdate", "o_orderkey"]).select("id", "user_level", "o_orderkey")


@_query
def upsert_last_wins(spark, sf):
    """Order lines upserted by order in two batches, the second one sent twice, read back."""
    lines = shop.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("shipped")
    )
    schema = "l_orderkey BIGINT, l_linestatus STRING, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, shipped TIMESTAMP"
    order = ["shipped", "l_linenumber", "l_partkey", "l_suppkey"]
    stored = KeyedTable(shared_dir(spark, "upsert"), schema, ["l_orderkey"], order)
    first = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    stored.upsert(lines.where(first), 0)
    stored.upsert(lines.where(~first), 1)
    stored.upsert(lines.where(~first), 1)
    return stored.read(spark).withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


# Streams. Each runs over the whole table as a stream into a folder of its own and is read back from there.


def _stream_query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(stream_session(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return _query(run)


def _event_stream(spark: SparkSession, sf: str, run: str) -> DataFrame:
    return shop.logs(shop.sliced_stream(spark, sf, "events", shop.EVENTS_DDL, "ts", f"{run}/events"))


def _order_stream(spark: SparkSession, sf: str, run: str) -> DataFrame:
    return shop.orders(shop.sliced_stream(spark, sf, "orders", shop.ORDERS_DDL, "o_orderdate", f"{run}/orders"))


def _detail_stream(spark: SparkSession, sf: str, run: str) -> DataFrame:
    lines = shop.sliced_stream(spark, sf, "lineitem", shop.LINEITEM_DDL, "l_shipdate", f"{run}/lines")
    return shop.named(shop.details(lines), shop.table(spark, sf, "part"))


def _order_records(spark: SparkSession, sf: str, run: str) -> DataFrame:
    """Orders as they come off their topic: JSON lines, parsed, with arrival."""
    source = _order_stream(spark, sf, run)
    lines = source.select("arrived", row_json("id", "user_id", "order_status", "total_amount", "create_time").alias("value"))
    return order_amount.read_orders(lines, keep=("arrived",))


@_stream_query
def dau_stream(spark, sf):
    run = shared_dir(spark, "dau")
    schema = "logDate STRING, mid STRING, uid STRING, logHour STRING, ts BIGINT, event_id BIGINT"
    stored = active_stream.active_table(f"{run}/table", schema, ("ts", "event_id"))
    columns = ("uid", "logHour", "ts", "event_id")
    finish(active_stream.run_daily_active(_event_stream(spark, sf, run), columns, stored, f"{run}/state", interval=None))
    return stored.read(spark)


@_stream_query
def kpi_day(spark, sf):
    """The three figures of one day from the tables that streams keep: that day's folders are read and no others."""
    run = shared_dir(spark, "kpi")
    events = _event_stream(spark, sf, run)
    active = active_stream.active_table(f"{run}/active", "logDate STRING, mid STRING, ts BIGINT, event_id BIGINT", ("ts", "event_id"))
    finish(active_stream.run_daily_active(events, ("ts", "event_id"), active, f"{run}/state", interval=None))
    seen = active_stream.first_seen_table(f"{run}/seen", buckets=2)
    finish(active_stream.run_first_seen(events, seen, f"{run}/seen-state", fold_every=3, interval=None))
    return reports.kpis(active.read(spark), _purchases(spark, sf), CURVE_DAY, seen.read(spark))


@_stream_query
def first_arrival_stream(spark, sf):
    run = shared_dir(spark, "first")
    stored = KeyedTable(f"{run}/table", "logDate STRING, mid STRING", ["logDate", "mid"], [])
    rows = active_stream.first_arrivals(_event_stream(spark, sf, run))
    finish(order_stream.run_upserts(rows, stored, f"{run}/state", interval=None))
    return stored.read(spark)


def _gmv(spark: SparkSession, sf: str, by_day: bool) -> DataFrame:
    run = shared_dir(spark, "gmv")
    stored = order_stream.order_table(f"{run}/table", by_day)
    finish(order_stream.run_upserts(_order_records(spark, sf, run), stored, f"{run}/state", interval=None))
    return order_amount.amount_total(stored.read(spark))


@_stream_query
def gmv_stream(spark, sf):
    """Orders kept by id from a stream, summed per day."""
    return _gmv(spark, sf, by_day=False)


@_stream_query
def gmv_day_stream(spark, sf):
    """The same in folders by day, as production keeps them; the test data has a folder for each of 2,400 days."""
    return _gmv(spark, sf, by_day=True)


@_stream_query
def folded_stream(spark, sf):
    """Each user's newest row, upserted in two dozen batches, folded on the way and read while they come in."""
    run = shared_dir(spark, "folded")
    rows = shop.sliced_stream(spark, sf, "orders", shop.ORDERS_DDL, "o_orderdate", f"{run}/orders", slices=24)
    feed = rows.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("user_level"), "o_orderdate", "o_orderkey")
    schema = "id BIGINT, user_level STRING, o_orderdate TIMESTAMP_NTZ, o_orderkey BIGINT"
    stored = KeyedTable(f"{run}/table", schema, ["id"], ["o_orderdate", "o_orderkey"], buckets=3)
    finish(order_stream.run_upserts(feed, stored, f"{run}/state", fold_every=7, interval=None))
    return stored.read(spark).select("id", "user_level", "o_orderkey")


@_stream_query
def user_snapshot_stream(spark, sf):
    """Users from the change feed, through their topic, into the table lookups read."""
    run = shared_dir(spark, "users")
    changes = shop.user_changes(shop.table_stream(spark, sf, "customer", shop.CUSTOMER_DDL))
    finish(routers.run_change_router(changes, f"{run}/topics", f"{run}/route", interval=None))
    lines = of_topic(read_topics(spark, "text", [USER_INFO], f"{run}/topics"), USER_INFO)
    stored = order_stream.user_table(f"{run}/table")
    finish(order_stream.run_upserts(parse(lines, USER_RECORD, keep=("arrived",)), stored, f"{run}/state", interval=None))
    return stored.read(spark).drop("arrived")


@_stream_query
def log_router_stream(spark, sf):
    """Posted lines through the router, read back from the topics."""
    run = shared_dir(spark, "logs")
    lines = shop.log_lines(shop.table_stream(spark, sf, "events", shop.EVENTS_DDL))
    finish(routers.run_log_router(lines, F.col("arrived_ms"), f"{run}/topics", f"{run}/raw", f"{run}/state", interval=None))
    return spark.read.text(f"{run}/topics").select("topic", "value")


@_stream_query
def change_router_stream(spark, sf):
    """Order, detail and user changes through the router, read back from the topics."""
    run = shared_dir(spark, "changes")
    entries = shop.order_changes(shop.table_stream(spark, sf, "orders", shop.ORDERS_DDL))
    entries = entries.unionByName(shop.detail_changes(shop.table_stream(spark, sf, "lineitem", shop.LINEITEM_DDL)))
    entries = entries.unionByName(shop.user_changes(shop.table_stream(spark, sf, "customer", shop.CUSTOMER_DDL)))
    finish(routers.run_change_router(entries, f"{run}/topics", f"{run}/state", interval=None))
    return spark.read.text(f"{run}/topics").select("topic", "value")


def _sale_stream(spark: SparkSession, sf: str, by_day: bool) -> DataFrame:
    run = shared_dir(spark, "sales")
    stored = sale_stream_.sale_table(f"{run}/table", by_day)
    finish(sale_stream_.run_sale_detail(
        _order_records(spark, sf, run), _detail_stream(spark, sf, run), lambda session: _users(session, sf), stored,
        f"{run}/state", F.lit(AS_OF).cast("timestamp"), JOIN_SECONDS, interval=None,
    ))
    return stored.read(spark).drop("order_arrived")


@_stream_query
def sale_stream(spark, sf):
    """Two streams joined within the limit, users looked up, wide rows upserted and read back."""
    return _sale_stream(spark, sf, by_day=False)


@_stream_query
def sale_day_stream(spark, sf):
    """The same in folders by day."""
    return _sale_stream(spark, sf, by_day=True)


@_stream_query
def sale_waiting_stream(spark, sf):
    """The same, with orders waiting in a table and only their ids in the join's state."""
    run = shared_dir(spark, "waiting")
    stored = sale_stream_.sale_table(f"{run}/table", by_day=False)
    waiting = sale_stream_.waiting_table(f"{run}/orders", buckets=4, by_day=False)
    finish(sale_stream_.run_sale_detail(
        _order_records(spark, sf, run), _detail_stream(spark, sf, run), lambda session: _users(session, sf), stored,
        f"{run}/state", F.lit(AS_OF).cast("timestamp"), JOIN_SECONDS, waiting=waiting, interval=None,
    ))
    return stored.read(spark).drop("order_arrived")


@_stream_query
def sale_live_stream(spark, sf):
    """Sale detail whose users come from the table that the user stream keeps, folded on the way."""
    run = shared_dir(spark, "live")
    changes = shop.user_changes(shop.sliced_stream(spark, sf, "customer", shop.CUSTOMER_DDL, "c_custkey", f"{run}/customers"))
    finish(routers.run_change_router(changes, f"{run}/topics", f"{run}/route", interval=None))
    lines = of_topic(read_topics(spark, "text", [USER_INFO], f"{run}/topics", most=2), USER_INFO)
    known = order_stream.user_table(f"{run}/users", buckets=4)
    finish(order_stream.run_upserts(
        parse(lines, USER_RECORD, keep=("arrived",)), known, f"{run}/users-state", fold_every=2, interval=None))
    stored = sale_stream_.sale_table(f"{run}/table", by_day=False)
    finish(sale_stream_.run_sale_detail(
        _order_records(spark, sf, run), _detail_stream(spark, sf, run), known, stored, f"{run}/state",
        F.lit(AS_OF).cast("timestamp"), JOIN_SECONDS, interval=None,
    ))
    return stored.read(spark).drop("order_arrived")


@_stream_query
def sale_report_kept(spark, sf):
    """The report's page from the tables that the sale stream keeps: sales of that day, and counts of that word."""
    run = shared_dir(spark, "report")
    stored = sale_stream_.sale_table(f"{run}/table", by_day=False)
    names = sale_stream_.name_table(f"{run}/names", buckets=4)
    finish(sale_stream_.run_sale_detail(
        _order_records(spark, sf, run), _detail_stream(spark, sf, run), lambda session: _users(session, sf), stored,
        f"{run}/state", F.lit(AS_OF).cast("timestamp"), JOIN_SECONDS, names=names, fold_every=3, interval=None,
    ))
    counts = reports.kept_name_counts(names, spark, REPORT_WORD)
    rows = reports.sale_page(stored.read(spark), KEPT_DAY, REPORT_WORD, 1, 20, counts)
    return rows.select("doc_id", "sku_name", "user_gender", "user_age", "score")


@_stream_query
def coverage_stream(spark, sf):
    """Which orders and details found each other in two streams, lone ones once their time is over."""
    run = shared_dir(spark, "coverage")
    finish(sale_stream_.run_coverage(
        _order_stream(spark, sf, run), _detail_stream(spark, sf, run), f"{run}/table", f"{run}/state", JOIN_SECONDS, interval=None))
    found = spark.read.parquet(f"{run}/table")
    side = F.when(F.col("order_arrived").isNull(), "detail only").when(F.col("detail_arrived").isNull(), "order only").otherwise("both")
    return found.select("order_id", F.col("order_detail_id").alias("detail_id"), side.alias("side"))


@_stream_query
def raw_log_stream(spark, sf):
    """The raw log of stamped lines, by day of arrival."""
    run = shared_dir(spark, "raw")
    lines = shop.log_lines(shop.sliced_stream(spark, sf, "events", shop.EVENTS_DDL, "ts", f"{run}/events"))
    finish(routers.run_log_router(lines, F.col("arrived_ms"), f"{run}/topics", f"{run}/raw", f"{run}/state", interval=None))
    return spark.read.schema("value STRING, dt STRING").text(f"{run}/raw").select("dt", "value")


@_stream_query
def alert_stream(spark, sf):
    """Window members kept by a stream, alerts taken from them."""
    run = shared_dir(spark, "alerts")
    stored = alert_stream_.member_table(f"{run}/table")
    finish(alert_stream_.run_member_replay(_event_stream(spark, sf, run), stored, f"{run}/state", SLIDE))
    rows = throttle(windows_of_slides(stored.read(spark), WINDOW_SECONDS, SLIDE_SECONDS, kinds=shop.KINDS), PERIOD)
    return rows.select(
        F.date_format("period", "yyyy-MM-dd").alias("day"), "mid", F.date_format("window_start", _SECOND).alias("window_start"), "n_users"
    )


@_stream_query
def alert_store_stream(spark, sf):
    """The live alert job over several batches: alerts of all windows that are over, with their lists."""
    run = shared_dir(spark, "warned")
    events = shop.sliced_stream(spark, sf, "events", shop.EVENTS_DDL, "ts", f"{run}/events")
    tables = alert_stream_.alert_tables(f"{run}/table")
    finish(alert_stream_.run_alerts(
        _few_items(shop.logs(events)), tables, f"{run}/state", WINDOW, SLIDE, PERIOD, ALERT_LATE, kinds=shop.KINDS, interval=None))
    headers, rows = (stored.read(spark) for stored in tables)
    return _listed(as_documents(headers, rows, shop.KINDS))


@_stream_query
def batch_counts(spark, sf):
    """Rows per micro-batch, as the stream's progress tells them, and added up."""
    run = shared_dir(spark, "counts")
    rows = shop.sliced_stream(spark, sf, "events", shop.EVENTS_DDL, "ts", f"{run}/events")
    query = finish(routers.run_batch_counts(rows, f"{run}/rows", f"{run}/state", interval=None))
    return routers.batch_counts(query, spark).agg(F.sum("n").alias("n_rows"))


@_stream_query
def late_rows_stream(spark, sf):
    """Events of which every tenth is delivered with the last ones: those in hours still open, and those set aside as late."""
    run = shared_dir(spark, "late")
    delivered = F.when(F.col("event_id") % 10 == 0, F.lit(DELIVERED).cast("timestamp")).otherwise(F.col("ts").cast("timestamp"))
    events = shop.logs(shop.sliced_stream(spark, sf, "events", shop.EVENTS_DDL, delivered, f"{run}/events"))
    finish(run_split_late(events, f"{run}/split", f"{run}/split-state", "1 hour", ALERT_LATE, interval=None))
    hours = alert_stream_.member_table(f"{run}/hours")
    on_time = read_files(spark, f"{run}/split/kept", ", ".join(f"`{own.name}` {own.dataType.simpleString()}" for own in events.schema))
    finish(alert_stream_.run_member_replay(on_time, hours, f"{run}/state", "1 hour", ALERT_LATE))
    kept_rows = hours.read(spark).select(F.lit("kept").alias("part"), "mid", "n")
    late = spark.read.parquet(f"{run}/split/late").select(F.lit("late").alias("part"), "mid", F.lit(1).cast("bigint").alias("n"))
    return kept_rows.unionByName(late).groupBy("part", "mid").agg(F.sum("n").alias("n"))


@_stream_query
def recovered_stream(spark, sf):
    """Orders kept by a stream whose writer is lost after its third batch is written, and that starts again from its checkpoint."""
    run = shared_dir(spark, "recovered")
    stored = order_stream.order_table(f"{run}/table", by_day=False)
    orders = _order_records(spark, sf, run)

    class LosesOne:
        def upsert(self, rows: DataFrame, batch_id: int) -> None:
            stored.upsert(rows, batch_id)
            if batch_id == 2:
                raise RuntimeError("lost")

    try:
        finish(order_stream.run_upserts(orders, LosesOne(), f"{run}/state", interval=None))
    except StreamingQueryException as lost:
        if "lost" not in str(lost):
            raise
    finish(order_stream.run_upserts(orders, stored, f"{run}/state", interval=None))
    return order_amount.amount_total(stored.read(spark))


@_stream_query
def paced_stream(spark, sf):
    """Orders kept by a stream on its interval, which is stopped once all is read."""
    run = shared_dir(spark, "paced")
    stored = order_stream.order_table(f"{run}/table", by_day=False)
    drain(order_stream.run_upserts(_order_records(spark, sf, run), stored, f"{run}/state", interval=BATCH_INTERVAL))
    return order_amount.amount_total(stored.read(spark))


@_stream_query
def posted_lines_stream(spark, sf):
    """Lines posted as text files through the router, by topic, with the document of the last batch upserted by itself."""
    run = shared_dir(spark, "posted")
    lines = shop.log_lines(shop.table(spark, sf, "events"))
    lines.select("value").repartition(4).write.text(f"{run}/posted")
    posted = read_files(spark, f"{run}/posted", "value STRING", "text", most=2)
    finish(routers.run_log_router(posted, F.lit(0).cast("bigint"), f"{run}/topics", f"{run}/raw", f"{run}/state", interval=None))
    topics = KeyedTable(f"{run}/topics-table", "doc_id STRING, topic STRING, n BIGINT", ["doc_id"], [])
    counts = spark.read.text(f"{run}/topics").groupBy("topic").count().collect()
    for batch_id, row in enumerate([*counts, *counts]):
        one = {"topic": row["topic"], "n": row["count"]}
        topics.upsert(one_document(spark, one, row["topic"], "topic STRING, n BIGINT"), batch_id)
    return topics.read(spark).select("topic", "n")
