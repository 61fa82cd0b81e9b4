"""Streams: equal to the batch answer however the input is cut, ordered or interrupted."""

from __future__ import annotations

import json
import os
import random
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillwatch.functions.json import parse
from tillwatch.operators.alerts import (
    alert_windows, as_documents, over_windows, throttle, users_of_members, window_users, windows_of_slides,
)
from tillwatch.plans import coupon_alert, reports
from tillwatch.plans.daily_active import active_total, bad_logs, daily_active, read_logs
from tillwatch.plans.order_amount import SALE_MASK, read_orders
from tillwatch.records import (
    CHANGE_DDL, DAILY_ACTIVE_COLUMNS, DETAIL_RECORD, EVENT_LOG, ORDER_DETAIL, ORDER_INFO, STARTUP_LOG, USER_INFO, USER_RECORD,
)
from tillwatch.session import shared_dir
from tillwatch.sources import shop_tables
from tillwatch.sources.keyed_table import KeyedTable, one_document, with_doc_id
from tillwatch.sources.topics import of_topic, read_files, read_topics, show_stream, write_topics
from tillwatch.streaming import coupon_alert as alerts
from tillwatch.streaming import daily_active as active
from tillwatch.streaming import orders as order_streams
from tillwatch.streaming import routers, sale_detail
from tillwatch.streaming.late import run_split_late
from tillwatch.streaming.run import finish, start
from test_batch import DAY, HOUR, MINUTE, T0, change, random_events


@pytest.fixture
def run(spark):
    return shared_dir(spark, "test")


class Feed:
    """A folder of JSON lines that a stream reads one file per micro-batch."""

    def __init__(self, path):
        self.path, self.count = path, 0

    def add(self, *records):
        self.count += 1
        self.path.mkdir(exist_ok=True)
        target = self.path / f"{self.count:04d}.txt"
        target.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
        # Files are taken by age, which for files written at once is no order.
        os.utime(target, (1_700_000_000 + self.count,) * 2)

    def lines(self, spark):
        return spark.readStream.option("maxFilesPerTrigger", "1").text(str(self.path))


@pytest.fixture
def feed(tmp_path):
    return lambda name: Feed(tmp_path / name)


def chunks(rng, data, n):
    cuts = sorted(rng.sample(range(1, len(data)), n - 1))
    return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]


# Daily active devices

LOG_COLUMNS = ("uid", "appid", "area", "os", "ch", "logType", "vs", "logHour", "ts")


def active_pieces(spark, source, run):
    logs = read_logs(source.lines(spark), STARTUP_LOG).withColumn("event_time", F.timestamp_millis("ts"))
    return logs, active.active_table(f"{run}/table")


def play_active(spark, source, run, late="10 minutes"):
    logs, table = active_pieces(spark, source, run)
    query = finish(active.run_daily_active(logs, LOG_COLUMNS, table, f"{run}/state", late=late, interval=None))
    return table, query


def log(mid, ts):
    return {"type": "startup", "mid": mid, "uid": "1", "ts": str(ts)}


def test_daily_active_over_batches(spark, feed, run, rows):
    source = feed("logs")
    source.add(log("m", T0 + MINUTE), log("m", T0))
    source.add(log("m", T0 + HOUR))
    source.add(log("m", T0 + 14 * HOUR + MINUTE))
    table, _ = play_active(spark, source, run)
    assert rows(table.read(spark), "logDate", "ts") == [("2024-01-01", T0), ("2024-01-02", T0 + 14 * HOUR + MINUTE)]
    assert table.read(spark).select(*DAILY_ACTIVE_COLUMNS).first()["uid"] == "1"


def test_row_behind_the_watermark_is_counted_and_changes_nothing(spark, feed, run, rows):
    source = feed("logs")
    source.add(log("m", T0 + HOUR))
    source.add(log("n", T0 + 3 * DAY))
    source.add(log("n", T0 + 3 * DAY + 1))
    source.add(log("m", T0))
    table, query = play_active(spark, source, run)
    assert rows(table.read(spark).where("mid = 'm'"), "ts") == [(T0 + HOUR,)]
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 1
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_daily_active_stream_equals_batch(spark, feed, run, rows, seed):
    rng = random.Random(seed)
    data = [log(f"m{rng.randrange(5)}", T0 + rng.randrange(4 * DAY)) for _ in range(80)]
    source = feed("logs")
    for part in chunks(rng, data, 4):
        source.add(*part)
    table, _ = play_active(spark, source, run, late="10 days")
    batch = daily_active(read_logs(spark.read.text(str(source.path)), STARTUP_LOG).dropDuplicates(["mid", "ts"]))
    assert rows(table.read(spark), "logDate", "logHour", "mid", "ts") == rows(batch, "logDate", "logHour", "mid", "ts")


def test_restart_from_the_checkpoint_adds_nothing_twice(spark, feed, run, rows):
    source = feed("logs")
    source.add(log("a", T0), log("b", T0))
    play_active(spark, source, run)
    source.add(log("a", T0 + 1), log("c", T0 + 2))
    table, _ = play_active(spark, source, run)
    assert rows(table.read(spark), "mid", "ts") == [("a", T0), ("b", T0), ("c", T0 + 2)]


def test_a_batch_that_fails_after_its_write_is_replayed_without_copies(spark, feed, run, rows):
    source = feed("logs")
    source.add(log("a", T0), log("b", T0))
    source.add(log("a", T0 - 5), log("c", T0 + 2))
    logs, table = active_pieces(spark, source, run)

    def save_and_fail(batch, batch_id):
        table.upsert(batch, batch_id, unique=True)
        if batch_id == 1:
            raise RuntimeError("lost")

    updates = active.earliest_so_far(logs, LOG_COLUMNS)
    with pytest.raises(StreamingQueryException):
        finish(start(updates, save_and_fail, f"{run}/state", mode="update", interval=None))
    play_active(spark, source, run)
    assert rows(table.read(spark), "mid", "ts") == [("a", T0 - 5), ("b", T0), ("c", T0 + 2)]
    assert table._standing(spark).count() == 4


def test_first_days_follow_late_logs_and_are_read_from_one_folder(spark, feed, run, rows):
    source = feed("logs")
    source.add(log("a", T0 + DAY), log("b", T0 + DAY))
    source.add(log("a", T0), log("c", T0 + DAY + 1))
    logs = read_logs(source.lines(spark), STARTUP_LOG).withColumn("event_time", F.timestamp_millis("ts"))
    table = active.first_seen_table(f"{run}/seen")
    finish(active.run_first_seen(logs, table, f"{run}/state", late="2 days", interval=None))
    seen = table.read(spark)
    assert rows(seen.where("n = 1"), "mid", "logDate") == [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "2024-01-02")]
    # The last batch again: it is held against what there was before it, and changes nothing.
    again = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-02", "c")], "logDate STRING, mid STRING")
    before = rows(seen)
    table.upsert(active.first_seen_changes(again, table.lookup(again, ["mid"], before=1)), 1, unique=True)
    seen = table.read(spark)
    assert rows(seen) == before
    assert active.first_seen_changes(again, seen).count() == 0
    plan = active_total(seen.where("n = 1"), "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "logDate" in filters and active_total(seen.where("n = 1"), "2024-01-02").first()["total"] == 2


def test_a_hot_order_is_dealt_over_its_salts(spark):
    orders = spark.createDataFrame([("hot", "2024-01-01"), ("x", "2024-01-01")], "id STRING, create_date STRING").selectExpr(
        "id", "'new' AS order_status", "'t' AS create_time", "'u' AS user_id", "create_date", "timestamp'2024-01-01 00:00:00' AS arrived")
    details = spark.range(3000).selectExpr(
        "CAST(id AS STRING) AS id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS order_id", "'s' AS sku_id", "'1' AS order_price",
        "'n' AS sku_name", "timestamp'2024-01-01 00:00:00' AS arrived")
    left, right = sale_detail._sides(sale_detail._orders_wide(orders), sale_detail._details_wide(details), "1 hour", salts=8)
    assert left.count() == 16
    shares = [r["count"] for r in right.where("_order = 'hot'").groupBy("_own_salt").count().collect()]
    assert len(shares) == 8 and max(shares) < 2 * 1000 / 8


def test_first_arrivals_free_their_state(spark, feed, run, rows):
    source = feed("logs")
    for day in range(5):
        source.add(log("m", T0 + day * DAY), log("m", T0 + day * DAY + 1))
    logs, _ = active_pieces(spark, source, run)
    seen = KeyedTable(f"{run}/seen", "logDate STRING, mid STRING", ["logDate", "mid"], [])
    query = finish(order_streams.run_upserts(active.first_arrivals(logs), seen, f"{run}/first", interval=None))
    assert seen.read(spark).count() == 5
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_work_on_a_batch_is_adaptive_and_state_is_not(spark, feed, run):
    source = feed("logs")
    source.add(log("a", T0), log("b", T0))
    source.add(log("a", T0 + DAY))
    logs, _ = active_pieces(spark, source, run)
    seen = []

    def look(batch, _):
        again = batch.groupBy("mid").count()
        seen.append("AdaptiveSparkPlan" in again._jdf.queryExecution().executedPlan().toString())
        again.collect()

    query = finish(start(active.earliest_so_far(logs, LOG_COLUMNS), look, f"{run}/state", mode="update", interval=None))
    assert seen and all(seen)
    assert all(o["numShufflePartitions"] == 4 for p in query.recentProgress for o in p["stateOperators"])


# Sale detail


def timed(records, seconds):
    return {**records, "arrived": f"2024-01-01 10:{seconds // 60:02d}:{seconds % 60:02d}"}


def order(i, seconds, status="new"):
    return timed({"id": i, "user_id": "u1", "order_status": status, "total_amount": "1", "create_time": "2024-01-01 10:00:00", "consignee_tel": "13812345678"}, seconds)


def detail(i, o, seconds):
    return timed({"id": i, "order_id": o, "sku_id": "s", "sku_name": "plate", "order_price": "2.5", "sku_num": "1"}, seconds)


def with_arrival(lines):
    return lines.withColumn("arrived", F.to_timestamp(F.get_json_object("value", "$.arrived")))


def sale_sides(spark, orders, details):
    left = read_orders(with_arrival(orders.lines(spark)), SALE_MASK, keep=("arrived",))
    return left, parse(with_arrival(details.lines(spark)), DETAIL_RECORD, keep=("arrived",))


def users_of(spark):
    return spark.createDataFrame([("u1", "F", "2000-03-01", "gold")], "id STRING, gender STRING, birthday STRING, user_level STRING")


def play_sales(spark, orders, details, run, **how):
    left, right = sale_sides(spark, orders, details)
    table = sale_detail.sale_table(f"{run}/sales")
    finish(sale_detail.run_sale_detail(left, right, users_of, table, f"{run}/state", F.lit("2020-03-01").cast("timestamp"), interval=None, **how))
    return table.read(spark)


def test_orders_and_details_meet_within_300_seconds(spark, feed, run, rows):
    orders, details = feed("orders"), feed("details")
    orders.add(order("1", 0), order("3", 0), order("4", 0))
    details.add(detail("b", "2", 10))
    orders.add(order("2", 250))
    details.add(detail("a", "1", 200), detail("c", "3", 400))
    got = play_sales(spark, orders, details, run, late="10 minutes")
    assert rows(got, "doc_id", "user_gender", "user_age", "dt") == [("1-a", "F", 20, "2024-01-01"), ("2-b", "F", 20, "2024-01-01")]


def test_an_order_sent_twice_replaces_its_rows(spark, feed, run, rows):
    orders, details = feed("orders"), feed("details")
    orders.add(order("1", 0))
    details.add(detail("a", "1", 5))
    orders.add(order("1", 20, "paid"))
    details.add(detail("z", "none", 20))
    got = play_sales(spark, orders, details, run, late="10 minutes")
    assert rows(got, "doc_id", "order_status") == [("1-a", "paid")]


@pytest.mark.parametrize("seed,salts", [(1, 1), (2, 4)])
def test_matching_does_not_depend_on_order_of_arrival(spark, feed, run, rows, seed, salts):
    rng = random.Random(seed)
    left = [order(str(i), rng.randrange(600)) for i in range(12)]
    right = [detail(f"d{n}", str(rng.randrange(14)), rng.randrange(600)) for n in range(50)]
    orders, details = feed("orders"), feed("details")
    rng.shuffle(left)
    rng.shuffle(right)
    for part in chunks(rng, left, 3):
        orders.add(*part)
    for part in chunks(rng, right, 3):
        details.add(*part)
    got = play_sales(spark, orders, details, run, late="1 hour", salts=salts)

    def at(r):
        minute, second = r["arrived"][-5:].split(":")
        return int(minute) * 60 + int(second)

    want = sorted((f"{o['id']}-{d['id']}",) for o in left for d in right if o["id"] == d["order_id"] and abs(at(o) - at(d)) <= 300)
    assert want and rows(got, "doc_id") == want


def test_orders_wait_in_a_table_as_they_would_in_state(spark, feed, run, rows):
    """Orders and details in random batches, some sent again: the same sales whether orders wait in a table or in state."""
    rng = random.Random(5)
    left = [order(str(i % 9), rng.randrange(600), rng.choice(["new", "paid", "sent"])) for i in range(16)]
    right = [detail(f"d{n}", str(rng.randrange(11)), rng.randrange(600)) for n in range(40)]
    left.append(left[0])
    orders, details = feed("orders"), feed("details")
    for part in chunks(rng, left, 4):
        orders.add(*part)
    for part in chunks(rng, right, 4):
        details.add(*part)
    want = rows(play_sales(spark, orders, details, f"{run}/state-only", late="1 hour"))
    for by_day in (True, False):
        waiting = sale_detail.waiting_table(f"{run}/waiting-{by_day}", buckets=3, by_day=by_day)
        got = play_sales(spark, orders, details, f"{run}/table-{by_day}", late="1 hour", waiting=waiting, fold_every=2)
        assert rows(got) == want != []
        assert waiting.read(spark).count() == len({(o["id"], o["arrived"]) for o in left})


def test_an_order_waits_in_state_with_its_id_and_arrival_alone(spark, feed, run):
    """State bytes do not follow the width of orders, whatever the salts."""
    orders, details = feed("orders"), feed("details")
    orders.add(*[{**order(str(i), i), "user_id": "u" * 4000} for i in range(60)])
    details.add(detail("a", "1", 5))
    left, right = sale_sides(spark, orders, details)

    def state(stream, name):
        query = finish(start(stream, lambda batch, _: batch.count(), f"{run}/{name}", interval=None))
        return next(own["stateOperators"][0] for own in (json.loads(p.json) for p in query.recentProgress) if own["numInputRows"])

    in_state = state(sale_detail.matched_pairs(left, right, late="1 hour", salts=8), "wide")
    in_table = state(sale_detail.matched_ids_and_orders(left, right, late="1 hour", salts=8), "thin")
    lone = state(sale_detail.matched_and_lone(left, right, late="1 hour", salts=8), "lone")
    assert in_state["numRowsTotal"] == in_table["numRowsTotal"] == lone["numRowsTotal"] == 60 * 8 + 1
    assert in_state["memoryUsedBytes"] > 60 * 8 * 4000
    assert max(in_table["memoryUsedBytes"], lone["memoryUsedBytes"]) < 60 * 8 * 1000


def test_lone_orders_and_details_come_out_after_the_watermark(spark, feed, run, rows):
    orders, details = feed("orders"), feed("details")
    orders.add(order("1", 0), order("2", 0))
    details.add(detail("a", "1", 5), detail("b", "9", 5))
    for seconds in (1500, 1600, 1700):
        orders.add(order("late", seconds))
        details.add(detail("l", "late", seconds))
    left, right = sale_sides(spark, orders, details)
    out = f"{run}/out"
    finish(sale_detail.run_coverage(left, right, out, f"{run}/state", interval=None))
    got = rows(spark.read.parquet(out), "order_id", "order_detail_id")
    assert {("1", "a"), ("2", None), ("9", "b")} <= set(got) and ("1", None) not in got
    once = [pair for pair in got if pair[0] != "late"]
    assert len(once) == len(set(once)) == 3


def late_sides(spark, feed):
    """Four batches of both sides, the watermark 10 seconds behind."""
    orders, details = feed("orders"), feed("details")
    for seconds, more in ((0, []), (700, [order("back", 300)]), (1500, [order("old", 20)]), (2300, [])):
        orders.add(order(f"o{seconds}", seconds), *more)
        details.add(detail(f"d{seconds}", f"o{seconds}", seconds), detail(f"b{seconds}", "back", seconds))
    return sale_sides(spark, orders, details)


def test_sides_wait_in_folders_as_they_would_in_state(spark, feed, run, rows):
    """The pairs of a join of streams in state, with rows behind the watermark, from no store of state and the folders in reach alone."""
    left, right = late_sides(spark, feed)
    want = []
    finish(start(sale_detail.matched_pairs(left, right), lambda batch, _: want.extend(rows(batch, "order_id", "order_detail_id")), f"{run}/state", interval=None))
    table = sale_detail.sale_table(f"{run}/sales")
    query = finish(sale_detail.run_sale_detail(left, right, users_of, table, f"{run}/folders", interval=None))
    assert rows(table.read(spark), "order_id", "order_detail_id") == sorted(want) and len(want) >= 4
    assert not any(p["stateOperators"] for p in query.recentProgress)
    held = KeyedTable(f"{run}/folders-waiting/marks", "what STRING, held ARRAY<STRUCT<batch: BIGINT, newest: BIGINT>>", ["what"], []).read(spark).first()["held"]
    assert [own["batch"] for own in held] == [1, 2, 3]


def test_a_batch_of_waiting_sides_runs_again(spark, feed, run, rows):
    left, right = late_sides(spark, feed)

    class LosesOne(KeyedTable):
        def upsert(self, rows, batch_id, unique=False):
            super().upsert(rows, batch_id, unique)
            if batch_id == 1 and not os.path.exists(f"{run}/lost"):
                os.mkdir(f"{run}/lost")
                raise RuntimeError("lost")

    table = sale_detail.sale_table(f"{run}/sales")
    losing = LosesOne(table.path, table.schema, ["doc_id"], ["order_arrived"], ["dt"])
    with pytest.raises(StreamingQueryException, match="lost"):
        finish(sale_detail.run_sale_detail(left, right, users_of, losing, f"{run}/state", interval=None))
    finish(sale_detail.run_sale_detail(left, right, users_of, losing, f"{run}/state", interval=None))
    finish(sale_detail.run_coverage(left, right, f"{run}/out", f"{run}/cover", interval=None))
    pairs = spark.read.parquet(f"{run}/out").where("order_id IS NOT NULL AND order_arrived IS NOT NULL AND detail_arrived IS NOT NULL")
    assert {("o0", "d0"), ("o700", "d700"), ("o1500", "d1500"), ("o2300", "d2300")} <= set(rows(table.read(spark), "order_id", "order_detail_id"))
    assert len(rows(table.read(spark))) == len(set(rows(pairs))) == pairs.count()


def test_large_slices_are_cut_into_more_files(spark, tmp_path, monkeypatch):
    """A micro-batch is a slice, whole and alone, however many files it is written as."""
    monkeypatch.setattr(shop_tables, "FILE_ROWS", 1000)
    rows_ = spark.range(16000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts")
    rows_.write.parquet(str(tmp_path / "events.parquet"))
    stream = shop_tables.sliced_stream(spark, str(tmp_path), "events", "event_id BIGINT, ts TIMESTAMP_NTZ", "ts", str(tmp_path / "cut"))
    assert len(list((tmp_path / "cut").glob("*.parquet"))) == 4 * 4
    seen = []
    finish(start(stream, lambda batch, _: seen.append(batch.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()), str(tmp_path / "state"), interval=None))
    assert [tuple(own) for own in seen] == [(4000 * n, 4000 * n + 3999, 4000) for n in range(4)]


def test_kept_word_counts_follow_rows_that_come_again(spark, run, rows):
    """New, re-sent and renamed rows in random batches, one of them run twice, with folds: as if all names were counted."""
    rng = random.Random(11)
    schema = "doc_id STRING, sku_name STRING, dt STRING, order_arrived TIMESTAMP"
    table = KeyedTable(f"{run}/sales", schema, ["doc_id"], ["order_arrived"])
    names = sale_detail.name_table(f"{run}/names", buckets=4)
    for batch_id in range(5):
        data = [(f"d{i}", rng.choice([None, "", "Red plate", "red red ring", "红 plate", "blue"]), rng.choice(["1", "2", None]))
                for i in rng.sample(range(12), 6)]
        batch = spark.createDataFrame(data, "doc_id STRING, sku_name STRING, dt STRING").withColumn(
            "order_arrived", F.timestamp_seconds(F.lit(batch_id)))
        for _ in range(1 + (batch_id == 3)):
            sale_detail.count_names(batch, table, names, batch_id)
            table.upsert(batch, batch_id, unique=True)
        if batch_id == 2:
            table.fold(spark, 2)
            names.fold(spark, 2)
        for keyword in ("red plate", "红", "none"):
            want = reports.name_counts(table.read(spark), keyword).where("rows > 0")
            kept = reports.kept_name_counts(names, spark, keyword).where("rows > 0")
            assert rows(kept) == rows(want) != []
    plan = reports.kept_name_counts(names, spark, "red")._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]


def test_a_report_from_kept_counts_reads_no_name_of_another_day(spark, feed, run, rows):
    orders, details = feed("orders"), feed("details")
    orders.add(order("1", 0), {**order("2", 0), "create_time": "2024-01-02 10:00:00"})
    details.add(detail("a", "1", 5), {**detail("b", "2", 5), "sku_name": "red plate"}, {**detail("c", "2", 5), "sku_name": "ring"})
    orders.add(order("1", 20, "paid"))
    details.add({**detail("d", "1", 20), "sku_name": "red red plate"})
    left, right = sale_sides(spark, orders, details)
    table, names = sale_detail.sale_table(f"{run}/sales"), sale_detail.name_table(f"{run}/names", 4)
    finish(sale_detail.run_sale_detail(
        left, right, users_of, table, f"{run}/state", late="10 minutes", names=names, fold_every=2, interval=None))
    sales = table.read(spark)
    kept = reports.sale_page(sales, "2024-01-01", "red", 1, 9, reports.kept_name_counts(names, spark, "red"))
    assert rows(kept, "doc_id", "score") == rows(reports.sale_page(sales, "2024-01-01", "red", 1, 9), "doc_id", "score") != []
    scans = [line for line in kept._jdf.queryExecution().executedPlan().toString().split("\n") if "sku_name" in line and "FileScan" in line]
    assert scans and all("2024-01-01" in line for line in scans)


# Alerts


def event_feed(source, rng, data, n):
    lines = [{"type": "event", "mid": m, "uid": u, "evid": k, "itemid": i, "ts": T0 + 1000 * s} for s, m, u, k, i in data]
    for part in chunks(rng, lines, n):
        source.add(*part)


def event_rows(lines):
    return parse(lines, EVENT_LOG).withColumn("event_time", F.timestamp_millis("ts"))


@pytest.mark.parametrize("seed", [1, 2])
def test_alert_stream_equals_batch(spark, feed, run, rows, seed):
    rng = random.Random(seed)
    data = sorted(random_events(seed), key=lambda e: e[0])
    source = feed("events")
    event_feed(source, rng, data, 4)
    # Two lone events far behind move the watermark over every window of the data.
    for second in (2000, 3000):
        source.add({"type": "event", "mid": "end", "uid": "z", "evid": "addCart", "itemid": "1", "ts": T0 + 1000 * second})
    tables = alerts.alert_tables(f"{run}/alerts")
    finish(alerts.run_alerts(event_rows(source.lines(spark)), tables, f"{run}/state", late="1 minute", interval=None))
    batch = coupon_alert.documents(event_rows(spark.read.text(str(source.path))))
    stored = as_documents(*(table.read(spark) for table in tables))
    assert rows(stored) == rows(batch) != []
    headers, _ = coupon_alert.stored_alerts(event_rows(spark.read.text(str(source.path))))
    assert rows(tables[0].read(spark), *headers.columns) == rows(headers)


def test_alerts_hold_each_event_once_and_a_batch_runs_again(spark, feed, run, rows):
    """A window of six slides: an event stands in one row of state, and the alerts are those of all windows together."""
    source = feed("events")
    coupons = [(second, "m", user, "coupon", "7") for second, user in ((0, "a"), (14, "b"), (27, "c"), (61, "a"))]
    for part in (coupons[:1], coupons[1:2], coupons[2:3], coupons[3:]):
        event_feed(source, random.Random(0), part, 1)
    for second in (100, 2000, 3000):
        source.add({"type": "event", "mid": "end", "uid": "z", "evid": "addCart", "itemid": "1", "ts": T0 + 1000 * second})
    tables = alerts.alert_tables(f"{run}/alerts")
    calls = []
    upsert = tables[0].upsert

    def fails_once(batch, batch_id, unique=False):
        upsert(batch, batch_id, unique)
        calls.append(batch_id)
        if calls.count(batch_id) == 1 and batch.count():
            raise RuntimeError("lost after its write")

    tables[0].upsert = fails_once
    held = 0
    for _ in range(9):
        query = alerts.run_alerts(event_rows(source.lines(spark)), tables, f"{run}/state", late="20 seconds", interval=None)
        try:
            finish(query)
            break
        except StreamingQueryException:
            pass
        finally:
            held = max([held, *(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])])
    assert len(calls) > len(set(calls)) and 0 < held <= 4
    assert rows(as_documents(*(table.read(spark) for table in tables))) == rows(
        coupon_alert.documents(event_rows(spark.read.text(str(source.path))))) != []


def test_member_replay_gives_open_windows_too(spark, feed, run, rows):
    rng = random.Random(5)
    source = feed("events")
    event_feed(source, rng, random_events(5), 3)
    table = alerts.member_table(f"{run}/members")
    finish(alerts.run_member_replay(event_rows(source.lines(spark)), table, f"{run}/state", late="1 hour"))
    got = throttle(alert_windows(users_of_members(over_windows(table.read(spark), 30, 5))))
    want = throttle(alert_windows(window_users(event_rows(spark.read.text(str(source.path))))))
    assert rows(got) == rows(want) != []


def test_member_replay_adds_batches_up_without_state(spark, feed, run, rows):
    """Counts, and what is left out as late, are those of a stream with a watermark, also where a batch runs again; nothing waits in state."""
    rng = random.Random(3)
    source = feed("events")
    for part in range(6):
        source.add(*[{"type": "event", "mid": rng.choice(["m", "n", None]), "uid": rng.choice(["a", None]), "evid": "coupon", "itemid": "1",
                      "ts": rng.choice([None, T0 + MINUTE * (10 * part - rng.randrange(30))])} for _ in range(40)])
    events = event_rows(source.lines(spark))
    stateful = KeyedTable(f"{run}/stateful", alerts.MEMBERS_DDL, ["window_start", *alerts.MEMBER], [])
    query = finish(start(alerts.window_member_counts(events, "5 minutes", "5 minutes", "2 minutes"),
                         lambda batch, batch_id: stateful.upsert(batch, batch_id, unique=True), f"{run}/state", "update", interval=None))
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) > 0

    class LosesOne(KeyedTable):
        def upsert(self, rows, batch_id, unique=False):
            super().upsert(rows, batch_id, unique)
            if batch_id == 2 and not os.path.exists(f"{run}/lost"):
                os.mkdir(f"{run}/lost")
                raise RuntimeError("lost")

    plain = alerts.member_table(f"{run}/members")
    table = LosesOne(plain.path, plain.schema, plain.keys, plain.order, keep=plain.keep)
    with pytest.raises(StreamingQueryException, match="lost"):
        finish(alerts.run_member_replay(events, table, f"{run}/replay", "5 minutes", "2 minutes"))
    query = finish(alerts.run_member_replay(events, table, f"{run}/replay", "5 minutes", "2 minutes"))
    assert [o for p in query.recentProgress for o in p["stateOperators"]] == []
    want = rows(stateful.read(spark))
    assert rows(table.read(spark)) == want and max(row[-1] for row in want) > 1
    table.fold(spark, 3)
    assert rows(table.read(spark)) == rows(table.read(spark, joined=True)) == want


@pytest.mark.parametrize("window, slide, least", [(30, 5, 3), (30, 5, 1), (20, 20, 2), (17, 5, 2)])
def test_windows_of_slides_are_those_of_all_windows(spark, rows, window, slide, least):
    """The running sums give what a row for every window of every slide gives, and no such rows are made."""
    rng = random.Random(window + least)
    events = [(T0 // 1000 + rng.randrange(400), rng.choice(["m", "m", "n", None]), rng.choice(["a", "b", "c", "d", None]),
               rng.choice(["coupon"] * 8 + ["clickItem", "addCart"])) for _ in range(200)]
    members = spark.createDataFrame(events, "at LONG, mid STRING, uid STRING, evid STRING").selectExpr(
        f"timestamp_seconds(at - at % {slide}) AS window_start", f"timestamp_seconds(at - at % {slide} + {slide}) AS window_end",
        "mid", "1000 * at AS ts", "evid", "uid", "'1' AS itemid", "1L AS n")
    want = alert_windows(users_of_members(over_windows(members, window, slide)), least)
    got = windows_of_slides(members, window, slide, least)
    assert rows(got, *want.columns) == rows(want) != []
    made = windows_of_slides(members, 10_000_000 * slide, slide, 9).agg(F.count("*").alias("n"))
    assert rows(made) == [(0,)]


# Feeds and topics


def test_log_router_stamps_stores_and_routes(spark, feed, run, rows):
    source = feed("posted")
    source.add('{"type":"startup","mid":"a","ts":"1"}', '{"type":"event","mid":"b"}', "broken")
    source.add('{"type":"startup","mid":"c"}')
    clock = F.lit(T0).cast("bigint")
    finish(routers.run_log_router(source.lines(spark), clock, f"{run}/topics", f"{run}/raw", f"{run}/state", interval=None))
    sent = spark.read.text(f"{run}/topics")
    assert rows(sent.withColumn("mid", F.get_json_object("value", "$.mid")), "topic", "mid") == [
        ("event_log", "b"), ("startup_log", "a"), ("startup_log", "c"),
    ]
    assert {json.loads(r["value"])["ts"] for r in sent.collect()} == {T0}
    raw = spark.read.text(f"{run}/raw")
    assert raw.count() == 4 and {str(r["dt"]) for r in raw.collect()} == {"2024-01-01"}


def test_change_feed_to_topics_to_tables(spark, feed, run, rows):
    def entry(*args):
        table, entry_type, event_type, images = change(*args)
        after = [{"after": [{"name": n, "value": v} for n, v in image[0]]} for image in images]
        return {"table": table, "entry_type": entry_type, "event_type": event_type, "row_datas": after}

    source = feed("changes")
    source.add(
        entry("user_info", "ROWDATA", "INSERT", {"id": "u1", "gender": "F"}, {"id": "u2", "gender": "M"}),
        entry("order_info", "ROWDATA", "INSERT", {"id": "1", "total_amount": "9.5", "create_time": "2024-01-01 10:00:00"}),
        entry("order_info", "ROWDATA", "UPDATE", {"id": "1", "total_amount": "7"}),
        entry("order_detail", "ROWDATA", "INSERT", {"id": "d", "order_id": "1"}),
    )
    changes = source.lines(spark).select(F.from_json("value", CHANGE_DDL).alias("c")).select("c.*")
    finish(routers.run_change_router(changes, f"{run}/topics", f"{run}/route", interval=None))
    lines = read_topics(spark, "text", [USER_INFO, ORDER_INFO], f"{run}/topics", most=1)
    users = order_streams.user_table(f"{run}/users")
    finish(order_streams.run_upserts(parse(of_topic(lines, USER_INFO), USER_RECORD, keep=("arrived",)), users, f"{run}/u", interval=None))
    orders = order_streams.order_table(f"{run}/orders")
    finish(order_streams.run_upserts(read_orders(of_topic(lines, ORDER_INFO), keep=("arrived",)), orders, f"{run}/o", interval=None))
    assert rows(users.read(spark), "id", "gender") == [("u1", "F"), ("u2", "M")]
    assert rows(orders.read(spark), "id", "total_amount", "create_date") == [("1", 9.5, "2024-01-01")]
    assert spark.read.text(f"{run}/topics").where(F.col("topic") == ORDER_DETAIL).count() == 1


def test_malformed_lines_are_set_aside_and_the_stream_goes_on(spark, feed, run):
    source = feed("logs")
    source.add(log("a", T0), "{broken")
    source.add("plain", log("b", T0))
    logs = source.lines(spark)
    table = active.active_table(f"{run}/table")
    rows_ = read_logs(logs, STARTUP_LOG).withColumn("event_time", F.timestamp_millis("ts"))
    finish(active.run_daily_active(rows_, LOG_COLUMNS, table, f"{run}/state", interval=None))
    finish(routers.run_bad_lines(bad_logs(logs, STARTUP_LOG), f"{run}/bad", f"{run}/badstate", interval=None))
    assert table.read(spark).count() == 2
    assert sorted(r["value"] for r in spark.read.text(f"{run}/bad").collect()) == ["plain", "{broken"]


def test_writing_a_batch_again_leaves_one_copy(spark, run):
    batch = spark.createDataFrame([("t", "a"), ("t", "b")], "topic STRING, value STRING")
    for _ in range(2):
        write_topics(batch, "text", f"{run}/topics", 3)
    assert spark.read.text(f"{run}/topics").count() == 2
    with pytest.raises(ValueError):
        write_topics(batch, "pigeon", f"{run}/topics", 3)
    with pytest.raises(ValueError):
        read_topics(spark, "pigeon", ["t"], run)


def test_rows_per_batch(spark, feed, run, rows):
    source = feed("logs")
    source.add("a", "b")
    source.add("c")
    query = finish(routers.run_batch_counts(source.lines(spark), f"{run}/rows", f"{run}/state", interval=None))
    assert rows(routers.batch_counts(query, spark)) == [(0, 2), (1, 1)]
    assert rows(spark.read.parquet(f"{run}/rows"), "value") == [("a",), ("b",), ("c",)]


def test_rows_behind_the_watermark_are_set_aside(spark, feed, run, rows):
    """What a stream of windows drops is what is set aside, batch by batch, also where a batch runs again."""
    rng = random.Random(12)
    source = feed("logs")
    for part in range(5):
        source.add(*[{"type": "event", "mid": f"m{rng.randrange(4)}", "evid": str(n), "ts": T0 + part * HOUR + rng.randrange(-4 * HOUR, HOUR)}
                     for n in range(part * 30, part * 30 + 30)])
    logs = event_rows(source.lines(spark))
    table = alerts.member_table(f"{run}/t")
    def split(rows):
        return finish(run_split_late(rows, f"{run}/split", f"{run}/split-state", "10 minutes", "20 minutes", interval=None))

    split(logs)
    kept, late = (rows(spark.read.parquet(f"{run}/split/{part}"), "evid") for part in ("kept", "late"))
    assert sorted(kept + late) == sorted((str(n),) for n in range(150))
    newest, want = None, []
    for part in range(5):
        batch = [json.loads(line) for line in (source.path / f"{part + 1:04d}.txt").read_text().splitlines()]
        want += [(row["evid"],) for row in batch if newest and (row["ts"] // (10 * MINUTE) + 1) * 10 * MINUTE + 20 * MINUTE <= newest]
        newest = max([newest or 0, *(row["ts"] for row in batch)])
    assert late == sorted(want, key=repr) and 20 < len(late) < 130
    # A stream of windows over what is kept drops nothing, read a batch at a time.
    ddl = ", ".join(f"`{own.name}` {own.dataType.simpleString()}" for own in logs.schema)
    on_time = read_files(spark, f"{run}/split/kept", ddl, most=1)
    query = finish(alerts.run_member_replay(on_time, table, f"{run}/state", "10 minutes", "20 minutes"))
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 0
    assert rows(table.read(spark), "evid") == kept


def test_console_and_file_streams_are_set_up(spark, run):
    spark.range(4).withColumn("v", F.lit("x")).write.parquet(f"{run}/in")
    stream = read_files(spark, f"{run}/in", "id BIGINT, v STRING", most=1)
    assert stream.isStreaming and show_stream(stream, 3) is not None


# Keyed tables


def batch_of(spark, *data):
    return spark.createDataFrame(list(data), "k STRING, d STRING, o INT, v STRING")


def keyed(run, keep="last", by=("d",)):
    return KeyedTable(f"{run}/t", "k STRING, d STRING, o INT, v STRING", ["k"], ["o"], list(by), keep)


def test_last_batch_wins_and_a_repeat_changes_nothing(spark, run, rows):
    table = keyed(run)
    assert table.read(spark).count() == 0
    table.upsert(batch_of(spark, ("a", "d1", 5, "old"), ("b", "d1", 1, "b")), 0)
    table.upsert(batch_of(spark, ("a", "d1", 1, "low"), ("a", "d1", 2, "new"), ("c", "d2", 1, "c")), 1)
    want = [("a", "new"), ("b", "b"), ("c", "c")]
    assert rows(table.read(spark), "k", "v") == want
    table.upsert(batch_of(spark, ("a", "d1", 5, "old"), ("b", "d1", 1, "b")), 0)
    assert rows(table.read(spark), "k", "v") == want


def test_first_wins_whichever_batch_brings_it(spark, run, rows):
    table = keyed(run, keep="first")
    table.upsert(batch_of(spark, ("a", "d1", 5, "late")), 0)
    table.upsert(batch_of(spark, ("a", "d1", 1, "early")), 1)
    table.upsert(batch_of(spark, ("a", "d1", 3, "mid")), 2)
    assert rows(table.read(spark), "k", "v") == [("a", "early")]


@pytest.mark.parametrize("keep", ["last", "first"])
def test_folding_keeps_what_readers_see(spark, run, rows, keep):
    rng = random.Random(4)
    table = keyed(run, keep)
    for i in range(4):
        table.upsert(batch_of(spark, *[(k, "d" + str(ord(k) % 2), rng.randrange(99), f"{k}{i}") for k in "abcdef"]), i)
    before = rows(table.read(spark))
    reading = table.read(spark)
    table.fold(spark, 2)
    table.fold(spark, 2)
    assert rows(table.read(spark)) == rows(reading) == before
    assert [folder.rsplit("/", 2)[1:] for folder in table.obsolete(spark)] == [["rows", "_version=0"], ["rows", "_version=1"]]
    table.upsert(batch_of(spark, ("a", "d1", -1, "x")), 4)
    expected = rows(table.read(spark))
    table.fold(spark, 4)
    assert rows(table.read(spark)) == expected
    table.upsert(batch_of(spark, ("a", "d1", -2, "z")), 5)
    table.fold(spark, 5)
    assert rows(table._standing(spark).select("_version").distinct()) == [(5,)]
    table.upsert(batch_of(spark, *[(k, "d" + str(ord(k) % 2), -3, "y") for k in "abcdef"]), 6)
    assert rows(table.read(spark), "v") == [("y",)] * 6


def test_reads_do_not_grow_with_the_batches(spark, run, rows):
    table = KeyedTable(f"{run}/t", "k STRING, v INT", ["k"], [], buckets=2)
    for i in range(12):
        table.upsert(spark.createDataFrame([(k, i) for k in "abcd"], "k STRING, v INT"), i)
        if i % 3 == 2:
            table.fold(spark, i)
        assert rows(table.read(spark)) == [(k, i) for k in "abcd"]
        assert table._standing(spark).count() <= 4 * 3


def test_a_batch_below_the_snapshot_is_refused_unless_it_is_its_last_one_again(spark, run, rows):
    table = KeyedTable(f"{run}/t", "id INT, v STRING", ["id"], [], buckets=2)

    def batch(*data):
        return spark.createDataFrame(list(data), "id INT, v STRING")

    for i in range(6):
        table.upsert(batch((i, f"v{i}")), i)
    table.fold(spark, 5)
    before = rows(table.read(spark))
    for number, data in ((0, (100, "lost")), (5, (100, "lost")), (0, (0, "v0"))):
        with pytest.raises(ValueError, match="would be lost"):
            table.upsert(batch(data), number)
    table.upsert(batch((5, "v5")), 5)
    assert rows(table.read(spark)) == before
    table.upsert(batch((100, "kept")), 6)
    assert rows(table.read(spark)) == sorted([*before, (100, "kept")], key=repr)


def test_unfinished_folders_do_not_count(spark, run, rows, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "id INT, v STRING", ["id"], [])
    for i in range(3):
        table.upsert(spark.createDataFrame([(i, "v")], "id INT, v STRING"), i)
    before = rows(table.read(spark))
    table.fold(spark, 1)
    (tmp_path / "t" / "snapshots" / "_version=1" / "_SUCCESS").unlink()
    (tmp_path / "t" / "rows" / "_version=2" / "_SUCCESS").unlink()
    assert table.obsolete(spark) == [] and rows(table.read(spark)) == before[:2]
    table.fold(spark, 1)
    assert rows(table.read(spark)) == before[:2] and len(table.obsolete(spark)) == 1


@pytest.mark.parametrize("keep", ["last", "first"])
def test_a_lookup_reads_the_buckets_of_its_keys(spark, run, rows, keep):
    table = KeyedTable(f"{run}/t", "k BIGINT, d STRING, v STRING", ["k"], ["v"], ["d"], keep, buckets=8, bucket_by=["k"])
    for i in range(3):
        table.upsert(spark.range(40).selectExpr("id AS k", "concat('d', id % 2) AS d", f"concat('v', id % {i + 1}) AS v"), i)
        if i == 1:
            table.fold(spark, i)
    asked = spark.createDataFrame([(3,), (17,)], "who INT")
    found = table.lookup(asked, ["who"])
    want = [row for row in rows(table.read(spark)) if row[0] in (3, 17)]
    assert [row for row in rows(found) if row[0] in (3, 17)] == want != []
    assert found.count() < 40
    assert "_bucket" in re.search(r"PartitionFilters: \[([^\]]*)\]", found._jdf.queryExecution().executedPlan().toString())[1]
    assert rows(table.read(spark, before=1)) != rows(table.read(spark)) or keep == "first"


def test_day_filter_prunes_a_keyed_table(spark, run):
    table = keyed(run)
    table.upsert(batch_of(spark, ("a", "d1", 1, "x"), ("b", "d2", 1, "y")), 0)
    plan = table.read(spark).where("d = 'd2'")._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "isnotnull(d#" in filters or "= d2" in filters, filters


def test_documents_without_id_get_one(spark, run):
    docs = spark.createDataFrame([("1", "a"), (None, "b"), (None, "c")], "doc_id STRING, v STRING")
    docs = docs.union(docs.where("v = 'b'"))
    first, again = (sorted(r["doc_id"] for r in with_doc_id(docs.repartition(n), 4).collect()) for n in (1, 3))
    assert first == again and len(set(first)) == 4 and "1" in first
    assert not set(first) & {r["doc_id"] for r in with_doc_id(docs, 5).where("v <> 'a'").collect()}
    table = KeyedTable(f"{run}/docs", "doc_id STRING, id INT, name STRING", ["doc_id"], [])
    for batch, name in enumerate(("lisi", "wang")):
        table.upsert(one_document(spark, {"id": 1, "name": name}, "1003", "id INT, name STRING"), batch)
    assert [r["name"] for r in table.read(spark).collect()] == ["wang"]


def test_bad_table_settings_are_refused(run):
    with pytest.raises(ValueError):
        KeyedTable(run, "k STRING", ["k"], [], keep="any")
