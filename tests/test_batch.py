"""Operators and pipelines over hand-written tables."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tillwatch.operators.alerts import throttle, window_users
from tillwatch.functions import text as text_functions
from tillwatch.functions.text import match_all, match_any, tokens
from tillwatch.operators.hours import day_against_previous, hour_map
from tillwatch.operators.joins import full_outer, interval_join, with_users
from tillwatch.operators.keyed import earliest_per_key, latest_per_key, unseen
from tillwatch.operators.search import max_score, page, page_after, ranked, scored, word_counts
from tillwatch.operators import search
from tillwatch.operators.terms import top_terms
from tillwatch.plans import coupon_alert, reports
from tillwatch.plans.change_feed import routed
from tillwatch.plans.daily_active import active_hourly, active_total, bad_logs, daily_active, new_devices, read_logs
from tillwatch.plans.log_feed import stamped
from tillwatch.plans.order_amount import amount_hourly, amount_total, bad_orders, by_province, by_user_province, read_orders
from tillwatch.plans.sale_detail import order_coverage, sale_detail
from tillwatch.records import CHANGE_DDL, SALE_DETAIL_DDL, STARTUP_LOG
from tillwatch.sources.tables import hit_json, on_day, read_table, scan_all, union_all

T0 = 1_704_103_200_000  # 2024-01-01 10:00:00 UTC
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


@pytest.fixture
def logs(spark):
    data = [("m1", T0), ("m1", T0 + MINUTE), ("m1", T0 + HOUR), ("m1", T0 + 14 * HOUR + MINUTE), ("m2", T0 + 5)]
    lines = spark.createDataFrame([(json.dumps({"type": "startup", "mid": m, "ts": t}),) for m, t in data], "value STRING")
    return read_logs(lines, STARTUP_LOG)


def test_daily_active_keeps_the_earliest_log_of_each_day(logs, rows):
    active = daily_active(logs)
    assert rows(active, "logDate", "logHour", "mid", "ts") == [
        ("2024-01-01", "10", "m1", T0), ("2024-01-01", "10", "m2", T0 + 5), ("2024-01-02", "00", "m1", T0 + 14 * HOUR + MINUTE),
    ]
    assert rows(active_total(active)) == [("2024-01-01", 2), ("2024-01-02", 1)]
    assert rows(active_total(active, "2024-01-01")) == [(2,)]
    assert rows(active_total(active, "1999-01-01")) == [(0,)]
    assert rows(active_hourly(active, "2024-01-01")) == [("2024-01-01", "10", 2)]
    assert rows(new_devices(active)) == [("2024-01-01", 2)]


def test_first_and_last_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k STRING, o INT, v STRING")
    assert rows(earliest_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 3, None)]
    assert rows(latest_per_key(df, ["k"], ["o"])) == [("a", 2, "x"), ("b", 3, None)]


def test_unseen_drops_known_devices_of_that_day_only(spark, rows):
    new = spark.createDataFrame([("d1", "a"), ("d2", "a"), ("d1", "b")], "logDate STRING, mid STRING")
    seen = spark.createDataFrame([("d1", "a"), ("d1", "a")], "logDate STRING, mid STRING")
    assert rows(unseen(new, seen, ["logDate", "mid"])) == [("d1", "b"), ("d2", "a")]


def test_log_routing_by_text_and_by_type(spark, rows):
    lines = spark.createDataFrame(
        [('{"type":"startup"}',), ('{"type":"event","evid":"coupon"}',), ('{"type":"event","os":"startup os"}',), ("broken",)],
        "value STRING",
    )
    out = stamped(lines, F.lit(T0).cast("bigint"))
    assert sorted(str(r["topic"]) for r in out.collect()) == ["None", "event_log", "startup_log", "startup_log"]
    assert {r["dt"] for r in out.collect()} == {"2024-01-01"}
    assert "broken" in {r["value"] for r in out.collect()}


def change(table, entry, event, *images):
    return table, entry, event, [([(k, v) for k, v in image.items()],) for image in images]


def test_change_feed_passes_inserts_of_watched_tables(spark):
    feed = spark.createDataFrame([
        change("order_info", "ROWDATA", "INSERT", {"id": "1", "total_amount": "2.5"}),
        change("order_info", "ROWDATA", "UPDATE", {"id": "2"}),
        change("order_info", "ROWDATA", "DELETE", {"id": "3"}),
        change("sku_info", "ROWDATA", "INSERT", {"id": "4"}),
        change("order_info", "TRANSACTIONEND", "INSERT", {"id": "5"}),
    ], CHANGE_DDL)
    assert [tuple(r) for r in routed(feed).collect()] == [("order_info", '{"id":"1","total_amount":"2.5"}')]
    assert sorted(json.loads(r["value"])["id"] for r in routed(feed, include_updates=True).collect()) == ["1", "2"]


def test_change_entry_with_two_rows_gives_two_lines(spark):
    feed = spark.createDataFrame([change("user_info", "ROWDATA", "INSERT", {"id": "1"}, {"id": "2"})], CHANGE_DDL)
    assert [r["value"] for r in routed(feed).collect()] == ['{"id":"1"}', '{"id":"2"}']


def test_order_lines_get_day_hour_and_mask(spark):
    line = {"id": "1", "total_amount": "3.25", "create_time": "2020-02-21 12:12:12", "consignee_tel": "13812345678"}
    got = read_orders(spark.createDataFrame([(json.dumps(line),)], "value STRING")).first()
    assert (got["create_date"], got["create_hour"], got["consignee_tel"], got["total_amount"]) == ("2020-02-21", "12", "138********", 3.25)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [("1", "u1", "2024-01-01", "01", 0.1, "p1"), ("2", "u1", "2024-01-01", "23", 0.2, "p1"), ("3", "u9", "2024-01-02", "23", 5.0, "p2")],
        "id STRING, user_id STRING, create_date STRING, create_hour STRING, total_amount DOUBLE, province_id STRING",
    )


def test_amounts(orders, rows):
    assert rows(amount_total(orders)) == [("2024-01-01", 0.3), ("2024-01-02", 5.0)]
    assert rows(amount_total(orders, "1999-01-01")) == [(None,)]
    assert rows(amount_hourly(orders, "2024-01-01")) == [("2024-01-01", "01", 0.1), ("2024-01-01", "23", 0.2)]
    assert rows(by_province(orders)) == [("p1", 2, 0.3, 0), ("p2", 1, 5.0, 0)]


def test_amounts_by_the_users_province(spark, orders, rows):
    users = spark.createDataFrame([("u1", "north"), ("u9", "south"), ("u7", "north")], "id STRING, province STRING")
    assert rows(by_user_province(orders, users, "province")) == [("north", 2, 0.3, 0), ("south", 1, 5.0, 0)]


def test_hourly_curve_has_24_hours_and_the_day_before(spark):
    hourly = spark.createDataFrame(
        [("2024-01-02", "01", 4), ("2024-01-02", "23", 5), ("2024-01-01", "01", 7), ("2023-12-31", "02", 9)], "d STRING, h STRING, n BIGINT"
    )
    got = {r["hour"]: (r["today"], r["yesterday"]) for r in day_against_previous(hourly, "d", "h", "n", only="2024-01-02").collect()}
    assert len(got) == 24 and got["01"] == (4, 7) and got["23"] == (5, 0) and got["02"] == (0, 0)
    every = day_against_previous(hourly, "d", "h", "n")
    assert every.count() == 3 * 24
    assert every.where("day = '2024-01-01' and hour = '02'").first()["yesterday"] == 9


def test_hourly_curve_of_a_day_without_data_is_all_zeros(spark):
    hourly = spark.createDataFrame([("2024-01-01", "01", 7)], "d STRING, h STRING, n BIGINT")
    got = day_against_previous(hourly, "d", "h", "n", only="2030-01-01").collect()
    assert len(got) == 24 and all(r["today"] == r["yesterday"] == 0 for r in got)


def test_hour_map(spark):
    hourly = spark.createDataFrame([("d", "23", 5), ("d", "01", 4)], "d STRING, h STRING, n BIGINT")
    assert hour_map(hourly, "d", "h", "n").first()["hours"] == {"01": 4, "23": 5}


def test_kpis_of_a_day(logs, orders):
    got = {r["id"]: r["value"] for r in reports.kpis(daily_active(logs), orders, "2024-01-01").collect()}
    assert got == {"dau": 2.0, "new_mid": 2.0, "order_amount": 0.3}
    got = {r["id"]: r["value"] for r in reports.kpis(daily_active(logs), orders, "2024-01-02").collect()}
    assert got == {"dau": 1.0, "new_mid": 0.0, "order_amount": 5.0}


def test_hourly_curves_by_metric(logs, orders):
    active = daily_active(logs)
    dau = reports.hourly_curves("dau", active, orders, "2024-01-02").first()
    assert (dau["today"], dau["yesterday"]) == ({"00": 1}, {"10": 2})
    amount = reports.hourly_curves("order_amount", active, orders, "2024-01-01").first()
    assert (amount["today"], amount["yesterday"]) == ({"01": 0.1, "23": 0.2}, {})
    unknown = reports.hourly_curves("other", active, orders, "2024-01-01").first()
    assert (unknown["today"], unknown["yesterday"]) == (None, None)


def order_rows(spark, *ids):
    return spark.createDataFrame(
        [(i, "done", "2020-02-21 12:12:12", f"u{i}", "2020-02-21") for i in ids],
        "id STRING, order_status STRING, create_time STRING, user_id STRING, create_date STRING",
    )


def detail_rows(spark, *pairs):
    return spark.createDataFrame(
        [(d, o, "s" + d, "1.5", "red plate") for o, d in pairs],
        "id STRING, order_id STRING, sku_id STRING, order_price STRING, sku_name STRING",
    )


def user_rows(spark):
    return spark.createDataFrame([("u1", "F", "2000-03-01", "gold")], "id STRING, gender STRING, birthday STRING, user_level STRING")


def test_sale_detail_joins_dedups_and_looks_users_up(spark):
    details = detail_rows(spark, ("1", "d1"), ("1", "d1"), ("1", "d2"), ("2", "d3"), ("9", "d4"))
    got = sale_detail(order_rows(spark, "1", "2", "3"), details, user_rows(spark), F.lit("2020-03-01").cast("timestamp"))
    assert [r["doc_id"] for r in got.orderBy("doc_id").collect()] == ["1-d1", "1-d2", "2-d3"]
    known, unknown = got.where("doc_id = '1-d1'").first(), got.where("doc_id = '2-d3'").first()
    assert (known["user_gender"], known["user_age"], known["user_level"], known["sku_price"], known["dt"]) == ("F", 20, "gold", 1.5, "2020-02-21")
    assert (unknown["user_gender"], unknown["user_age"], unknown["user_level"]) == (None, 0, None)


def test_bad_price_is_null(spark):
    details = detail_rows(spark, ("1", "d1")).withColumn("order_price", F.lit("free"))
    assert sale_detail(order_rows(spark, "1"), details, user_rows(spark)).first()["sku_price"] is None


def test_full_outer_is_the_built_in_one(spark, rows):
    rng = random.Random(7)
    left = spark.createDataFrame([(k, f"l{k}") for k in range(12)] + [(None, "l?")], "k INT, l STRING")
    right = spark.createDataFrame([(rng.choice([None, *range(6, 20)]), f"r{i}") for i in range(60)], "rk INT, r STRING")
    built_in = left.join(right, F.col("k") == F.col("rk"), "full_outer")
    assert rows(full_outer(left, right, "k", "rk"), "k", "l", "rk", "r") == rows(built_in, "k", "l", "rk", "r")


def test_order_coverage(spark, rows):
    got = order_coverage(order_rows(spark, "1", "2"), detail_rows(spark, ("1", "d1"), ("1", "d2"), ("9", "d3")))
    assert rows(got) == [("1", "d1", "both"), ("1", "d2", "both"), ("2", None, "order only"), ("9", "d3", "detail only")]


def test_interval_join_reaches_both_ways_and_includes_its_ends(spark, rows):
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + s)
    left = spark.createDataFrame([("a", 0)], "k STRING, s INT").select("k", at(F.col("s")).alias("lt"))
    right = spark.createDataFrame([("a", s) for s in (-301, -300, 0, 240, 300, 301)] + [("b", 0)], "rk STRING, s INT")
    right = right.select("rk", "s", at(F.col("s")).alias("rt"))
    assert rows(interval_join(left, right, "k", "rk", "lt", "rt", 300), "s") == [(-300,), (0,), (240,), (300,)]


def test_users_are_left_looked_up(spark):
    got = with_users(spark.createDataFrame([("u1",), ("x",), (None,)], "user_id STRING"), user_rows(spark), F.lit("2020-03-01").cast("timestamp"))
    assert sorted(r["user_age"] for r in got.collect()) == [0, 0, 20]


def test_top_terms_break_ties_by_value_and_skip_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v STRING")
    assert [tuple(r) for r in top_terms(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


@pytest.fixture
def sales(spark):
    data = [
        ("1-a", "F", 19, "red plate", "2024-01-01"), ("1-b", "M", 20, "red plate big", "2024-01-01"),
        ("1-c", None, 35, "red plate red plate", "2024-01-01"), ("1-d", "F", 50, "red ring", "2024-01-01"),
        ("1-e", "F", 50, "red plate", "2024-01-02"),
    ]
    known = ("doc_id", "user_gender", "user_age", "sku_name", "dt")
    columns = [c.strip().split(" ")[0] for c in SALE_DETAIL_DDL.split(",")]
    df = spark.createDataFrame(data, "doc_id STRING, user_gender STRING, user_age INT, sku_name STRING, dt STRING")
    rest = {c: F.lit(None).cast("string") for c in columns if c not in known}
    return df.withColumns(rest)


def test_report_shares(sales):
    hits = reports.sale_hits(sales, "2024-01-01", "red plate")
    assert hits.count() == 3
    gender = reports.gender_shares(hits).first()
    assert (gender["total"], gender["female_ratio"], gender["male_ratio"]) == (3, 33.3, 66.7)
    strict = reports.gender_shares(hits, strict=True).first()
    assert (strict["total"], strict["female_ratio"], strict["male_ratio"]) == (2, 50.0, 50.0)
    age = reports.age_shares(hits).first()
    assert (age["under_20_ratio"], age["from_20_ratio"], age["from_30_ratio"]) == (33.3, 33.3, 33.4)


def test_report_document(sales):
    got = json.loads(reports.sale_report(sales, "2024-01-01", "red plate", 1, 2).first()["report"])
    assert got["total"] == 3 and len(got["detail"]) == 2
    assert got["detail"][0]["doc_id"] == "1-c"
    ages, genders = got["stat"]
    assert [o["value"] for o in ages["options"]] == [33.3, 33.3, 33.4]
    assert {o["name"]: o["value"] for o in genders["options"]} == {"女": 33.3, "男": 66.7}
    second = json.loads(reports.sale_report(sales, "2024-01-01", "red plate", 2, 2).first()["report"])
    assert second["total"] == 3 and len(second["detail"]) == 1


def test_report_without_rows_has_null_shares(sales):
    hits = reports.sale_hits(sales, "1999-01-01", "red")
    got = reports.gender_shares(hits).first()
    assert (got["total"], got["female_ratio"], got["male_ratio"]) == (0, None, None)
    assert json.loads(reports.sale_report(sales, "1999-01-01", "red").first()["report"])["total"] == 0
    assert json.loads(reports.sale_report(sales, "2024-01-01", "").first()["report"])["total"] == 0


def test_report_parameters_have_defaults(sales):
    dated = sales.withColumn("dt", F.lit("2019-03-04"))
    for blank in (None, ""):
        assert json.loads(reports.sale_report(dated, blank, "red plate").first()["report"])["total"] == 4
        assert json.loads(reports.sale_report(dated, "2019-03-04", blank).first()["report"])["total"] == 0


def test_page_two_of_five_rows(spark):
    got = page(spark.range(5).orderBy(F.desc("id")), ["id"], 2, 2).collect()
    assert [(r["id"], r["total"]) for r in got] == [(2, 5), (3, 5)]
    assert page(spark.range(5), ["id"], 9, 2).collect() == []


def bm25(texts, words):
    bags = [t.lower().split() for t in texts]
    mean = sum(map(len, bags)) / len(bags)
    out = {}
    for i, bag in enumerate(bags):
        score = 0.0
        for w in words:
            df = sum(w in b for b in bags)
            tf = bag.count(w)
            score += math.log(1 + (len(bags) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / mean))
        if any(w in bag for w in words):
            out[i] = round(score, 6)
    return out


def test_ranking_is_bm25(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["red", "Plate", "ring", "bolt", "redder"], k=rng.randint(1, 9))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    want = bm25(texts, ["red", "plate"])
    got = {r["id"]: r["score"] for r in scored(docs, "text", "Red plate").collect()}
    assert got == pytest.approx(want, abs=1e-6)
    best = sorted(want, key=lambda i: (-want[i], i))[:5]
    assert [r["id"] for r in ranked(docs, "text", "red plate", "id", 5).collect()] == best
    assert max_score(docs, "text", "red plate").first()["max_score"] == pytest.approx(max(want.values()), abs=1e-6)
    assert ranked(docs, "text", "", "id").count() == 0


def events(spark, *data):
    """(second, device, user, kind, item) as events of 2024-01-01 10:00."""
    df = spark.createDataFrame([(T0 + 1000 * s, m, u, k, i) for s, m, u, k, i in data], "ts BIGINT, mid STRING, uid STRING, evid STRING, itemid STRING")
    return df.withColumn("event_time", F.timestamp_millis("ts"))


def test_three_users_taking_coupons_alert_once_a_minute(spark):
    df = events(spark, (0, "m", "a", "coupon", "1"), (5, "m", "b", "coupon", "2"), (10, "m", "c", "coupon", "2"), (11, "m", "c", "addCart", "3"))
    (got,) = coupon_alert.documents(df).collect()
    assert got["doc_id"] == f"m_{T0 // MINUTE}"
    assert (got["uids"], got["itemIds"], got["events"]) == (["a", "b", "c"], ["1", "2"], ["coupon", "coupon", "coupon", "addCart"])
    assert got["ts"] == T0 + 29_999


def test_browsing_inside_the_window_stops_the_alert(spark):
    quiet = [(0, "m", "a", "coupon", "1"), (1, "m", "b", "coupon", "2"), (2, "m", "c", "coupon", "2")]
    assert coupon_alert.alerts(events(spark, *quiet, (2, "m", "d", "clickItem", "3"))).count() == 0
    assert coupon_alert.alerts(events(spark, *quiet, (2, "other", "d", "clickItem", "3"))).count() == 1
    # A click after the last coupon leaves the earlier windows alerting.
    (got,) = coupon_alert.alerts(events(spark, *quiet, (12, "m", "d", "clickItem", "3"))).collect()
    assert got["window_end"].timestamp() * 1000 == T0 + 10_000


def test_coupons_by_two_users_or_by_nobody_do_not_alert(spark):
    assert coupon_alert.alerts(events(spark, *[(s, "m", u, "coupon", "1") for s, u in enumerate("aab")])).count() == 0
    assert coupon_alert.alerts(events(spark, *[(s, "m", u, "coupon", "1") for s, u in enumerate(["a", "b", None])])).count() == 0


def brute_force_alerts(data, window=30, slide=5, period=60):
    """(device, period) -> (window start, users), from every window of every device."""
    best = {}
    for mid in {m for _, m, *_ in data}:
        for start in range(-window, 400, slide):
            inside = [e for e in data if e[1] == mid and start <= e[0] < start + window]
            users = {u for _, _, u, k, _ in inside if k == "coupon"}
            if len(users) >= 3 and not any(k == "clickItem" for *_, k, _ in inside):
                best[mid, (start + window - 1) // period] = (start, len(users))
    return best


def random_events(seed, n=160):
    rng = random.Random(seed)
    kinds = ["coupon"] * 8 + ["clickItem", "addCart"]
    return [(rng.randrange(300), rng.choice("mmmxy"), rng.choice("abcde"), rng.choice(kinds), str(rng.randrange(9))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_match_brute_force(spark, seed):
    data = random_events(seed)
    got = {
        (r["mid"], (r["period"].timestamp() * 1000 - T0) // MINUTE): (round((r["window_start"].timestamp() * 1000 - T0) / 1000), r["n_users"])
        for r in coupon_alert.alerts(events(spark, *data)).collect()
    }
    want = brute_force_alerts(data)
    assert want and got == want


def test_alerts_are_stored_alike_at_every_size(spark):
    data = [(30 + i % 29, "m", f"u{i % 50}", "coupon", f"i{i % 40}") for i in range(400)] + [(33, "m", "u0", "addCart", "x")] * 55
    headers, rows = coupon_alert.stored_alerts(events(spark, *data))
    at = f"doc_id = 'm_{T0 // MINUTE}'"
    header = headers.where(at).first()
    assert (header["n_users"], header["n_items"], header["n_events"]) == (50, 40, 455)
    assert rows.where(at).agg(F.sum("n")).first()[0] == 455


def test_events_of_an_alert_keep_their_order(spark):
    data = [(0, "m", "a", "coupon", "1"), (1, "m", "a", "addCart", "9"), (2, "m", "a", "coupon", "1"), (3, "m", "b", "coupon", "1"), (4, "m", "c", "coupon", "2")]
    (alert,) = coupon_alert.documents(events(spark, *data)).collect()
    assert alert["events"] == ["coupon", "addCart", "coupon", "coupon", "coupon"]
    assert alert["uids"] == ["a", "b", "c"] and alert["itemIds"] == ["1", "2"]


def test_throttle_keeps_the_last_window(spark):
    users = window_users(events(spark, *[(s, "m", u, "coupon", "1") for s, u in ((0, "a"), (1, "b"), (2, "c"), (20, "d"))]))
    from tillwatch.operators.alerts import alert_windows
    (got,) = throttle(alert_windows(users)).collect()
    assert got["window_end"].timestamp() * 1000 == T0 + 30_000 and got["n_users"] == 4


def test_scanning_all_tables(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, name STRING")
    b = spark.createDataFrame([(2, "male", "ball")], "id INT, sex STRING, favo STRING")
    got = {(r["index"], r["id"]): json.loads(r["source"]) for r in scan_all({"a": (a, F.col("id")), "b": (b, F.col("id"))}).collect()}
    assert got == {("a", "1"): {"id": 1, "name": "x"}, ("b", "2"): {"id": 2, "sex": "male", "favo": "ball"}}
    assert {(r["type"], r["score"]) for r in scan_all({"a": (a, F.col("id"))}).collect()} == {("_doc", 1.0)}
    side = union_all({"a": a, "b": b})
    assert set(side.columns) == {"id", "name", "sex", "favo", "index"} and side.count() == 2
    hit = json.loads(hit_json(a.select("name").withColumn("score", F.lit(1.5)), "a", F.lit(1)).first()["hit"])
    assert hit == {"name": "x", "index": "a", "type": "_doc", "id": "1", "score": 1.5}


def test_search_over_people(spark):
    people = spark.createDataFrame(
        [(1, "lisi", "male", "篮球 足球"), (2, "wang", "male", "足球"), (3, "zhao", "female", "篮球")], "id INT, name STRING, sex STRING, favo STRING"
    )
    hits = scored(people, "favo", "篮球").where("sex = 'male'")
    # Each Han character is a word, so a row with one of them is found too, and ranks behind.
    assert [r["id"] for r in hits.orderBy(F.desc("score")).collect()] == [1, 2]
    hits = hits.where(match_all(F.col("favo"), "篮球"))
    assert [tuple(r) for r in top_terms(hits, "sex", 2).collect()] == [("male", 1)]


def test_words_of_mixed_scripts(spark):
    goods = spark.createDataFrame([(1, "荣耀手机 X10"), (2, "小米手环"), (3, "手机壳phone case"), (4, "smartphone")], "id INT, name STRING")

    def found(match, keyword):
        return [r["id"] for r in goods.where(match(F.col("name"), keyword)).orderBy("id").collect()]

    assert found(match_all, "手机") == [1, 3] and found(match_any, "手机") == [1, 2, 3]
    assert found(match_all, "phone") == [3] and found(match_all, "壳 Phone") == [3] and found(match_any, "x10 环") == [1, 2]


def test_pages_after_a_row_and_counts_of_parts(spark):
    docs = spark.createDataFrame([(i, "red " * (i % 4) + "plate", f"d{i % 3}") for i in range(40)], "id INT, name STRING, dt STRING")
    everything = ranked(docs, "name", "red", "id", 40).select("id", "score").collect()
    seen, last = [], (None, None)
    while part := page_after(scored(docs, "name", "red"), "id", 7, *last).select("score", "id").collect():
        seen += [r["id"] for r in part]
        last = (part[-1]["score"], part[-1]["id"])
    assert seen == [r["id"] for r in everything]
    by_day = word_counts(docs, "name", "red", "dt")
    assert by_day.count() == 3
    one = docs.where("dt = 'd1'")
    assert {r["id"]: r["score"] for r in scored(one, "name", "red", counts=by_day).collect()} == {
        r["id"]: r["score"] for r in everything if r["id"] % 3 == 1}


def test_bad_rows_do_not_end_a_report(spark):
    lines = spark.createDataFrame([(v,) for v in (
        '{"mid":"a","ts":1704103200000}', '{"mid":"b","ts":"soon"}', '{"mid":"c"}', "{", None)], "value STRING")
    logs = read_logs(lines, STARTUP_LOG)
    assert [r["mid"] for r in logs.collect()] == ["a"] and bad_logs(lines, STARTUP_LOG).count() == 4
    assert hour_map(active_hourly(daily_active(logs)), "logDate", "logHour", "n").first()["hours"] == {"10": 1}
    orders = spark.createDataFrame([(v,) for v in (
        '{"id":"1","total_amount":"1e17","create_time":"2024-01-01 10:00:00"}', '{"id":"2","total_amount":5,"create_time":"2024-01-01"}',
        '{"id":"3","total_amount":"much","create_time":"2024-01-01 11:00:00"}', '{"id":"4","total_amount":2.5,"create_time":"2024-01-01 10:30:00"}')], "value STRING")
    assert amount_total(read_orders(orders), "2024-01-01").first()["amount"] == 1e17 + 2.5
    assert bad_orders(orders).count() == 2


def test_day_filter_reaches_the_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt STRING, n INT").write.partitionBy("dt").parquet(path)
    one = on_day(read_table(spark, path), "dt", "2024-01-02")
    assert [r["n"] for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_pages_are_turned_by_the_token_they_end_with(spark):
    hits = spark.createDataFrame([(f"d{i}", [3.0, 1.5, 1.5, 0.1 + 0.2][i % 4]) for i in range(23)], "id STRING, score DOUBLE")
    whole = [tuple(row) for row in hits.orderBy(F.desc("score"), "id").collect()]
    found, token = [], None
    while shown := search.next_page(hits, "id", 5, token).collect():
        assert len(shown) == 5 or len(found) == 20
        found += [tuple(row) for row in shown]
        token = search.cursor(shown[-1], "id")
    assert found == whole


def test_words_are_split_alike_with_and_without_signs_of_other_scripts(spark):
    texts = ["Red plate-2", "  ", "", "Größe ÉTÉ x_y", "红盘 red2盘x", "ひらがな abc", "a\u00a0b", "１２ x"]
    found = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").select("i", tokens(F.lower("t")).alias("w"), F.lower("t").alias("t"))
    for row in found.collect():
        assert row["w"] == query_tokens(row["t"])


def query_tokens(low):
    return text_functions._WORD.findall(low)
