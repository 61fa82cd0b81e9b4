"""Column expressions against hand-written cases."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tillwatch.functions.json import bad_lines, image_json, parse, row_json, stamp
from tillwatch.functions.shares import bucket, remainder, share
from tillwatch.functions.text import mask_prefix, match_all, match_any, query_words
from tillwatch.functions.times import (
    age_years, epoch_day, epoch_hour, epoch_minute, next_day, previous_day, text_day, text_hour,
)
from tillwatch.records import EVENT_LOG, ORDER_RECORD, STARTUP_LOG, USER_RECORD


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_numbers_parse_quoted_or_not(spark):
    got = parse(lines(spark, '{"total_amount":"12.5"}', '{"total_amount":12.5}', '{"total_amount":"no"}'), ORDER_RECORD)
    assert [r["total_amount"] for r in got.collect()] == [12.5, 12.5, None]


def test_number_field_becomes_text_and_unknown_fields_are_dropped(spark):
    got = parse(lines(spark, '{"itemid":7,"mid":"m","ts":5,"extra":1}'), EVENT_LOG).first()
    assert (got["itemid"], got["mid"], got["ts"]) == ("7", "m", 5)
    assert "extra" not in got.asDict()


def test_malformed_lines_go_to_the_bad_output_whole(spark):
    feed = lines(spark, '{"mid":"a"}', '{"mid":', "plain text", None, "{}")
    assert parse(feed, STARTUP_LOG).count() == 2
    assert sorted(str(r["value"]) for r in bad_lines(feed, STARTUP_LOG).collect()) == ["None", "plain text", '{"mid":']


def test_startup_type_is_not_the_log_type(spark):
    assert parse(lines(spark, '{"type":"startup","mid":"a"}'), STARTUP_LOG).first()["logType"] is None


def test_null_user_line_gives_no_user(spark):
    assert parse(lines(spark, None), USER_RECORD).count() == 0


def test_stamp_replaces_a_sent_time_and_keeps_the_rest(spark):
    got = json.loads(value(spark, stamp(F.lit('{"ts":1,"mid":"m","n":3}'), F.lit(99).cast("bigint"))))
    assert got == {"mid": "m", "n": 3, "ts": 99}
    nested = '{"a":1.5,"b":{"c":[2,"x"]},"d":null}'
    assert json.loads(value(spark, stamp(F.lit(nested), F.lit(5).cast("bigint")))) == {"a": 1.5, "b": {"c": [2, "x"]}, "d": None, "ts": 5}
    assert value(spark, stamp(F.lit("no json"), F.lit(99).cast("bigint"))) is None


def test_stamp_takes_the_last_of_a_repeated_key(spark):
    got = json.loads(value(spark, stamp(F.lit('{"a":1,"a":2}'), F.lit(5).cast("bigint"))))
    assert got == {"a": 2, "ts": 5}


def test_row_and_image_json(spark):
    one = spark.createDataFrame([("a", 1)], "x STRING, y INT")
    assert one.select(row_json().alias("j")).first()["j"] == '{"x":"a","y":1}'
    image = F.array(F.struct(F.lit("id").alias("name"), F.lit("7").alias("value")), F.struct(F.lit("n").alias("name"), F.lit(None).cast("string").alias("value")))
    assert value(spark, image_json(image)) == '{"id":"7","n":null}'


def test_epoch_day_hour_minute(spark):
    ts = F.lit(1582287132000)
    assert value(spark, epoch_day(ts)) == "2020-02-21"
    assert value(spark, epoch_hour(ts)) == "12"
    assert value(spark, epoch_minute(ts)) == 1582287132000 // 60000


def test_day_and_hour_of_text(spark):
    full, short = F.lit("2020-02-21 12:12:12"), F.lit("2020-02-21")
    assert (value(spark, text_day(full)), value(spark, text_hour(full))) == ("2020-02-21", "12")
    assert (value(spark, text_day(short)), value(spark, text_hour(short))) == ("2020-02-21", None)


def test_neighbour_days(spark):
    assert value(spark, previous_day(F.lit("2020-03-01"))) == "2020-02-29"
    assert value(spark, next_day(F.lit("2019-12-31"))) == "2020-01-01"


def test_age_counts_365_day_years(spark):
    def age(day):
        return value(spark, age_years(F.lit("2000-03-01"), F.lit(day).cast("timestamp")))

    assert (age("2020-03-01"), age("2020-02-20"), age("2020-02-25"), age("2020-02-24")) == (20, 19, 20, 19)
    assert value(spark, age_years(F.lit("unknown"), F.lit("2020-01-01").cast("timestamp"))) is None


def test_masks(spark):
    phone = F.lit("13812345678")
    assert value(spark, mask_prefix(phone, 3, 8)) == "138********"
    assert value(spark, mask_prefix(phone, 4, 7)) == "1381*******"
    assert value(spark, mask_prefix(F.lit(None).cast("string"), 3, 8)) is None


def test_shares_are_cut_and_the_rest_is_rounded(spark):
    third = share(F.lit(1), F.lit(3))
    assert value(spark, third) == 33.3
    assert value(spark, remainder(third)) == 66.7
    assert value(spark, remainder(third, third)) == 33.4
    assert value(spark, share(F.lit(0), F.lit(0))) is None


def test_buckets(spark):
    assert [value(spark, bucket(F.lit(n), 100, 500)) for n in (0, 99, 100, 499, 500, 10_000)] == [0, 0, 100, 400, 500, 500]


def test_search_words(spark):
    names = spark.createDataFrame([("Red plate",), ("red ring",), ("redden plates",), ("re-d",), (None,)], "n STRING")

    def hits(condition):
        return sorted(r["n"] for r in names.where(condition).collect())

    assert hits(match_all(F.col("n"), "red plate")) == ["Red plate"]
    assert hits(match_all(F.col("n"), "PLATE, red")) == ["Red plate"]
    assert hits(match_any(F.col("n"), "red plate")) == ["Red plate", "red ring"]
    assert hits(match_all(F.col("n"), "")) == hits(match_any(F.col("n"), " ")) == hits(match_all(F.col("n"), None)) == []
    assert hits(match_all(F.col("n"), "d re")) == ["re-d"]


def test_words_of_other_scripts(spark):
    assert query_words("篮球 Été x_1 été") == ["篮", "球", "été", "x", "1"]
    text = spark.createDataFrame([("喜欢 篮球",), ("l'ÉTÉ",), ("étés",)], "n STRING")
    assert [r["n"] for r in text.where(match_any(F.col("n"), "篮球 été")).collect()] == ["喜欢 篮球", "l'ÉTÉ"]
