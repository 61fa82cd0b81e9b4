"""What the plans promise on large tables: hot keys are split, scans are pruned, nothing is broadcast unchecked."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tillwatch import catalog
from tillwatch.operators.joins import full_outer, with_users
from tillwatch.operators.keyed import unseen
from tillwatch.plans.sale_detail import sale_detail
from tillwatch.session import shared_dir, stream_session
from tillwatch.sources.keyed_table import KeyedTable

SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_partitions(spark):
    """Adaptive limits cut down so that a few thousand rows count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(n=20_000):
    """A third of the rows on key 0."""
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).cast("string")


def test_hot_order_is_split(spark, small_partitions):
    orders = spark.range(500).select(
        F.col("id").cast("string"), F.lit("new").alias("order_status"), F.lit("2024-01-01 00:00:00").alias("create_time"),
        (F.col("id") % 7).cast("string").alias("user_id"), F.lit("2024-01-01").alias("create_date"),
    )
    details = spark.range(0, 20_000, 1, 8).select(
        F.col("id").cast("string"), hot().alias("order_id"), F.lit("s").alias("sku_id"), F.lit("1").alias("order_price"), F.sha2(F.col("id").cast("string"), 256).alias("sku_name"),
    )
    users = spark.range(7).select(F.col("id").cast("string"), F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday"), F.lit("x").alias("user_level"))
    sales = sale_detail(orders, details, users)
    assert "skew=true" in executed(sales)
    assert sales.count() == 20_000


def test_hot_user_is_split_in_the_lookup(spark, small_partitions):
    sales = spark.range(0, 20_000, 1, 8).select(hot().alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    users = spark.range(400).select(F.col("id").cast("string"), F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday"), F.lit("x").alias("user_level"))
    got = with_users(sales, users)
    assert "skew=true" in executed(got)
    assert got.count() == 20_000


def test_hot_key_is_split_in_full_outer_and_anti_join(spark, small_partitions):
    left = spark.range(600).select(F.col("id").cast("string").alias("k"))
    right = spark.range(0, 20_000, 1, 8).select(hot().alias("rk"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    both = full_outer(left, right, "k", "rk")
    assert "skew=true" in executed(both)
    assert both.count() == right.count() + left.count() - right.select("rk").distinct().count()
    seen = spark.range(1, 600).select(F.col("id").cast("string").alias("rk"))
    fresh = unseen(right, seen, ["rk"])
    assert "skew=true" in executed(fresh)
    assert fresh.count() == right.where("rk = '0'").count()


def test_hot_user_is_split_in_the_lookup_of_a_keyed_table(spark, small_partitions):
    table = KeyedTable(shared_dir(spark, "users"), "id STRING, gender STRING, birthday STRING, user_level STRING", ["id"], [])
    users = spark.range(400).select(F.col("id").cast("string"), F.lit("F").alias("gender"), F.lit("2000-01-01").alias("birthday"), F.lit("x").alias("user_level"))
    table.upsert(users, 0)
    sales = spark.range(0, 20_000, 1, 8).select(hot().alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    got = with_users(sales, table.read(spark, joined=True))
    assert "skew=true" in executed(got)
    assert got.count() == 20_000


@pytest.mark.parametrize("name", ["dau_hourly", "new_devices", "gmv_daily", "alert_throttled", "terms_gender", "orders_by_province"])
def test_groups_are_summed_in_each_task_before_their_shuffle(spark, name):
    below = re.findall(r"Exchange hashpartitioning\([^\n]*\n([^\n]*)", plan(catalog.queries()[name](spark, SF)))
    assert any("partial_" in line or "functions=[]" in line for line in below)


@pytest.mark.parametrize("name", ["dau_rows", "user_latest", "gmv_by_order_date"])
def test_one_row_per_key_is_cut_in_each_task_before_the_shuffle(spark, name):
    below = re.findall(r"Exchange hashpartitioning\([^\n]*\n([^\n]*)", plan(catalog.queries()[name](spark, SF)))
    assert any("WindowGroupLimit" in line and "Partial" in line for line in below)


def test_scans_read_the_columns_and_rows_asked_for(spark):
    text = plan(catalog.queries()["gmv_daily"](spark, SF))
    assert "In(event_type" in text or "EqualTo(event_type,purchase)" in text
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>", text)
    text = plan(catalog.queries()["alert_windows_all"](spark, SF))
    assert "In(event_type, [click,purchase])" in text or "In(event_type, [purchase,click])" in text


def test_no_cross_joins_and_no_python_in_any_batch_plan(spark):
    for name, query in catalog.queries().items():
        text = plan(query(spark, SF))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert word not in text, (name, word)


def test_joins_shuffle_when_sides_are_large(spark, small_partitions):
    for name in ("sale_wide", "orders_by_province", "seen_anti", "sale_full_outer"):
        assert "Broadcast" not in plan(catalog.queries()[name](spark, SF)), name


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root + "/x-") and shared_dir(spark, "x") != shared_dir(spark, "x")


def test_streams_keep_the_partitions_that_were_set(spark):
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
