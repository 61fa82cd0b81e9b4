"""The order, event and part tables of the test data as the records of the data model. Projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwatch.sources.topics import read_files

EVENTS_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDERS_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING"
)
LINEITEM_DDL = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ"
)
#: Files that a slice of a table is written as, and that a micro-batch reads: so many at least, and rows of one where they are more.
SLICE_FILES, FILE_ROWS = 2, 250_000
# The event kinds that stand for taking a coupon and for browsing.
KINDS = ("purchase", "click")
CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, ddl: str) -> DataFrame:
    # A stream reads folders or patterns, not a single file name; the one-letter class makes a pattern of it.
    return spark.readStream.schema(ddl).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def sliced_stream(spark: SparkSession, sf_dir: str, name: str, ddl: str, time: str | Column, where: str, slices: int = 4) -> DataFrame:
    """A table as a stream of several micro-batches: all its rows, cut by time into folders written one after another.

    Large slices are written as more files, the same number for each, as that is what a micro-batch takes; only where one
    of them has too few rows to fill its files, all are left with the least number.
    """
    rows = table(spark, sf_dir, name)
    at = F.unix_seconds((F.col(time) if isinstance(time, str) else time).cast("timestamp"))
    ends = rows.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    span = max(1, (ends["last"] or 0) - (ends["first"] or 0) + 1)
    slice_of = F.coalesce(F.call_function("div", (at - F.lit(ends["first"] or 0)) * slices, F.lit(span)), F.lit(0))
    sizes = [own["count"] for own in rows.groupBy(slice_of.alias("slice")).count().collect()]
    files = max(SLICE_FILES, -(-max(sizes, default=0) // FILE_ROWS))
    if len(sizes) < slices or min(sizes) < 1000 * files:
        files = SLICE_FILES
    for number in range(slices):
        rows.where(slice_of == number).repartition(files if sizes else 1).write.mode("append").parquet(where)
    return read_files(spark, where, ddl, most=files)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def logs(events: DataFrame) -> DataFrame:
    """Events as logs of the device `user_id`."""
    kind = F.col("event_type")
    return (
        events.withColumn("event_time", F.col("ts").cast("timestamp"))
        .select(
            "event_id", "event_time",
            _text("user_id").alias("mid"),
            F.get_json_object("props", "$.k").alias("uid"),
            F.when(kind == "signup", "startup").otherwise("event").alias("type"),
            kind.alias("evid"),
            _text("event_id").alias("itemid"),
            F.date_format("event_time", "yyyy-MM-dd").alias("logDate"),
            F.date_format("event_time", "HH").alias("logHour"),
            F.unix_millis("event_time").alias("ts"),
            _money("value").alias("value"),
        )
    )


def log_lines(events: DataFrame) -> DataFrame:
    """The lines devices post: JSON without a time, with its arrival beside it."""
    log = logs(events)
    at = F.struct((F.col("event_id") % 50).cast("int").alias("pgid"), F.struct(F.col("uid").alias("id")).alias("who"))
    body = F.struct("type", "mid", "uid", "evid", F.col("event_id").alias("itemid"), at.alias("at"))
    return log.select("event_id", "event_time", F.col("ts").alias("arrived_ms"), F.to_json(body).alias("value"))


def orders(rows: DataFrame) -> DataFrame:
    """Order headers; `arrived` is the order date."""
    day = F.col("o_orderdate").cast("timestamp")
    return rows.select(
        _text("o_orderkey").alias("id"),
        _text("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        _money("o_totalprice").alias("total_amount"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.date_format(day, "yyyy-MM-dd").alias("create_date"),
        F.date_format(day, "HH").alias("create_hour"),
        day.alias("arrived"),
    )


def details(rows: DataFrame) -> DataFrame:
    """Order details without the article name; `arrived` is the ship date."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.select(
        key.alias("id"),
        _text("l_orderkey").alias("order_id"),
        _text("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").cast("string").alias("sku_num"),
        F.col("l_shipdate").cast("timestamp").alias("arrived"),
    )


def named(detail_rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Details with their article name."""
    names = parts.select(_text("p_partkey").alias("_part"), F.col("p_name").alias("sku_name"))
    return detail_rows.join(names, F.col("sku_id") == F.col("_part"), "left").drop("_part")


def users(rows: DataFrame) -> DataFrame:
    """Customers as users; gender and birthday follow from the key, as the table has neither."""
    key = F.col("c_custkey")
    years = (F.pmod(key, F.lit(40)) + 10).cast("int")
    return rows.select(
        _text("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(F.date_sub(F.to_date(F.lit("2001-08-01")), years * 365), "yyyy-MM-dd").alias("birthday"),
        F.when(F.pmod(key, F.lit(2)) == 0, "F").otherwise("M").alias("gender"),
    )


def _entry(table_name: str, entry_type: str, event_type: Column, **columns: Column) -> list[Column]:
    image = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in columns.items()])
    return [
        F.lit(table_name).alias("table"), F.lit(entry_type).alias("entry_type"), event_type.alias("event_type"),
        F.array(F.struct(image.alias("after"))).alias("row_datas"),
    ]


def order_changes(rows: DataFrame) -> DataFrame:
    """Orders as change entries: open ones inserted, finished ones updated, pending ones deleted."""
    status = F.col("order_status")
    kind = F.when(status == "O", "INSERT").when(status == "F", "UPDATE").otherwise("DELETE")
    return orders(rows).select(*_entry(
        "order_info", "ROWDATA", kind, id=F.col("id"), user_id=F.col("user_id"), order_status=F.col("order_status"),
        total_amount=F.col("total_amount"), create_time=F.col("create_time"),
    ))


def detail_changes(rows: DataFrame) -> DataFrame:
    """Details as change entries: returned ones deleted, accepted ones updated, the rest inserted."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "R", "DELETE").when(flag == "A", "UPDATE").otherwise("INSERT")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.select(*_entry(
        "order_detail", "ROWDATA", kind, id=key, order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
        order_price=_money("l_extendedprice"), sku_num=F.col("l_quantity").cast("bigint"),
    ))


def user_changes(rows: DataFrame) -> DataFrame:
    return users(rows).select(*_entry(
        "user_info", "ROWDATA", F.lit("INSERT"), id=F.col("id"), login_name=F.col("login_name"),
        user_level=F.col("user_level"), birthday=F.col("birthday"), gender=F.col("gender"),
    ))


def other_changes(nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Entries a router must leave out: another table's rows, and entries that carry no row data."""
    rows = nations.select(*_entry("base_province", "ROWDATA", F.lit("INSERT"), id=F.col("n_nationkey"), name=F.col("n_name")))
    marks = regions.select(*_entry("order_info", "TRANSACTIONEND", F.lit("INSERT"), id=F.col("r_regionkey")))
    return rows.unionByName(marks)
