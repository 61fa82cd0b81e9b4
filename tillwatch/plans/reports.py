"""Reports on the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwatch.functions.shares import remainder, share
from tillwatch.functions.text import match_all, query_words
from tillwatch.operators.hours import hour_map
from tillwatch.operators.search import kept_word_counts, scored, word_counts
from tillwatch.plans.daily_active import active_hourly, active_total, new_devices
from tillwatch.plans.order_amount import amount_hourly, amount_total
from tillwatch.records import (
    AGE_LABELS, AGE_TITLE, DEFAULT_REPORT_DATE, FEMALE_LABEL, GENDER_TITLE, KPI_NAMES, MALE_LABEL,
)
from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.sources.tables import on_day


def _kpi(row: DataFrame, key: str, value: str) -> DataFrame:
    return row.select(
        *[c for c in row.columns if c != value],
        F.lit(key).alias("id"), F.lit(KPI_NAMES[key]).alias("name"), F.col(value).cast("double").alias("value"),
    )


def kpis(active: DataFrame, orders: DataFrame, day: str, first_seen: DataFrame | None = None) -> DataFrame:
    """The three figures of a day, one row each.

    With `first_seen`, the table of first days that the stream keeps, each figure reads the day's folder and no other;
    without it, new devices are found over all of `active`.
    """
    new = new_devices(active, day) if first_seen is None else active_total(first_seen.where("n = 1"), day)
    return reduce(DataFrame.unionByName, [
        _kpi(active_total(active, day), "dau", "total"),
        _kpi(new, "new_mid", "total"),
        _kpi(amount_total(orders, day), "order_amount", "amount"),
    ])


def kpis_by_day(active: DataFrame, orders: DataFrame) -> DataFrame:
    """The same for every day there is."""
    def of(rows: DataFrame, day: str, key: str, value: str) -> DataFrame:
        return _kpi(rows.withColumnRenamed(day, "dt"), key, value)

    return reduce(DataFrame.unionByName, [
        of(active_total(active), "logDate", "dau", "total"),
        of(new_devices(active), "logDate", "new_mid", "total"),
        of(amount_total(orders), "create_date", "order_amount", "amount"),
    ])


def hourly_curves(metric: str, active: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """One row with the maps hour -> value of a day and the day before; both null for an unknown metric.

    Both days are read in one scan of the two days' partitions.
    """
    both = {"dau": ("logDate", "logHour", "n"), "order_amount": ("create_date", "create_hour", "amount")}.get(metric)
    spark = active.sparkSession
    if both is None:
        return spark.range(1).select(
            F.lit(None).cast("map<string,double>").alias("today"), F.lit(None).cast("map<string,double>").alias("yesterday")
        )
    date, hour, value = both
    before = F.date_format(F.date_sub(F.to_date(F.lit(day)), 1), "yyyy-MM-dd")
    source, count = (active, active_hourly) if metric == "dau" else (orders, amount_hourly)
    maps = hour_map(count(source.where(F.col(date).isin(F.lit(day), before))), date, hour, value)

    def of(which: Column, name: str) -> Column:
        none = F.create_map().cast(maps.schema["hours"].dataType)
        return F.coalesce(F.max_by("hours", F.when(F.col(date) == which, F.lit(1))), none).alias(name)

    return maps.agg(of(F.lit(day), "today"), of(before, "yesterday"))


def gender_shares(sales: DataFrame, by: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Women's share cut to 0.1, men's as the rest; rows without a gender fall to the rest unless `strict`."""
    rows = sales.where(F.col("user_gender").isNotNull()) if strict else sales
    counts = rows.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(F.col("user_gender") == "F").alias("_f")
    )
    return counts.withColumn("female_ratio", share(F.col("_f"), F.col("total"))).withColumn(
        "male_ratio", remainder(F.col("female_ratio"))
    ).drop("_f")


def age_shares(sales: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Shares of ages below 20 and from 20 to 29, cut to 0.1, and the rest."""
    age = F.col("user_age")
    counts = sales.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(age < 20).alias("_a"), F.count_if((age >= 20) & (age < 30)).alias("_b")
    )
    return counts.withColumns({
        "under_20_ratio": share(F.col("_a"), F.col("total")), "from_20_ratio": share(F.col("_b"), F.col("total")),
    }).withColumn("from_30_ratio", remainder(F.col("under_20_ratio"), F.col("from_20_ratio"))).drop("_a", "_b")


def sale_hits(sales: DataFrame, day: str, keyword: str) -> DataFrame:
    """Sale rows of a day whose article name has every word of the keyword."""
    return on_day(sales, "dt", day).where(match_all(F.col("sku_name"), keyword))


def sale_summary(hits: DataFrame) -> DataFrame:
    """Total and both share blocks from one aggregate over the hits, in the report's layout."""
    age, n = F.col("user_age"), F.col("total")
    counts = hits.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("user_gender") == "F").alias("f"),
        F.count_if(age < 20).alias("a"),
        F.count_if((age >= 20) & (age < 30)).alias("b"),
    ).select("total", share(F.col("f"), n).alias("f"), share(F.col("a"), n).alias("a"), share(F.col("b"), n).alias("b"))

    def block(title: str, **options: Column) -> Column:
        named = [F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in options.items()]
        return F.struct(F.array(*named).alias("options"), F.lit(title).alias("title"))

    f, a, b = F.col("f"), F.col("a"), F.col("b")
    ages = dict(zip(AGE_LABELS, (a, b, remainder(a, b))))
    genders = {MALE_LABEL: remainder(f), FEMALE_LABEL: f}
    return counts.select("total", F.array(block(AGE_TITLE, **ages), block(GENDER_TITLE, **genders)).alias("stat"))


def name_counts(sales: DataFrame, keyword: str) -> DataFrame:
    """Word counts of the article names, one row per day; what a day adds never changes once it is over."""
    return word_counts(sales, "sku_name", keyword, "dt")


def kept_name_counts(names: KeyedTable, spark: SparkSession, keyword: str) -> DataFrame:
    """`name_counts` from the table that the sale stream keeps; only the buckets of the keyword's words are read."""
    asked = spark.range(1).select(F.explode(F.array(F.lit(""), *map(F.lit, query_words(keyword)))).alias("word"))
    return kept_word_counts(names.lookup(asked, ["word"], joined=False), keyword, "dt")


def sale_page(sales: DataFrame, day: str, keyword: str, number: int, size: int, counts: DataFrame | None = None) -> DataFrame:
    """Page `number` (from 1) of the hits, best score first, ties by id.

    Scores use the word counts of all sales, as the day only filters. `counts` are those kept per day (`kept_name_counts`);
    without them the names of all days are counted here.
    """
    counts = name_counts(sales, keyword) if counts is None else counts
    kept = scored(on_day(sales, "dt", day), "sku_name", keyword, counts=counts).where(match_all(F.col("sku_name"), keyword))
    return kept.orderBy(F.desc("score"), F.asc("doc_id")).offset((number - 1) * size).limit(size)


def sale_report(
    sales: DataFrame, day: str | None, keyword: str | None, number: int = 1, size: int = 20, counts: DataFrame | None = None,
) -> DataFrame:
    """The whole report as one JSON document: total, shares and one page of rows. Blank parameters take their default."""
    day, keyword = day or DEFAULT_REPORT_DATE, keyword or ""
    page = sale_page(sales, day, keyword, number, size, counts)
    shown = page.agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("_rank"), *page.columns))).alias("d"))
    detail = F.transform(F.col("_page"), lambda r: r.dropFields("_rank", "score"))
    summary = sale_summary(sale_hits(sales, day, keyword)).withColumn("_page", shown.scalar())
    return summary.select(F.to_json(F.struct("total", "stat", detail.alias("detail"))).alias("report"))
