from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import url_filter

LOWER = str.maketrans(url_filter._UPPER, url_filter._LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def longest_rule(host, path, rules):
    fitting = [
        rule for rule in rules
        if (host == rule[:rule.index("/")] or host.endswith("." + rule[:rule.index("/")])) and path.startswith(rule[rule.index("/"):])
    ]
    return max(fitting, key=len, default=None)


URLS = [
    None, "", "no scheme", "://", "HTTP://A.Org", "http://a.org/", "x://EXAMPLE.org/es/x?a=b#c", "x://notexample.org/en/1", "x://com/fr/",
    "x://com/fr", "y://b.example.org/en/12/3", "z://a.b.com/de/?q", "z://É.Com/fr/#/de/", "a://b://c.org/x", "h://h?x://org/", "h://u:p@x.org:80/en",
]


def test_hosts_paths_and_rules(spark):
    urls = spark.createDataFrame([(at, url, "x") for at, url in enumerate(URLS)] * 2, "page_id long, url string, host string")
    labelled = spark.createDataFrame([("x://a-b.com/", 1), ("x://ab.com/", 0)] * 20, "url string, label int")
    found = url_filter.judge(urls, labelled).collect()
    assert len(found) == 2 * len(URLS)
    for row in found:
        host, path = parts(URLS[row["page_id"]])
        rule = longest_rule(host, path, url_filter.RULES)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (url_filter.RULES[rule] if rule else "block" if row["score"] >= 0.5 else "allow")
    assert url_filter.judge(urls.limit(0), labelled.limit(0)).count() == 0
    assert {row["verdict"] for row in url_filter.judge(urls, labelled.filter("label = 0")).filter("rule is null").collect()} == {"allow"}


def test_features(spark):
    url = "https://www.a-1.example.com/en/57/x.html?page=2&ref=x#top"
    row = url_filter.described(spark.createDataFrame([(url,)], "url string")).first()
    share = [n / len(url) for n in Counter(url).values()]
    assert row["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in share))
    assert row["suffix"] == "example.com" and row["depth"] == 3 and row["n_params"] == 2 and row["param_length"] == 12
    assert row["digit_ratio"] == pytest.approx(4 / len(url)) and row["host_hyphens"] == 1 and row["longest_label"] == 7
    assert row["has_fragment"] == 1 and row["host_labels"] == 4


def test_trees_learn_and_score_like_the_library(spark):
    urls = spark.range(600).select(F.when(
        F.col("id") % 4 == 0, F.concat(F.lit("http://win-"), F.col("id"), F.lit("-now.net/")),
    ).otherwise(F.concat(F.lit("http://shop.net/item/"), F.col("id"))).alias("url"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    found = url_filter.judge(urls.select("url"), urls.filter("length(url) % 2 = 0"), rules={})
    wrong = found.join(urls, "url").filter((F.col("verdict") == "block") != (F.col("label") == 1)).count()
    assert wrong == 0
    sample = url_filter.sampled(urls)
    suffixes = url_filter.suffix_statistics(urls, sample)
    model = url_filter.train(sample, suffixes)
    rows = url_filter.described(urls).join(suffixes, "suffix").withColumn("own", url_filter.as_column(model))
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    both = model.transform(VectorAssembler(inputCols=list(url_filter.FEATURES), outputCol="features").transform(rows)).select(
        "own", vector_to_array("probability")[1].alias("library")).collect()
    assert all(row["own"] == pytest.approx(row["library"]) for row in both)


def test_the_sample_is_bounded(spark):
    urls = spark.range(500).select(F.col("id").cast("string").alias("url"), (F.col("id") % 2).cast("int").alias("label"))
    assert url_filter.sampled(urls, 40).count() == 80


def test_a_url_in_a_third_of_all_rows_takes_one_place_of_the_sample(spark):
    urls = spark.range(1_000).selectExpr("concat('http://u', id, '.example/') as url", "id % 2 as label")
    crowd = spark.range(500).selectExpr("'http://u1.example/' as url", "1L as label")
    sample = url_filter.sampled(urls.union(crowd), 200).collect()
    assert len(sample) == len({row["url"] for row in sample}) == 400
