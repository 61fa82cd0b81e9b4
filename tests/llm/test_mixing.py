from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillwatch.llm import mixing


def water_filled(sizes, weights=(3, 1, 2)):
    """Targets by resharing the excess until no source is above twice its size."""
    order = sorted(sizes, key=lambda own: (own is None, own or ""))
    weight = {own: weights[at % len(weights)] for at, own in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), list(order)
    while free:
        share = left / sum(weight[own] for own in free)
        capped = [own for own in free if share * weight[own] > 2 * sizes[own]]
        if not capped:
            return target | {own: share * weight[own] for own in free}
        for own in capped:
            target[own] = 2 * sizes[own]
            left -= target[own]
            free.remove(own)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_what_is_taken(spark, seed):
    chance = random.Random(seed)
    sources = [None, "b", "a", "é", "Z", "zz"][:chance.randrange(2, 7)]
    rows = [(at, " ".join("w" * chance.randrange(0, 60)), chance.choices(sources, range(1, 1 + len(sources)))[0]) for at in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = water_filled(sizes)
    plan = mixing.planned(docs).select("row.source", "size", "source_size", "target", "times").collect()
    taken = dict.fromkeys(sizes, 0)
    for row in plan:
        assert row["source_size"] == sizes[row["source"]] and abs(row["target"] - want[row["source"]]) < 1e-6 * (1 + row["target"])
        assert len(row["times"]) <= 2 and all(0 <= t <= 1 for t in row["times"])
        taken[row["source"]] += row["size"] * len(row["times"])
    for source, words in taken.items():
        assert abs(words - want[source]) <= 60
    assert mixing.mix(docs).count() == sum(len(row["times"]) for row in plan)
    again = mixing.report(docs.repartition(7))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixing.report(docs).collect()))


def test_times_invert_the_schedule(spark):
    shape = ((0.0, 0.2), (0.3, 2.0), (0.7, 0.0), (1.0, 1.0))
    whole = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(shape, shape[1:]))

    def integral(t):
        total = 0.0
        for (t0, w0), (t1, w1) in zip(shape, shape[1:]):
            until = min(max(t, t0), t1)
            total += (until - t0) * (w0 + w0 + (w1 - w0) / (t1 - t0) * (until - t0)) / 2
        return total / whole

    shares = spark.range(1001).select((F.col("id") / 1000).alias("share"))
    for row in shares.select("share", mixing.time_of(F.col("share"), mixing._integrals(shape)).alias("t")).collect():
        assert abs(integral(row["t"]) - row["share"]) < 1e-9


def test_training_order_follows_the_curriculum(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.chr(F.lit(97) + F.col("id") % 3).alias("source"))
    times = mixing.planned(docs).select("row.source", F.explode("times").alias("t"))
    mean = {row["source"]: row["m"] for row in times.groupBy("source").agg(F.avg("t").alias("m")).collect()}
    assert mean["c"] < mean["a"] < mean["b"]
    order = [row["source"] for row in mixing.mix(docs).collect()]
    early, late = order[:len(order) // 4], order[-len(order) // 4:]
    assert early.count("b") < late.count("b") and early.count("c") > late.count("c")


def test_unusual_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, 9, "x"), (None, "", None, 9, "y"), (None, "", None, 9, "y"), (5, "a b c", "q", 9, "z"), (5, "a b c", "q", 9, "z")],
        "doc_id long, text string, source string, size int, row string")
    assert mixing.mix(docs).columns == docs.columns
    found = sorted((row["doc_id"] or 0, row["size"], row["taken"]) for row in mixing.report(docs).collect())
    assert found == [(0, 0, 0), (0, 0, 0), (1, 0, 0), (5, 3, 3), (5, 3, 6)]
    assert mixing.report(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
