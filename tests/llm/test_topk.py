from __future__ import annotations

import math
import random

from tillwatch.llm import topk


def brute(vectors, asked, k):
    whole = [(own, [math.floor(1024 * x) for x in parts]) for own, parts in vectors
             if own is not None and parts is not None and all(x is not None and math.isfinite(x) for x in parts)]
    whole = [(own, parts) for own, parts in whole if all(-(1 << 63) <= x < 1 << 63 for x in parts)]
    rows = []
    for query_id, query in whole:
        if asked(query_id):
            sums = ((sum(a * b for a, b in zip(query, other)), own) for own, other in whole if own != query_id)
            scores = sorted((-min(max(score, -(1 << 63)), (1 << 63) - 1), own) for score, own in sums)
            rows += [(query_id, rank, own, -score) for rank, (score, own) in enumerate(scores[:k], 1)]
    return sorted(rows)


def test_like_brute_force(spark, rows):
    chance = random.Random(6)
    vectors = [(at, [float(chance.choice([-0.25, 0, 0.5, 1])) for _ in range(chance.choice([6, 6, 3]))]) for at in range(300)]
    vectors += [(at, [0.5] * 6) for at in range(300, 360)] + [(400, None), (401, [None]), (402, [float("inf")]), (405, []), (None, [1.0])]
    table = spark.createDataFrame([(*own, 1) for own in vectors], "vec_id long, embedding array<float>, rank int").repartition(5)
    found = topk.search(table, table.filter("vec_id % 5 = 0"), k=7, query_rows=16, block_rows=32)
    assert rows(found) == sorted(brute(vectors, lambda own: own % 5 == 0, 7), key=repr)


def test_large_components_like_brute_force(spark, rows):
    """Components about 2^17, 2^27, 2^40 and the ends of a long, whose sums need more than a long."""
    chance = random.Random(7)
    sizes = [1.0, 2.0**17 / 1024, 131071.9, 2.0**27, 2.0**40, 2.0**52, -(2.0**53), 2.0**53, 2.0**53 - 1]
    vectors = [(at, [chance.choice([-1, 1, 0.5, 0]) * chance.choice(sizes) for _ in range(chance.choice([3, 5]))]) for at in range(150)]
    vectors += [(500, [131071.9] * 1024), (501, [131071.9] * 1024), (502, [200000.0, 1.0]), (503, [150000.0, 0.0]), (504, [float("nan")])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    found = rows(topk.search(table, table.filter("vec_id % 5 = 0 or vec_id > 499"), k=9, query_rows=16, block_rows=32))
    assert found == sorted(brute(vectors, lambda own: own % 5 == 0 or own > 499, 9), key=repr)
    assert max(row[3] for row in found) == (1 << 63) - 1
    few = table.filter("vec_id > 499")
    assert (500, 1, 501, (1 << 63) - 1) in rows(topk.search(few, few)) and 1024 * 134217625**2 > 1 << 63
    assert (502, 2, 500, 204800000 * 134217625 + 1024 * 134217625) in rows(topk.search(few, few))


def test_unusual_rows(spark, rows):
    table = spark.createDataFrame(
        [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1e30]), (2, [1.0]), (None, [1.0])], "vec_id long, embedding array<float>")
    assert rows(topk.search(table, table)) == [(0, 1, 2, 1048576), (2, 1, 0, 1048576), (2, 2, 0, 1048576)]
    assert topk.search(table.limit(0), table.limit(0)).count() == 0
