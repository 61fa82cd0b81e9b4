"""Exact top-k search: exhaustive accumulation, term at a time.

Vectors become whole numbers (floor of `scale` times each component) and are packed into blocks where they are read. A block
is turned into postings, one list per component of who has how much of it; a query scatters its own weight times each of
its lists into a dense array of scores. The best of a block are picked by partition selection, merged per task, and merged
over all tasks by a window. Query blocks of bounded size meet all packed blocks, so each task holds one of each at a time,
and neither queries nor vectors pass through the driver.

A vector that is null or holds a null or a non-finite component takes no part, nor does one without an id, nor one with an
integer component that is no long. Where the sizes of a query and a block leave it open whether scores fit a long, they are
added up in integers of any size; a score beyond a long counts as the largest or smallest long, also in the ranking. An empty vector takes part and scores 0. Shorter vectors
count as zero in the components they lack. Ties go to the smaller id. Rows that repeat an id are separate candidates, none
of which the query of that id finds; as a query, the id asks once, with the least of its vectors. An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import stored

SCALE = 1024
BLOCK_ROWS = 8_192
QUERY_ROWS = 1_024
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_PACKED = "first long, ids binary, parts binary, width int"
_BEST = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and `parts`, the vector in whole numbers, of every vector that takes part."""
    scaled = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")))
    # Neither end of a long's range but the lower one is a double; NaN is beyond both.
    sound = F.forall("embedding", lambda x: F.coalesce(
        (scale * x.cast("double") >= float(_LEAST)) & (scale * x.cast("double") < -float(_LEAST)), F.lit(False)))
    return vectors.filter(F.col("vec_id").isNotNull() & sound).select(F.col("vec_id").cast("long"), scaled.alias("parts"))


def _matrix(parts: pa.ListArray) -> np.ndarray:
    """Ragged lists as rows padded with zeros, in 32 bits a component where all fit."""
    lengths = np.diff(parts.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    values = parts.flatten().to_numpy(zero_copy_only=False)
    bounds = np.iinfo(np.int32)
    small = not len(values) or bounds.min <= values.min() and values.max() <= bounds.max
    values = values.astype("<i4" if small else "<i8")
    if len(lengths) * width == len(values):
        return values.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width), values.dtype)
    matrix[np.arange(width) < lengths[:, None]] = values
    return matrix


def _packed(rows: int):
    """Blocks of at most `rows` vectors, by id, of what a task reads."""

    def block(ids: np.ndarray, parts: pa.ListArray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        matrix = _matrix(parts)[order]
        return pa.RecordBatch.from_pydict({
            "first": pa.array([int(ids[order[0]])], pa.int64()), "ids": [ids[order].astype("<i8").tobytes()],
            "parts": [matrix.tobytes()], "width": pa.array([matrix.shape[1]], pa.int32()),
        })

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                piece = batch.slice(at, rows)
                if n + piece.num_rows > rows:
                    yield packed(waiting)
                    waiting, n = [], 0
                waiting.append(piece)
                n += piece.num_rows
        if n:
            yield packed(waiting)

    def packed(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(pieces).combine_chunks()
        return block(whole.column("vec_id").to_numpy(), whole.column("parts").combine_chunks())

    return pack


def _unpacked(ids: bytes, parts: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    kind = "<i8" if len(parts) == 8 * len(ids) * width else "<i4"
    return ids, np.frombuffer(parts, kind).reshape(len(ids), width).astype(np.int64)


def size_of(numbers: np.ndarray) -> np.ndarray:
    """Sizes as doubles, in which the least long has one, too."""
    return np.abs(numbers.astype(np.float64))


def postings(matrix: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per component: who has some of it, and how much."""
    lists = []
    for column in matrix.T:
        who = np.flatnonzero(column)
        lists.append((who, column[who]))
    return lists


def best_of_block(
    query_id: int, query: np.ndarray, ids: np.ndarray, lists: list, largest: float, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's best k for one query, ties to smaller ids; `ids` ascend, no component is above `largest`."""
    terms = np.flatnonzero(query[:len(lists)])
    if size_of(query).sum() * largest < 1 << 62:
        scores = np.zeros(len(ids), np.int64)
        for term in terms:
            who, amount = lists[term]
            scores[who] += query[term] * amount
    else:
        wide = np.zeros(len(ids), object)
        for term in terms:
            who, amount = lists[term]
            wide[who] += int(query[term]) * amount.astype(object)
        scores = np.clip(wide, _LEAST, _MOST).astype(np.int64)
    others = ids != query_id
    if not others.all():
        ids, scores = ids[others], scores[others]
    return _largest(ids, scores, k)


def _largest(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) <= k:
        return ids, scores
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    chosen = np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])
    return ids[chosen], scores[chosen]


def _searched(k: int):
    """Rows of (query block, block), by query block: the best k per query over all blocks a task is given."""

    def emit(best: dict) -> pa.RecordBatch:
        sizes = [len(ids) for ids, _ in best.values()]
        empty = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_pydict({
            "query_id": pa.array(np.repeat(np.array(list(best), np.int64), sizes)),
            "vec_id": pa.array(np.concatenate([own[0] for own in best.values()] or empty)),
            "score": pa.array(np.concatenate([own[1] for own in best.values()] or empty)),
        })

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, best, queries = None, {}, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["lane"] != lane:
                    if best:
                        yield emit(best)
                    lane, best = row["lane"], {}
                    queries = [(own["vec_id"], np.array(own["parts"], np.int64)) for own in row["asked"]]
                ids, matrix = _unpacked(row["ids"], row["parts"], row["width"])
                lists, largest = postings(matrix), float(size_of(matrix).max(initial=0))
                for query_id, query in queries:
                    found = best_of_block(query_id, query, ids, lists, largest, k)
                    if query_id in best:
                        both = [np.concatenate(own) for own in zip(best[query_id], found)]
                        order = np.argsort(both[0], kind="stable")
                        found = _largest(both[0][order], both[1][order], k)
                    best[query_id] = found
        if best:
            yield emit(best)

    return search


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, query_rows: int = QUERY_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every query, by integer inner product."""
    spark = vectors.sparkSession
    asked = stored(whole_vectors(queries, scale).groupBy("vec_id").agg(F.min("parts").alias("parts")), "topk-queries")
    lanes = max(1, math.ceil(asked.count() / query_rows))
    # Query blocks, or lanes, are about `query_rows` hashed queries each; every lane goes to `spread` tasks, each of which
    # gets a share of the vectors' blocks.
    spread = max(1, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / lanes))
    asked_blocks = (
        asked.withColumn("lane", F.pmod(F.xxhash64("vec_id"), F.lit(lanes)))
        .groupBy("lane").agg(F.collect_list(F.struct("vec_id", "parts")).alias("asked"))
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    # Every block of packed vectors meets every lane once: n / block_rows rows for each lane.
    blocks = (
        whole_vectors(vectors, scale).mapInArrow(_packed(block_rows), _PACKED)
        .withColumn("share", F.pmod(F.xxhash64("first", F.length("ids")), F.lit(spread)).cast("int"))
        .withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    )
    best = blocks.join(asked_blocks, ["lane", "share"]).sortWithinPartitions("lane").mapInArrow(_searched(k), _BEST)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
