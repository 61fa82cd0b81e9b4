"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time from 0 to 1, linear between knots. The schedule's integral is the
source's weight in the mix, which sets its target of words; the inverse of the running integral says at which time a
given word of the source is asked for. Documents stand in a fixed shuffled order within their source, each copy gets the
time of its middle word, and a range sort over all copies gives the training order.

Running totals are taken in two steps: per (source, slice of the shuffled order) first, then inside each slice. So no task
holds a source, however large its share is. A copy is in the mix if its middle lies before the target, which leaves each
source within half a document of it; a target is at most `most` times the source, so no document is taken more often.

Null text has size 0; null sources form one source, last in order. Equal rows are separate documents of the same place in
order, next to each other. An empty table gives an empty mix. Input columns are kept whatever they are called: all work is
done beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.llm.common import stored, words

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
#: (time, weight) knots of the schedule shapes that sources take in turn; each integrates to 1.
SHAPES = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 1.5), (1.0, 0.5)),
)
#: Hexadecimal digits of the shuffled order that name a slice of a source.
SLICE_DIGITS = 3


def _cycled(values: Sequence, rank: Column) -> Column:
    return F.get(F.array(*values), (rank % len(values)).cast("int"))


def _integrals(shape: Sequence[tuple[float, float]]) -> Column:
    """Per knot: time, weight, integral of the schedule up to it (scaled to 1 at the end), and the next knot's."""
    total, running = 0.0, [0.0]
    for (t0, w0), (t1, w1) in zip(shape, shape[1:]):
        total += (t1 - t0) * (w0 + w1) / 2
        running.append(total)
    return F.array(*[
        F.struct(
            F.lit(t0).alias("t"), F.lit(w0 / total).alias("w"), F.lit((w1 - w0) / (t1 - t0) / total).alias("slope"),
            F.lit(below / total).alias("below"), F.lit(above / total).alias("above"),
        )
        for (t0, w0), (t1, w1), below, above in zip(shape, shape[1:], running, running[1:])
    ])


def time_of(share: Column, pieces: Column) -> Column:
    """The time by which `share` of a source's words have been asked for: the integral of its schedule, inverted."""
    piece = F.get(F.filter(pieces, lambda own: share <= own["above"]), F.lit(0))
    rest = share - piece["below"]
    root = F.sqrt(piece["w"] * piece["w"] + 2 * piece["slope"] * rest)
    # With weight w and slope s, w*t + s*t*t/2 = rest; this form of the root also holds for s = 0.
    return piece["t"] + F.when(rest <= 0, 0.0).otherwise(2 * rest / (piece["w"] + root))


def sized(docs: DataFrame, carried: Sequence[str] | None = None) -> DataFrame:
    """`row` (the document as it is, or the columns `carried` of it), its source as a key without nulls, its size in words
    and its shuffled place, which follows from id and text, so that rows without an id are spread like others."""
    text = F.md5(F.coalesce("text", F.lit("")))
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in (docs.columns if carried is None else carried)]).alias("row"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/"), text)).alias("place"),
    ).withColumn("slice", F.substring("place", 1, SLICE_DIGITS))


def targets(
    slices: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
    shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES,
) -> DataFrame:
    """Per source: its size, target and schedule. One row per source, and windows over these rows only.

    Sources fill up to their caps in the order of cap by weight, so those at their cap are a prefix of that order: the
    first source whose share of what is left stays within its cap ends it. All sums are exact whole numbers.
    """
    whole = Window.partitionBy()
    by_source = Window.orderBy(F.col("source_key") == "", "source_key")
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "source_rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    exact = lambda name: F.col(name).cast("decimal(38,0)")
    cap = 100 * most
    filled = (
        slices.groupBy("source_key").agg(F.sum("size").alias("source_size"))
        .withColumn("source_rank", F.row_number().over(by_source) - 1)
        .withColumn("weight", _cycled([F.lit(own).cast("long") for own in weights], F.col("source_rank")))
        .withColumn("order", F.row_number().over(filling))
        .withColumn("left", (
            percent * F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
        ))
        .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("within", exact("left") * exact("weight") <= cap * exact("source_size") * exact("weight_left"))
        .withColumn("first_within", F.min(F.when(F.col("within"), F.struct("order", "left", "weight_left"))).over(whole))
    )
    share = (F.col("first_within.left") * F.col("weight")).cast("double") / (100 * F.col("first_within.weight_left"))
    return filled.select(
        "source_key", "source_size",
        F.when(F.col("order") >= F.col("first_within.order"), share)
        .otherwise((most * F.col("source_size")).cast("double")).alias("target"),
        _cycled([_integrals(shape) for shape in shapes], F.col("source_rank")).alias("pieces"),
    )


def planned(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
    shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES,
) -> DataFrame:
    """Per document: `row`, size, source_size, target and `times`, the training times of its copies in the mix."""
    return _placed(sized(docs), weights, percent, most, shapes)


def _placed(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
    shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES,
) -> DataFrame:
    slices = rows.groupBy("source_key", "slice").agg(F.sum("size").alias("size"))
    starts = slices.join(targets(slices, weights, percent, most, shapes), "source_key").select(
        "source_key", "slice", "source_size", "target", "pieces",
        (F.sum("size").over(Window.partitionBy("source_key").orderBy("slice")) - F.col("size")).alias("slice_start"),
    )
    inside = Window.partitionBy("source_key", "slice").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = lambda copy: F.col("middle") + copy * F.col("source_size")
    return (
        rows.join(starts, ["source_key", "slice"])
        .withColumn("middle", F.col("slice_start") + F.sum("size").over(inside) - F.col("size") / 2)
        .withColumn("copies", F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda copy: middle(copy) <= F.col("target")))
        .select(
            "row", "size", "source_size", "target",
            F.transform("copies", lambda copy: time_of(
                F.when(F.col("target") > 0, middle(copy) / F.col("target")).otherwise(0.0), F.col("pieces"))).alias("times"),
        )
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The documents in training order, each as often as the mix takes it, with their columns as they were."""
    placed = planned(docs, **settings).select("row", F.explode("times").alias("time"))
    return placed.orderBy("time", "row.doc_id").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """Per document: how many words the mix takes of it; in training order, those that it leaves out
    last.

    Texts are sized where they are read, once, and go no further.
    """
    plan = _placed(stored(sized(docs, ["doc_id"]), "mix-sizes")).withColumn("time", F.get("times", F.lit(0)))
    return plan.orderBy(F.col("time").asc_nulls_last(), "row.doc_id").select(
        "row.doc_id", "size", "source_size", "target", (F.size("times") * F.col("size")).alias("taken"))
