"""Orders meet their details across micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.operators.joins import within
from tillwatch.operators.keyed import latest_per_key
from tillwatch.operators.search import TERMS_DDL, added_up, term_changes
from tillwatch.plans.sale_detail import detail_side, order_side, wide
from tillwatch.records import JOIN_TTL_SECONDS, SALE_DETAIL_DDL
from tillwatch.sources.keyed_table import KeyedTable
from tillwatch.streaming.run import start
from tillwatch.streaming.waiting import LEFT_BATCH, RIGHT_BATCH, WaitingSides, both, left_of

#: Copies of an order in state, and tasks that a hot order is spread over; at most the number of partitions is of use.
SALTS = 4
#: Columns of a pair that come from its order.
ORDER_COLUMNS = ("order_id", "order_status", "create_time", "user_id", "dt", "order_arrived")
ARRIVALS = ("order_arrived", "detail_arrived")


def _sides(orders: DataFrame, details: DataFrame, late: str, salts: int) -> tuple[DataFrame, DataFrame]:
    left = orders.withWatermark("order_arrived", late)
    right = details.withWatermark("detail_arrived", late)
    left = left.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = right.withColumn("_own_salt", F.pmod(F.xxhash64("order_detail_id"), F.lit(salts)).cast("int"))
    return left, right


def _orders_wide(orders: DataFrame) -> DataFrame:
    return order_side(orders, F.col("arrived").alias("order_arrived"))


def _orders_thin(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("id").alias("order_id"), F.col("arrived").alias("order_arrived"))


def _details_wide(details: DataFrame) -> DataFrame:
    return detail_side(details, F.col("arrived").alias("detail_arrived"))


def _details_thin(details: DataFrame) -> DataFrame:
    return details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("_order"), F.col("arrived").alias("detail_arrived"))


def _condition(seconds: int) -> Column:
    same = (F.col("order_id") == F.col("_order")) & (F.col("_salt") == F.col("_own_salt"))
    return same & within("order_arrived", "detail_arrived", seconds)


def matched_pairs(
    orders: DataFrame, details: DataFrame, seconds: int = JOIN_TTL_SECONDS, late: str = "10 seconds", salts: int = SALTS
) -> DataFrame:
    """Order-detail pairs that arrive at most `seconds` apart, in either order.

    Both sides wait in state until the watermark has passed their reach. Each order is held once per salt and each
    detail under one salt that follows from its id, so an order with very many details is spread over `salts` tasks;
    streams have no adaptive skew join.
    """
    return _matched(_orders_wide(orders), _details_wide(details), seconds, late, salts)


def _matched(orders: DataFrame, details: DataFrame, seconds: int, late: str, salts: int) -> DataFrame:
    left, right = _sides(orders, details, late, salts)
    return left.join(right, _condition(seconds), "inner").drop("_salt", "_own_salt", "_order")


def matched_ids_and_orders(
    orders: DataFrame, details: DataFrame, seconds: int = JOIN_TTL_SECONDS, late: str = "10 seconds", salts: int = SALTS
) -> DataFrame:
    """The pairs of `matched_pairs` with no more of their order than its id and arrival, and beside them the orders
    themselves (`order_detail_id` null), to be kept in a table.

    So an order waits in state with its id and arrival alone, however wide it is and however many salts there are.
    """
    pairs = _matched(_orders_thin(orders), _details_wide(details), seconds, late, salts)
    return pairs.unionByName(_orders_wide(orders), allowMissingColumns=True)


def matched_and_lone(
    orders: DataFrame, details: DataFrame, seconds: int = JOIN_TTL_SECONDS, late: str = "10 seconds", salts: int = SALTS
) -> DataFrame:
    """Ids and arrivals of pairs, and once the watermark has passed their reach also of orders and details that found nothing.

    Nothing else waits in state. Salted like the pairs: an order comes as alone under each salt (`_salt`) that none of its details fell to. All of its
    copies leave the state with the same watermark, so `settled` sees them in one micro-batch.
    """
    return _matched_or_lone(_orders_thin(orders), _details_thin(details), seconds, late, salts)


def _matched_or_lone(orders: DataFrame, details: DataFrame, seconds: int, late: str, salts: int) -> DataFrame:
    left, right = _sides(orders, details, late, salts)
    found = left.join(right, _condition(seconds), "full_outer")
    return found.withColumn("order_id", F.coalesce("order_id", "_order")).drop("_order", "_own_salt")


def settled(batch: DataFrame, salts: int = SALTS) -> DataFrame:
    """A micro-batch of `matched_and_lone` without the copies of orders that found a detail under another salt."""
    alone = F.col("order_detail_id").isNull()
    keys = [name for name in batch.columns if name != "_salt"]
    lone = batch.where(alone).groupBy(*keys).agg(F.count_distinct("_salt").alias("_salts")).where(F.col("_salts") == salts)
    return batch.where(~alone).drop("_salt").unionByName(lone.drop("_salts"))


def run_coverage(
    orders: DataFrame, details: DataFrame, path: str, checkpoint: str, seconds: int = JOIN_TTL_SECONDS,
    late: str = "10 seconds", salts: int = SALTS, **how,
) -> StreamingQuery:
    """Store which orders and details found each other, each micro-batch in a folder of its own.

    Their ids and arrivals wait beside the checkpoint, and come out as `matched_and_lone` and `settled` have them.
    """
    left, right = _orders_thin(orders), _details_thin(details)
    sides = WaitingSides(f"{checkpoint}-waiting", ARRIVALS, seconds, late, settles=True)

    def save(batch: DataFrame, batch_id: int) -> None:
        met = sides.take(batch, batch_id, left.columns, right.columns)
        lone = F.col("order_arrived").isNull() | F.col("detail_arrived").isNull()
        found = _matched_or_lone(met.left, met.right, seconds, late, salts)
        found = found.where(F.when(lone, sides.is_over(met)).otherwise(sides.is_new(batch_id))).drop(LEFT_BATCH, RIGHT_BATCH)
        settled(found, salts).select("order_id", "order_detail_id", "order_arrived", "detail_arrived").write.mode(
            "overwrite").parquet(f"{path}/batch={batch_id}")

    return start(both(left, right), save, checkpoint, **how)


def sale_table(path: str, by_day: bool = True) -> KeyedTable:
    """Wide rows by `order-detail` id; a re-sent order replaces its rows."""
    schema = f"doc_id STRING, {SALE_DETAIL_DDL}, order_arrived TIMESTAMP"
    return KeyedTable(path, schema, ["doc_id"], ["order_arrived"], ["dt"] if by_day else [])


def waiting_table(path: str, buckets: int = 16, by_day: bool = True) -> KeyedTable:
    """Orders as they arrived, each version a row, for the details that meet them: cut by order and by day of arrival."""
    day = ["arrival_day"] if by_day else []
    schema = "order_id STRING, order_status STRING, create_time STRING, user_id STRING, dt STRING, order_arrived TIMESTAMP"
    return KeyedTable(
        path, schema + ", arrival_day STRING" * by_day, ["order_id", "order_arrived"], [], day, buckets=buckets, bucket_by=["order_id"])


def with_orders(pairs: DataFrame, orders: DataFrame, waiting: KeyedTable, batch_id: int) -> DataFrame:
    """Keep the orders of a batch, and give its pairs, which hold no more of their order than its id and arrival, its columns.

    Read are the buckets of the pairs' orders and, where the table is cut by day, the days these arrived on.
    """
    by_day = bool(waiting.partition_by)
    day = F.date_format("order_arrived", "yyyy-MM-dd")
    waiting.upsert(orders.withColumn("arrival_day", day) if by_day else orders, batch_id)
    known = waiting.lookup(pairs, ["order_id"])
    if by_day:
        first, last = pairs.agg(F.min(day), F.max(day)).first()
        known = known.where(F.col("arrival_day").between(first, last)).drop("arrival_day")
    own = known.withColumnsRenamed({"order_id": "_id", "order_arrived": "_arrived"})
    same = (F.col("order_id") == F.col("_id")) & (F.col("order_arrived") == F.col("_arrived"))
    return pairs.join(own, same, "inner").drop("_id", "_arrived")


def name_table(path: str, buckets: int = 16) -> KeyedTable:
    """Word counts of the article names by day and word, cut by word, beside the sale table."""
    return KeyedTable(path, TERMS_DDL.format(by="dt"), ["dt", "word"], [], buckets=buckets, bucket_by=["word"])


def count_names(rows: DataFrame, table: KeyedTable, names: KeyedTable, batch_id: int) -> None:
    """Bring the word counts of `names` up to date with a batch of sale rows, one for each id.

    Rows that the batch replaces are taken out. Both tables are read as they stood before the batch, so one that runs
    again writes the same counts again.
    """
    keys = F.lit(True)
    for name in table.keys:
        keys = keys & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    before = table.read(rows.sparkSession, joined=True, before=batch_id)
    replaced = before.alias("old").join(rows.select(*table.keys).alias("new"), keys, "left_semi")
    changes = term_changes(rows, replaced, "sku_name", "dt").persist()
    try:
        names.upsert(added_up(changes, names.lookup(changes, ["word"], before=batch_id), "dt"), batch_id, unique=True)
    finally:
        changes.unpersist()


def run_sale_detail(
    orders: DataFrame, details: DataFrame, users: KeyedTable | Callable[[SparkSession], DataFrame], table: KeyedTable, checkpoint: str,
    as_of: Column | None = None, seconds: int = JOIN_TTL_SECONDS, late: str = "10 seconds", salts: int = SALTS,
    names: KeyedTable | None = None, fold_every: int | None = None, waiting: KeyedTable | None = None, **how,
) -> StreamingQuery:
    """Match, look users up as they are known at each batch, and upsert the wide rows.

    What comes waits beside the checkpoint, in folders by batch, and a batch is joined to what is within its reach. With
    `waiting`, orders are kept in that table and wait with their id and arrival alone.
    `users` is the table that a stream keeps, of which a batch reads the buckets of its users, or makes users of a session.
    With `names`, the word counts that reports rank by are kept, too. Every `fold_every` batches the tables are folded.
    """
    left, right = _orders_wide(orders), _details_wide(details)
    kept_columns = _orders_thin(orders).columns if waiting else left.columns
    sides = WaitingSides(f"{checkpoint}-waiting", ARRIVALS, seconds, late)

    def save(batch: DataFrame, batch_id: int) -> None:
        held = [batch.persist()] if waiting else []
        try:
            met = sides.take(batch, batch_id, kept_columns, right.columns)
            pairs = _matched(met.left, met.right, seconds, late, salts).where(sides.is_new(batch_id)).drop(LEFT_BATCH, RIGHT_BATCH)
            if waiting or isinstance(users, KeyedTable):
                held.append(pairs.persist())
            if waiting:
                pairs = with_orders(pairs, left_of(batch).select(*left.columns), waiting, batch_id)
            known = users.lookup(pairs, ["user_id"]) if isinstance(users, KeyedTable) else users(batch.sparkSession)
            rows = wide(pairs, known, as_of, "order_arrived")
            if names:
                rows = latest_per_key(rows, table.keys, table.order).persist()
                held.append(rows)
                count_names(rows, table, names, batch_id)
            table.upsert(rows, batch_id, unique=names is not None)
        finally:
            for own in held:
                own.unpersist()
        if fold_every and (batch_id + 1) % fold_every == 0:
            for kept in filter(None, (table, names, waiting)):
                kept.fold(batch.sparkSession, batch_id)

    return start(both(left, right), save, checkpoint, **how)
