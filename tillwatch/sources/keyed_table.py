"""Tables with one row per key, on plain Parquet.

A micro-batch is written once, to a folder of its own; a reader takes one row per key. So a write costs what the batch holds
and never rewrites the table, a batch that runs again replaces its own folder and nothing else, and a lost executor only
repeats its task. `fold` writes the table as it stands after a batch to a snapshot folder; readers take the newest finished
one and the batches after it, so a read costs a snapshot and the batches since.

Folders are named by their batch, and count once Spark has marked them as finished.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tillwatch.operators.keyed import apart, earliest_per_key, latest_per_key

_VERSION, _BUCKET = "_version", "_bucket"


class KeyedTable:
    """Upserts by `keys`.

    keep="last": the row of the latest batch wins, inside a batch the one with the greatest `order`.
    keep="first": the row with the smallest `order` wins, whichever batch brings it.
    keep="sum": `order` names the columns that are added up over all batches; all others are keys.
    `partition_by` names columns that never change for a key, such as the day an order was made; they count as part of
    the key, so that a filter on them reaches the folders. A table may be cut into `buckets` by a hash of `bucket_by` (its
    keys, if not named), so that a look-up of some keys reads their buckets and no others.
    """

    def __init__(
        self, path: str, schema: str, keys: Sequence[str], order: Sequence[str],
        partition_by: Sequence[str] = (), keep: str = "last", buckets: int = 0, bucket_by: Sequence[str] = (),
    ):
        if keep not in ("first", "last", "sum"):
            raise ValueError("keep is 'first', 'last' or 'sum'")
        self.path, self.schema, self.order = path, schema, list(order)
        self.keys = list(dict.fromkeys([*partition_by, *keys]))
        self.partition_by, self.keep, self.buckets = list(partition_by), keep, buckets
        self.bucket_by = list(bucket_by or keys)
        #: Columns that name a partition's folder.
        self.parts = [*self.partition_by, *([_BUCKET] if buckets else [])]

    def _resolved(self, rows: DataFrame, joined: bool = False) -> DataFrame:
        if self.keep == "sum":
            group = [*self.keys, apart(self.keys)] if joined else self.keys
            sums = rows.groupBy(*group).agg(*[F.sum(name).alias(name) for name in self.order])
            return sums.select(*StructType.fromDDL(self.schema).fieldNames())
        if self.keep == "first":
            return earliest_per_key(rows, self.keys, self.order, joined)
        return latest_per_key(rows, self.keys, [_VERSION, *self.order], joined)

    def _bucket_of(self, columns: Sequence[str]) -> Column:
        kinds = {field.name: field.dataType for field in StructType.fromDDL(self.schema)}
        own = [F.col(name).cast(kinds[key]) for key, name in zip(self.bucket_by, columns)]
        return F.pmod(F.xxhash64(*own), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, folder: str) -> None:
        out = rows.drop(_VERSION)
        if self.buckets:
            out = out.withColumn(_BUCKET, self._bucket_of(self.bucket_by))
        if self.parts and rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            # Few files per folder, and a folder with most of the rows still written by many tasks.
            out = out.hint("rebalance", *self.parts)
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*self.parts) if self.parts else writer).parquet(f"{self.path}/{folder}")

    def _finished(self, spark: SparkSession, kind: str) -> list[int]:
        """Batches of the finished folders `kind`/_version=…, in their order."""
        marks = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{_VERSION}=*/_SUCCESS")
        found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
        return sorted(int(own.getPath().getParent().getName().split("=")[1]) for own in found)

    def _stored(self, spark: SparkSession, kind: str, versions: Sequence[int]) -> DataFrame:
        bucket = f", {_BUCKET} INT" if self.buckets else ""
        ddl = f"{self.schema}{bucket}, {_VERSION} BIGINT"
        if not versions:
            return spark.createDataFrame([], ddl)
        folder = f"{self.path}/{kind}"
        rows = spark.read.schema(ddl).option("basePath", folder).parquet(*[f"{folder}/{_VERSION}={own}" for own in versions])
        return rows.select(*StructType.fromDDL(ddl).fieldNames())

    def upsert(self, rows: DataFrame, batch_id: int, unique: bool = False) -> None:
        """Store a micro-batch under its id; `unique` says its keys are already one row each.

        A snapshot holds all batches up to its own, so one that comes later under such an id would be lost: it is refused.
        Only the snapshot's last batch may run again, if it brings what it brought before.
        """
        spark = rows.sparkSession
        batch = rows.select(*StructType.fromDDL(self.schema).fieldNames()).withColumn(_VERSION, F.lit(batch_id).cast("bigint"))
        batch = batch if unique else self._resolved(batch)
        latest = max(self._finished(spark, "snapshots"), default=-1)
        if batch_id > latest:
            self._write(batch, f"rows/{_VERSION}={batch_id}")
        elif batch_id < latest or not self._brought(batch, batch_id):
            raise ValueError(f"{self.path} has a snapshot up to batch {latest}: other rows under batch {batch_id} would be lost")

    def _brought(self, batch: DataFrame, batch_id: int) -> bool:
        if batch_id not in self._finished(batch.sparkSession, "rows"):
            return False
        before = self._stored(batch.sparkSession, "rows", [batch_id]).select(*batch.columns)
        return batch.exceptAll(before).isEmpty() and before.exceptAll(batch).isEmpty()

    def _standing(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest snapshot and the batches after it, of those before the batch `before`."""
        def known(kind: str) -> list[int]:
            return [own for own in self._finished(spark, kind) if before is None or own < before]

        snapshots = known("snapshots")[-1:]
        batches = [own for own in known("rows") if own > max(snapshots, default=-1)]
        rows = self._stored(spark, "rows", batches)
        return rows.unionByName(self._stored(spark, "snapshots", snapshots)) if snapshots else rows

    def read(self, spark: SparkSession, joined: bool = False, before: int | None = None) -> DataFrame:
        """One row per key, as the table stands, or as it stood before the batch `before`.

        A filter on a partition column skips the other folders. `joined` says that the rows are next joined on their keys,
        to rows that may be skewed.
        """
        return self._resolved(self._standing(spark, before), joined).drop(_VERSION, _BUCKET)

    def lookup(self, rows: DataFrame, columns: Sequence[str], joined: bool = True, before: int | None = None) -> DataFrame:
        """`read`, of the buckets alone that the keys in `columns` of `rows` fall into.

        `columns` stand for `bucket_by`. What is collected are numbers of buckets, so at most `buckets` of them.
        """
        if not self.buckets:
            return self.read(rows.sparkSession, joined, before)
        touched = [own[0] for own in rows.select(self._bucket_of(columns)).distinct().collect()]
        standing = self._standing(rows.sparkSession, before).where(F.col(_BUCKET).isin(touched))
        return self._resolved(standing, joined).drop(_VERSION, _BUCKET)

    def fold(self, spark: SparkSession, upto_batch: int) -> None:
        """Write the table as it stands after `upto_batch` to a snapshot of its own.

        Readers see the same rows before, while and after: a snapshot counts once it is finished, and the folders it stands
        for stay where they are until somebody clears them away (`obsolete`).
        """
        if max(self._finished(spark, "snapshots"), default=-1) < upto_batch:
            self._write(self._resolved(self._standing(spark, upto_batch + 1)), f"snapshots/{_VERSION}={upto_batch}")

    def obsolete(self, spark: SparkSession) -> list[str]:
        """Folders that the newest snapshot stands for and no new reader opens.

        Its last batch is not among them: a stream may run that one again, and is held to what it brought.
        """
        snapshots = self._finished(spark, "snapshots")
        if not snapshots:
            return []
        batches = [own for own in self._finished(spark, "rows") if own < snapshots[-1]]
        return [f"{self.path}/{kind}/{_VERSION}={own}" for kind, versions in (("rows", batches), ("snapshots", snapshots[:-1])) for own in versions]


def with_doc_id(docs: DataFrame, batch_id: int, column: str = "doc_id") -> DataFrame:
    """Documents without an id get one from their batch and content, equal ones numbered: the same batch gives the same
    ids, however its rows are laid out."""
    content = F.sha2(F.to_json(F.struct(*[name for name in docs.columns if name != column])), 256)
    numbered = docs.withColumn("_content", F.when(F.col(column).isNull(), content))
    lone = numbered.where(F.col("_content").isNotNull()).withColumn(
        "_copy", F.row_number().over(Window.partitionBy("_content").orderBy(F.lit(0))))
    made = lone.withColumn(column, F.concat_ws("-", F.lit("auto"), F.lit(batch_id), F.left("_content", F.lit(32)), F.col("_copy")))
    return docs.where(F.col(column).isNotNull()).unionByName(made.select(*docs.columns))


def one_document(spark: SparkSession, document: dict, doc_id: str, schema: str) -> DataFrame:
    """A single document as a row to upsert."""
    row = spark.createDataFrame([document], schema)
    return row.withColumn("doc_id", F.lit(doc_id or str(uuid.uuid4())))
