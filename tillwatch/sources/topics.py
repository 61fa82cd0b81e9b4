"""Message topics: text lines in, routed lines out.

`kafka` needs Spark's Kafka connector on the class path; `text` and `json` read a folder that files are dropped in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwatch.records import EVENT, STARTUP, STARTUP_MARK


def read_topics(
    spark: SparkSession, kind: str, topics: list[str], where: str, group: str | None = None, most: int | None = None, **options: str
) -> DataFrame:
    """A stream of (topic, value, arrived) from Kafka brokers at `where`, or from text files at `where`/topic=<topic>.

    `most` bounds a micro-batch: offsets for Kafka, files otherwise. Message keys are dropped.
    """
    reader = spark.readStream
    if kind == "kafka":
        reader = reader.format("kafka").options(**options).option("kafka.bootstrap.servers", where)
        reader = reader.option("subscribe", ",".join(topics))
        if group:
            reader = reader.option("kafka.group.id", group)
        if most:
            reader = reader.option("maxOffsetsPerTrigger", str(most))
        return reader.load().select("topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived"))
    if kind == "text":
        if most:
            reader = reader.option("maxFilesPerTrigger", str(most))
        lines = reader.options(**options).schema("value STRING, topic STRING").text(where)
        arrived = F.col("_metadata.file_modification_time").alias("arrived")
        return lines.where(F.col("topic").isin(*topics)).select("topic", "value", arrived)
    raise ValueError(f"unknown topic kind {kind!r}")


def of_topic(lines: DataFrame, topic: str) -> DataFrame:
    """One topic of a multi-topic stream."""
    return lines.where(F.col("topic") == topic).drop("topic")


def read_files(spark: SparkSession, path: str, schema: str, form: str = "parquet", most: int | None = None) -> DataFrame:
    """A stream over files of a known schema; `most` files per micro-batch."""
    reader = spark.readStream.schema(schema).format(form)
    if most:
        reader = reader.option("maxFilesPerTrigger", str(most))
    return reader.load(path)


def log_topic(line: Column, strict: bool = False) -> Column:
    """Topic of a log line: the start topic where the text mentions `startup` anywhere; by its `type` when strict."""
    if strict:
        start = F.coalesce(F.get_json_object(line, "$.type") == STARTUP_MARK, F.lit(False))
    else:
        start = F.contains(line, F.lit(STARTUP_MARK))
    return F.when(start, F.lit(STARTUP)).otherwise(F.lit(EVENT))


def write_topics(rows: DataFrame, kind: str, where: str, batch_id: int) -> None:
    """Send (topic, value) rows of one micro-batch to Kafka, or to text files below `where`/topic=<topic>.

    Files of a batch go to their own folder, so a batch that is run again replaces what it wrote before.
    """
    out = rows.select("topic", "value")
    if kind == "kafka":
        out.write.format("kafka").option("kafka.bootstrap.servers", where).save()
    elif kind == "text":
        (
            out.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "batch").text(where)
        )
    else:
        raise ValueError(f"unknown topic kind {kind!r}")


def write_daily_log(lines: DataFrame, where: str, batch_id: int) -> None:
    """Append stamped lines (`dt`, `value`) to the raw log, one folder per day."""
    (
        lines.select("value", "dt").withColumn("batch", F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch").text(where)
    )


def show_stream(df: DataFrame, rows: int = 10):
    """Print each micro-batch's first rows."""
    return df.writeStream.format("console").option("numRows", str(rows)).option("truncate", "false")
