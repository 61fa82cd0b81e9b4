"""What several operators share: words, stored intermediate tables, names that clash with nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tillwatch.session import shared_dir

#: Words are runs of anything but space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, whatever the optimizer makes of the plan."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps start there, even if executors are lost."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_texts(
    df: DataFrame, kept: Sequence[str], added: str, start: Callable[[], Callable[[object], tuple]], of: str = "text",
) -> DataFrame:
    """The columns `kept` and those of the DDL `added`, which a function makes of each value of the column `of`.

    `start` runs once per task and returns the function. Kept columns pass through as Arrow arrays, untouched by Python.
    """
    new = StructType.fromDDL(added)
    schema = StructType([*(df.schema[name] for name in kept), *new])
    types = [to_arrow_type(field.dataType) for field in new]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            rows = [make(value.as_py()) for value in batch.column(of)]
            columns = zip(*rows) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), *(pa.array(own, kind) for own, kind in zip(columns, types))],
                names=[field.name for field in schema],
            )

    return df.select(*dict.fromkeys([*kept, of])).mapInArrow(mapped, schema)
