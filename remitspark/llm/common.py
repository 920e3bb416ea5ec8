"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from remitspark.session import scratch_folder
from remitspark.tables import store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared work folder and read back: they are computed once and
    are still there when an executor is lost."""
    return store(df, scratch_folder(df.sparkSession, label))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body has it in functions over arrays."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
