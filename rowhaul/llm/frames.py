"""Small helpers for DataFrames that several operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowhaul import storage
from rowhaul.llm.words import pieces


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, text: str, result: list[T.StructField], measure: Callable) -> DataFrame:
    """Append the columns that ``measure`` gives for the text column; they replace input columns of the same name."""
    names = {f.name.lower() for f in result}
    keep = [f for f in df.schema.fields if f.name.lower() not in names]
    places = [df.columns.index(f.name) for f in keep]
    at = df.columns.index(text)
    schema = T.StructType([*keep, *result])

    def run(batches):
        for batch in pieces(batches):
            out = measure(batch.column(at))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *out.columns], names=schema.names)

    return df.mapInArrow(run, schema)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that begins in here go when it ends; else they stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, label: str, *parts: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder, by ``parts``: cuts lineage and outlives lost executors.

    What was shuffled on the way there is no longer on disk afterwards.
    """
    spark = df.sparkSession
    folder = storage.new_folder(spark, label)
    with _shuffles_freed(spark):
        df.write.partitionBy(*parts).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def parts_for(total_bytes: int, part_bytes: int, at_least: int = 1) -> int:
    return max(at_least, math.ceil(total_bytes / part_bytes))
