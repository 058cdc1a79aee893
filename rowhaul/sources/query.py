"""Query sources: the text goes to Spark SQL as it is."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowhaul.operators.schema import check_names
from rowhaul.types import SOURCE_CAPABILITIES, logical


def register_tables(spark: SparkSession, tables: Mapping[str, str]) -> None:
    """Make Parquet tables available to query text under the given names."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def sql_query(spark: SparkSession, text: str, args: Mapping | None = None) -> DataFrame:
    """Run the caller's query text unmodified; ``args`` are bound parameters, never spliced into the text."""
    return spark.sql(text, args=dict(args)) if args else spark.sql(text)


def validate(df: DataFrame) -> int:
    """Resolve the schema and move nothing; returns the number of columns."""
    return len(check_names(df.columns))


def inspect(df: DataFrame) -> DataFrame:
    """Columns of a source, one row each, from the analysed schema alone. Sources report every column as nullable."""
    rows = [(i, f.name, logical(f) or f.dataType.simpleString(), True) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


def inspect_json(df: DataFrame, provider: str = "sql") -> str:
    """The same description as JSON text, with the provider and its capabilities."""
    return json.dumps({
        "Provider": provider,
        "Capabilities": str(SOURCE_CAPABILITIES[provider]),
        "Columns": [
            {"Name": f.name, "Type": logical(f) or f.dataType.simpleString(), "IsNullable": True} for f in df.schema.fields
        ],
    })
