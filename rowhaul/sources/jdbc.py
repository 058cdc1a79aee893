"""JDBC scans: the query text goes to the database, unchanged."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Driver class per database (fixed values); the jars are the session's business.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
}


class Split(NamedTuple):
    """Range of a numeric or date column that tasks read in slices; rows outside the range still come, in the end slices."""

    column: str
    lower: str
    upper: str
    parts: int


def scan_options(provider: str, url: str, query: str, split: Split | None = None, fetch_size: int = 1000) -> dict[str, str]:
    options = {"url": url, "driver": DRIVERS[provider], "fetchsize": str(fetch_size)}
    if split is None:
        return {**options, "query": query}
    alias = "" if provider == "oracle" else "as "
    return {
        **options, "dbtable": f"({query}) {alias}q", "partitionColumn": split.column,
        "lowerBound": str(split.lower), "upperBound": str(split.upper), "numPartitions": str(split.parts),
    }


def jdbc_scan(
    spark: SparkSession, provider: str, url: str, query: str, split: Split | None = None,
    fetch_size: int = 1000, properties: dict[str, str] | None = None,
) -> DataFrame:
    """Run ``query`` in a database. Give a ``split`` for anything large: without one a single task reads it all."""
    return spark.read.format("jdbc").options(**scan_options(provider, url, query, split, fetch_size), **(properties or {})).load()
