"""Name checks, column mapping and key checks: all on the driver, from the schema alone."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from rowhaul.functions.text import quoted
from rowhaul.types import is_flat


def check_names(names: Iterable[str], what: str = "column names", case_sensitive: bool = True) -> list[str]:
    """At least one name, none blank, none repeated."""
    names = list(names)
    if not names:
        raise ValueError(f"{what}: at least one is needed")
    if any(n is None or not n.strip() for n in names):
        raise ValueError(f"{what} must not be blank")
    seen = names if case_sensitive else [n.casefold() for n in names]
    if len(set(seen)) != len(seen):
        raise ValueError(f"{what} must be unique")
    return names


def mapped_names(names: Iterable[str], mapping: Mapping[str, str] | None) -> list[str]:
    """Destination names: sources match case-insensitively, unmapped columns keep their name."""
    lookup = {}
    for source, destination in (mapping or {}).items():
        if source.casefold() in lookup:
            raise ValueError(f"column '{source}' is mapped twice")
        lookup[source.casefold()] = destination
    return [lookup.get(n.casefold(), n) for n in names]


def map_columns(df: DataFrame, mapping: Mapping[str, str] | None, case_sensitive: bool = False) -> DataFrame:
    """Rename columns; the result's names must be unique and not blank.

    Table sinks compare names without case, document sinks with it.
    """
    names = mapped_names(df.columns, mapping)
    check_names(names, "destination columns", case_sensitive)
    return df.toDF(*names)


def nullable(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, which is all that sources promise."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def require_columns(df: DataFrame, needed: Iterable[str]) -> None:
    """The named key columns must be present (exact names)."""
    missing = [n for n in needed if n not in df.columns]
    if missing:
        raise ValueError(f"records require {' and '.join(missing)}; map a source column to it")


def key_nulls(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """How many rows lack each key: one row per key column."""
    keys = list(keys)
    require_columns(df, keys)
    counts = df.agg(*[F.count_if(F.col(quoted(k)).isNull()).alias(k) for k in keys])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(quoted(k)).alias("missing")) for k in keys
    ])).alias("r")).select("r.*")


def require_flat(schema: T.StructType) -> None:
    """Tables and flat files take scalar columns only."""
    for field in schema.fields:
        if not is_flat(field.dataType):
            raise ValueError(f"column '{field.name}': {field.dataType.simpleString()} does not fit a flat record")
