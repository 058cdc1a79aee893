"""Record transforms supplied by the caller.

A transform changes values, never the set of columns. Column expressions run
inside the JVM and are the form to prefer; Python functions get Arrow batches,
or, at the price of one call per record, dictionaries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowhaul.functions.coerce import coerce
from rowhaul.functions.json import encode
from rowhaul.functions.text import quoted
from rowhaul.types import is_flat

PRESERVE = "a transform returns the columns it was given, none more and none fewer"


def _same_names(have, want) -> None:
    if len(have) != len(want) or set(have) != set(want):
        raise ValueError(PRESERVE)


def transform_columns(
    df: DataFrame, transform: Callable[[DataFrame, Mapping[str, str]], DataFrame], arguments: Mapping[str, str] | None = None
) -> DataFrame:
    """Apply column expressions; results are converted back to the original column types, strictly."""
    result = transform(df, dict(arguments or {}))
    _same_names(result.columns, df.columns)
    fields = {f.name: f for f in result.schema.fields}
    return result.select(*[
        coerce(fields[f.name], f).alias(f.name, metadata=f.metadata or {})
        for f in df.schema.fields
    ])


def transform_batches(
    df: DataFrame, transform: Callable[[pa.Table, Mapping[str, str]], pa.Table], arguments: Mapping[str, str] | None = None
) -> DataFrame:
    """Apply a Python function to Arrow tables of rows."""
    values, names = dict(arguments or {}), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            result = transform(pa.Table.from_batches([batch]), values)
            _same_names(result.column_names, names)
            if result.num_rows != batch.num_rows:
                raise ValueError("the transform must return one record per record")
            yield from result.select(names).cast(batch.schema).to_batches()

    return df.mapInArrow(run, df.schema)


def transform_records(
    df: DataFrame, transform: Callable[[dict, Mapping[str, str]], None], arguments: Mapping[str, str] | None = None
) -> DataFrame:
    """Apply a Python function that edits one record (a dict) in place."""
    values = dict(arguments or {})

    def run(table: pa.Table, args: Mapping[str, str]) -> pa.Table:
        records = table.to_pylist()
        for record in records:
            transform(record, args)
            _same_names(list(record), table.column_names)
        return pa.table(
            [pa.array([_convert(r[f.name], f.type) for r in records], f.type) for f in table.schema], schema=table.schema
        )

    return transform_batches(df, run, values)


def _convert(value, kind: pa.DataType):
    """A changed value to its column's type; what does not fit fails, naming value and type."""
    try:
        if value is None:
            return None
        if pa.types.is_boolean(kind) and not isinstance(value, bool):
            return {"true": True, "false": False}[value.strip().lower()] if isinstance(value, str) else bool(value)
        if pa.types.is_integer(kind) and isinstance(value, bool):
            return int(value)
        if pa.types.is_integer(kind) and not isinstance(value, int):
            whole = Decimal(str(value))
            if whole != whole.to_integral_value():
                raise ValueError("fraction")
            return int(whole)
        if pa.types.is_floating(kind):
            return float(value)
        if pa.types.is_decimal(kind) and not isinstance(value, Decimal):
            return Decimal(str(value))
        if (pa.types.is_string(kind) or pa.types.is_large_string(kind)) and not isinstance(value, str):
            return str(value)
        return value
    except (ValueError, KeyError, ArithmeticError, TypeError) as error:
        raise ValueError(f"transform value '{value}' cannot be converted to {kind}") from error


def json_bytes(df: DataFrame) -> Column:
    """UTF-8 length of a record written as JSON."""
    return F.octet_length(encode(df.schema.fields, nested=True)).cast("bigint")


def _json_bytes_bound(df: DataFrame) -> Column | None:
    """Cheap upper bound of ``json_bytes`` for flat records: an escaped character takes at most six bytes."""
    fixed, parts = 2, []
    for field in df.schema.fields:
        fixed += 6 * len(field.name.encode("utf-8")) + 4
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            fixed += 6
            parts.append(F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)).cast("bigint"))
        elif is_flat(field.dataType):
            fixed += 64
        else:
            return None
    return reduce(lambda a, b: a + b, parts, F.lit(0).cast("bigint")) * 6 + fixed


def limit_record_bytes(df: DataFrame, max_record_bytes: int) -> DataFrame:
    """Stop the job when a transformed record, as JSON, exceeds the limit; only records near it are encoded to see."""
    if max_record_bytes < 1:
        raise ValueError("max_record_bytes must be at least 1")
    too_large = F.raise_error(F.lit("transformed record exceeds the size limit")).cast("boolean")
    check = F.when(json_bytes(df) > max_record_bytes, too_large).otherwise(F.lit(True))
    bound = _json_bytes_bound(df)
    return df.where(check if bound is None else F.when(bound <= max_record_bytes, F.lit(True)).otherwise(check))
