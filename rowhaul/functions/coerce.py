"""Strict conversions: a value either converts without loss or the job fails.

Rules are SQL text over a column reference. ``try_cast`` plus ``raise_error``
keeps them the same whether or not the session runs in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowhaul.functions.text import quoted, value_text_sql
from rowhaul.types import logical

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)

# A seventh fraction digit must be zero: it would be lost.
_LOCAL_DATE = r"\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6}0?)?)?)?"
_OFFSET = r"(?:Z|[+-]\d{2}:?\d{2})?"


def fail_sql(shown: str, target: str) -> str:
    """Stop the job, naming the value and the type it does not fit."""
    return f"raise_error(concat('value ', coalesce(string({shown}), ''), ' cannot be converted to {target}'))"


def _checked(x: str, result: str, target: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN coalesce({result}, {fail_sql(x, target)}) END"


# Each of these gives null for text that does not fit.


def try_decimal(x: str, data_type: T.DecimalType) -> str:
    exact = f"instr({x}, '.') = 0 OR length(rtrim('0', rtrim({x}))) - instr({x}, '.') <= {data_type.scale}"
    plain = f"NOT contains({x}, 'e') AND NOT contains({x}, 'E')"
    return f"CASE WHEN {plain} AND ({exact}) THEN try_cast({x} AS {data_type.simpleString()}) END"


def try_integral(x: str, data_type: T.DataType) -> str:
    return f"try_cast({x} AS {data_type.simpleString()})"


def try_boolean(x: str) -> str:
    return f"CASE lower(trim({x})) WHEN 'true' THEN true WHEN 'false' THEN false END"


def try_uuid(x: str) -> str:
    """Canonical lower-case 8-4-4-4-12 form; braces, parentheses and missing dashes are accepted."""
    groups = r"(\p{XDigit}{8})-?(\p{XDigit}{4})-?(\p{XDigit}{4})-?(\p{XDigit}{4})-?(\p{XDigit}{12})"
    canonical = "lower(regexp_replace(trim({x}), r'^[{{(]?{g}[}})]?$', '$1-$2-$3-$4-$5'))".format(x=x, g=groups)
    return f"CASE WHEN rlike({x}, r'^\\s*[{{(]?{groups}[}})]?\\s*$') THEN {canonical} END"


def try_binary(x: str) -> str:
    return f"try_to_binary({x}, 'base64')"


def try_local(x: str) -> str:
    """ISO text without an offset; one with an offset is refused rather than shifted."""
    return f"CASE WHEN rlike({x}, r'^{_LOCAL_DATE}$') THEN try_cast({x} AS timestamp_ntz) END"


def whole_day_sql(x: str) -> str:
    """The date of a local time; null when it holds a time of day, which a date would lose."""
    return f"CASE WHEN CAST(CAST({x} AS date) AS timestamp_ntz) = {x} THEN CAST({x} AS date) END"


def try_date(x: str) -> str:
    """ISO text without an offset, of midnight or without a time of day."""
    return whole_day_sql(f"({try_local(x)})")


def try_instant(x: str) -> str:
    """ISO text; without an offset it is taken in the session time zone."""
    return f"CASE WHEN rlike({x}, r'^{_LOCAL_DATE}{_OFFSET}$') THEN try_cast({x} AS timestamp) END"


def try_text_sql(x: str, field: T.StructField) -> str:
    """Text to a column's type, null when it does not fit."""
    data_type = field.dataType
    if logical(field) == "uuid":
        return try_uuid(x)
    if isinstance(data_type, T.StringType):
        return x
    if isinstance(data_type, T.DecimalType):
        return try_decimal(x, data_type)
    if isinstance(data_type, INTEGRAL + (T.FloatType, T.DoubleType)):
        return try_integral(x, data_type)
    if isinstance(data_type, T.BooleanType):
        return try_boolean(x)
    if isinstance(data_type, T.BinaryType):
        return try_binary(x)
    if isinstance(data_type, T.TimestampNTZType):
        return try_local(x)
    if isinstance(data_type, T.TimestampType):
        return try_instant(x)
    if isinstance(data_type, T.DateType):
        return try_date(x)
    raise ValueError(f"column '{field.name}': cannot convert text to {data_type.simpleString()}")


def from_text_sql(x: str, field: T.StructField) -> str:
    """Text to a column's type; the job fails on text that does not fit."""
    target = logical(field) or field.dataType.simpleString()
    result = try_text_sql(x, field)
    return x if result == x else _checked(x, result, target)


def try_number_sql(x: str, source: T.DataType, field: T.StructField) -> str:
    """A number to a column's type, null when it does not fit; a fraction never disappears silently."""
    data_type = field.dataType
    name = data_type.simpleString()
    value = f"try_cast({x} AS {name})"
    if isinstance(data_type, T.BooleanType):
        return f"({x}) <> 0"
    if isinstance(data_type, INTEGRAL):
        return value if isinstance(source, INTEGRAL) else f"CASE WHEN NOT {loses_fraction_sql(x)} THEN {value} END"
    if isinstance(data_type, T.DecimalType):
        if isinstance(source, T.DecimalType):
            return f"CASE WHEN {value} = {x} THEN {value} END"
        if isinstance(source, (T.FloatType, T.DoubleType)):
            return f"CASE WHEN double({value}) = double({x}) THEN {value} END"
        return value
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return value
    raise ValueError(f"column '{field.name}': cannot convert {source.simpleString()} to {name}")


def loses_fraction_sql(x: str) -> str:
    return f"(({x}) % 1 <> 0)"


def loses_fraction(name: str) -> Column:
    """True for a number that an integral column could only hold by dropping its fraction."""
    return F.expr(loses_fraction_sql(quoted(name)))


def coerce_sql(x: str, source: T.StructField, target: T.StructField) -> str:
    from_type, to_type = source.dataType, target.dataType
    if from_type == to_type and logical(source) == logical(target):
        return x
    if isinstance(from_type, T.NullType):
        return f"CAST({x} AS {to_type.simpleString()})"
    if isinstance(from_type, T.StringType):
        return from_text_sql(x, target)
    if isinstance(to_type, T.StringType):
        return value_text_sql(x, source)
    if isinstance(from_type, NUMERIC):
        return _checked(x, try_number_sql(x, from_type, target), to_type.simpleString())
    if isinstance(from_type, T.BooleanType) and isinstance(to_type, NUMERIC):
        return f"CAST(CAST({x} AS int) AS {to_type.simpleString()})"
    if isinstance(from_type, (T.TimestampNTZType, T.DateType)) and isinstance(to_type, T.TimestampType):
        return f"CAST({x} AS timestamp)"
    if isinstance(from_type, T.DateType) and isinstance(to_type, T.TimestampNTZType):
        return f"CAST({x} AS timestamp_ntz)"
    if isinstance(from_type, T.TimestampNTZType) and isinstance(to_type, T.DateType):
        return _checked(x, whole_day_sql(x), "date")
    raise ValueError(
        f"column '{target.name}': cannot convert {from_type.simpleString()} to {to_type.simpleString()}"
    )


def coerce(source: T.StructField, target: T.StructField) -> Column:
    """The column ``source`` describes, as ``target``'s type; the job fails on the first value that does not fit."""
    if source.dataType == target.dataType and logical(source) == logical(target):
        return F.col(quoted(source.name))
    return F.expr(coerce_sql(quoted(source.name), source, target))


def coerce_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Convert every column of ``df`` to the type ``schema`` gives it (same names, same order)."""
    if df.columns != schema.fieldNames():
        raise ValueError("the schema must name the same columns in the same order")
    return df.select(*[
        coerce(have, want).alias(want.name, metadata=want.metadata or {}) for have, want in zip(df.schema.fields, schema.fields)
    ])
