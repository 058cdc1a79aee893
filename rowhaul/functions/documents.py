"""Typing rules of document stores, over variant columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowhaul.functions.json import (
    BINARY, DATE, NUMBER_DECIMAL, NUMBER_LONG, WRAPPED_UUID, type_tag, wrapper_tag,
)
from rowhaul.functions.text import quoted, value_text
from rowhaul.types import decimal_type, logical

OBJECT_ID = "$oid"
# Wrappers of canonical documents only (fixed values).
NUMBER_INT, NUMBER_DOUBLE = "$numberInt", "$numberDouble"

# Date or date-time text in the extended ISO form, offset optional.
_JSON_DATE = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,7})?)?(Z|[+-]\d{2}:\d{2})?)?$"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _variant(column: Column) -> Column:
    return column.cast(T.VariantType())


def json_value(value: Column, dates: bool = True) -> Column:
    """JSON typing: null, ISO-dated text becomes an instant, whole numbers stay long, others decimal, nested stays JSON.

    ``dates=False`` leaves all text as text.
    """
    tag = type_tag(value)
    instant = _text(value).try_cast("timestamp")
    exact = F.try_variant_get(value, "$", decimal_type(18).simpleString())
    result = F.when(tag == "VOID", F.lit(None).cast(T.VariantType()))
    if dates:
        result = result.when((tag == "STRING") & _text(value).rlike(_JSON_DATE) & instant.isNotNull(), _variant(instant))
    return result.when((tag == "DOUBLE") & exact.isNotNull(), _variant(exact)).otherwise(value)


def bson_value(value: Column) -> Column:
    """Typing on read from a collection of Extended JSON documents, relaxed or canonical: object ids and nested values become text, wrappers native."""
    tag = type_tag(value)

    def inner(name: str) -> Column:
        return F.try_variant_get(value, f'$["{name}"]', "string")

    def deep(name: str, part: str) -> Column:
        return F.try_variant_get(value, f'$["{name}"]["{part}"]', "string")

    exact = inner(NUMBER_DECIMAL).try_cast(decimal_type(18).simpleString())
    return (
        F.when(tag == "VOID", F.lit(None).cast(T.VariantType()))
        .when(tag == wrapper_tag(OBJECT_ID), _variant(inner(OBJECT_ID)))
        .when(tag == wrapper_tag(NUMBER_LONG), _variant(inner(NUMBER_LONG).try_cast("bigint")))
        .when(tag == wrapper_tag(NUMBER_INT), _variant(inner(NUMBER_INT).try_cast("int")))
        .when(tag == wrapper_tag(NUMBER_DOUBLE), _variant(inner(NUMBER_DOUBLE).try_cast("double")))
        .when(tag == _nested_tag(DATE, NUMBER_LONG), _variant(F.timestamp_millis(deep(DATE, NUMBER_LONG).try_cast("bigint"))))
        .when(tag == _nested_tag(BINARY, "base64", "subType"), _variant(F.try_to_binary(deep(BINARY, "base64"), F.lit("base64"))))
        .when((tag == wrapper_tag(NUMBER_DECIMAL)) & exact.isNotNull(), _variant(exact))
        .when(tag == wrapper_tag(DATE), _variant(inner(DATE).try_cast("timestamp")))
        .when(tag == wrapper_tag(WRAPPED_UUID), _variant(inner(WRAPPED_UUID)))
        .when(tag == wrapper_tag(BINARY), _variant(F.try_to_binary(inner(BINARY), F.lit("base64"))))
        .when(tag.startswith("OBJECT") | tag.startswith("ARRAY"), _variant(F.to_json(value)))
        .otherwise(value)
    )


def _nested_tag(name: str, *fields: str) -> str:
    """Type text of a wrapper that holds an object of texts."""
    named = [f"`{f}`: STRING" if f.startswith("$") else f"{f}: STRING" for f in fields]
    return f"OBJECT<`{name}`: OBJECT<{', '.join(named)}>>"


def to_bson(field: T.StructField) -> Column:
    """Document value for a column: text that holds a JSON object or array becomes nested, instants become UTC dates, null is kept."""
    column, data_type = F.col(quoted(field.name)), field.dataType
    if isinstance(data_type, T.VariantType):
        return column
    if isinstance(data_type, T.StringType) and logical(field) is None:
        nested = F.when(column.startswith("{") | column.startswith("["), F.try_parse_json(column))
        return F.coalesce(nested, _variant(column))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        utc = F.to_utc_timestamp(column, F.current_timezone()) if isinstance(data_type, T.TimestampType) else column
        text = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
        return F.when(column.isNotNull(), F.to_variant_object(F.struct(text.alias(DATE))))
    if isinstance(data_type, T.LongType):
        return F.when(column.isNotNull(), F.to_variant_object(F.struct(column.cast("string").alias(NUMBER_LONG))))
    if isinstance(data_type, T.DecimalType):
        return F.when(column.isNotNull(), F.to_variant_object(F.struct(value_text(field).alias(NUMBER_DECIMAL))))
    if isinstance(data_type, T.BinaryType):
        return F.when(column.isNotNull(), F.to_variant_object(F.struct(F.base64(column).alias(BINARY))))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_variant_object(column)
    return _variant(column)


# Properties the table store owns (fixed values); writes leave them out.
ENTITY_KEYS = ("PartitionKey", "RowKey")
ENTITY_SYSTEM = ("Timestamp", "odata.etag")


def entity_value(field: T.StructField) -> Column:
    """Table-store value: decimals become doubles; types the store lacks become text."""
    column, data_type = F.col(quoted(field.name)), field.dataType
    if field.name in ENTITY_KEYS:
        return value_text(field)
    if isinstance(data_type, T.DecimalType):
        return column.cast("double")
    kept = (
        T.TimestampType, T.TimestampNTZType, T.BinaryType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.StringType,
    )
    if isinstance(data_type, kept):
        return column
    if isinstance(data_type, (T.VariantType, T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    return value_text(field)


def kind(value: Column) -> Column:
    """Name of a variant's value kind: null, text, instant, long, decimal, double, boolean, binary or json."""
    tag = type_tag(value)
    return (
        F.when(value.isNull() | (tag == "VOID"), "null")
        .when(tag == "STRING", "text")
        .when(tag == "BOOLEAN", "boolean")
        .when(tag.startswith("TIMESTAMP") | (tag == "DATE"), "instant")
        .when(tag.startswith("DECIMAL"), "decimal")
        .when(tag.isin("DOUBLE", "FLOAT"), "double")
        .when(tag.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "long")
        .when(tag == "BINARY", "binary")
        .otherwise("json")
    )
