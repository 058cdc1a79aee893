"""Logical types, capability flags and the create-table type map."""

from __future__ import annotations

from enum import IntFlag

from pyspark.sql import types as T


class Capability(IntFlag):
    """What a sink can do. The numbers are fixed values."""

    NONE = 0
    NATIVE_BULK = 1
    UPSERT = 2
    BATCH_TRANSACTIONS = 4
    ALL_TRANSACTION = 8
    PARTIAL_SUCCESS = 16
    RESUME = 32
    ORDERED_WRITES = 64

    def __str__(self) -> str:
        names = [_CAPABILITY_NAMES[f] for f in Capability if f and f in self]
        return ", ".join(names) or "None"


_CAPABILITY_NAMES = {
    Capability.NATIVE_BULK: "NativeBulk",
    Capability.UPSERT: "Upsert",
    Capability.BATCH_TRANSACTIONS: "BatchTransactions",
    Capability.ALL_TRANSACTION: "AllTransaction",
    Capability.PARTIAL_SUCCESS: "PartialSuccess",
    Capability.RESUME: "Resume",
    Capability.ORDERED_WRITES: "OrderedWrites",
}

SQL_SINK = (
    Capability.NATIVE_BULK
    | Capability.BATCH_TRANSACTIONS
    | Capability.ALL_TRANSACTION
    | Capability.ORDERED_WRITES
)
SINK_CAPABILITIES = {
    "postgresql": SQL_SINK,
    "sqlserver": SQL_SINK,
    "mysql": SQL_SINK,
    "oracle": SQL_SINK,
    "table": SQL_SINK,
    "file": Capability.ORDERED_WRITES,
    "cosmosdb": Capability.NATIVE_BULK,
    "mongodb": Capability.NATIVE_BULK | Capability.ORDERED_WRITES,
    "azure-table-storage": Capability.NATIVE_BULK,
}
SOURCE_CAPABILITIES = {
    "sql": Capability.ORDERED_WRITES,
    "postgresql": Capability.ORDERED_WRITES,
    "sqlserver": Capability.ORDERED_WRITES,
    "mysql": Capability.ORDERED_WRITES,
    "oracle": Capability.ORDERED_WRITES,
    "file": Capability.ORDERED_WRITES,
    "cosmosdb": Capability.NONE,
    "mongodb": Capability.NONE,
    "azure-table-storage": Capability.NONE,
}

UUID = {"logical": "uuid"}
# A number read from JSON text: the column's scale is ours, not the file's.
JSON_NUMBER = {"logical": "json_number"}
DECIMAL_SCALE = 9
# Largest magnitude of the 96-bit decimal number that file records may carry (fixed value).
DECIMAL_LIMIT = "79228162514264337593543950335"


def decimal_type(scale: int = DECIMAL_SCALE) -> T.DecimalType:
    return T.DecimalType(38, scale)


def logical(field: T.StructField) -> str | None:
    return (field.metadata or {}).get("logical")


def is_flat(data_type: T.DataType) -> bool:
    return isinstance(
        data_type,
        (
            T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.StringType, T.TimestampType, T.TimestampNTZType,
            T.DateType, T.BinaryType, T.NullType,
        ),
    )


# Column types per database (fixed values): postgresql, sqlserver, mysql, oracle.
_DATABASES = ("postgresql", "sqlserver", "mysql", "oracle")
_TYPE_MAP = {
    "boolean": ("boolean", "bit", "boolean", "number(1)"),
    "unsigned byte": ("smallint", "tinyint", "tinyint unsigned", "number(3)"),
    "short": ("smallint", "smallint", "smallint", "number(5)"),
    "integer": ("integer", "int", "int", "number(10)"),
    "long": ("bigint", "bigint", "bigint", "number(19)"),
    "float": ("real", "real", "float", "binary_float"),
    "double": ("double precision", "float", "double", "binary_double"),
    "decimal": ("numeric", "decimal(38,18)", "decimal(65,30)", "number"),
    "timestamp_ntz": ("timestamp", "datetime2", "datetime(6)", "timestamp"),
    "string": ("text", "nvarchar(max)", "longtext", "clob"),
    "uuid": ("uuid", "uniqueidentifier", "char(36)", "raw(16)"),
    "binary": ("bytea", "varbinary(max)", "longblob", "blob"),
}
_KINDS = {
    T.BooleanType: "boolean",
    T.ByteType: "short",
    T.ShortType: "short",
    T.IntegerType: "integer",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.DecimalType: "decimal",
    T.TimestampNTZType: "timestamp_ntz",
    # a date travels as the local time it begins at
    T.DateType: "timestamp_ntz",
    T.StringType: "string",
    T.BinaryType: "binary",
}
# Opening and closing identifier quote per database (fixed values).
_QUOTES = {
    "postgresql": ('"', '"'),
    "sqlserver": ("[", "]"),
    "mysql": ("`", "`"),
    "oracle": ('"', '"'),
}


def quote_identifier(provider: str, name: str) -> str:
    opening, closing = _QUOTES[provider]
    return opening + name.replace(closing, closing * 2) + closing


def quote_name(provider: str, *parts: str) -> str:
    """Quote a one-to-three-part table name."""
    return ".".join(quote_identifier(provider, p) for p in parts)


def sql_type(provider: str, field: T.StructField) -> str:
    """Column type that ``create table`` uses; types without one are refused."""
    kind = logical(field) if logical(field) in ("uuid", "unsigned byte") else _KINDS.get(type(field.dataType))
    if kind is None:
        raise ValueError(f"column '{field.name}': {field.dataType.simpleString()} has no {provider} column type")
    return _TYPE_MAP[kind][_DATABASES.index(provider)]


def create_table_sql(provider: str, table: tuple[str, ...], schema: T.StructType) -> str:
    """``CREATE TABLE`` text for a schema; no keys, indexes or defaults."""
    columns = ", ".join(
        f"{quote_identifier(provider, f.name)} {sql_type(provider, f)}{'' if f.nullable else ' NOT NULL'}"
        for f in schema.fields
    )
    return f"CREATE TABLE {quote_name(provider, *table)} ({columns})"
