"""Record size estimates used to bound batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowhaul.functions.text import quoted

# Estimated bytes of a null and of any fixed-width value (fixed values).
NULL_BYTES = 1
SCALAR_BYTES = 16


def value_bytes(column: Column, data_type: T.DataType, floor: int = 1) -> Column:
    """Estimated payload bytes of one value: UTF-8 length of text, length of binary, 16 otherwise."""
    if isinstance(data_type, T.StringType):
        size = F.octet_length(column)
        size = F.greatest(F.lit(floor), size) if floor else size
    elif isinstance(data_type, T.BinaryType):
        size = F.octet_length(column)
    elif isinstance(data_type, T.VariantType):
        # Text counts as text, nested JSON counts its raw text.
        tag = F.schema_of_variant(column)
        text = F.octet_length(F.variant_get(column, "$", "string"))
        size = (
            F.when(tag == "VOID", NULL_BYTES)
            .when(tag == "STRING", F.greatest(F.lit(floor), text))
            .when(tag.startswith("OBJECT") | tag.startswith("ARRAY"), F.octet_length(F.to_json(column)))
            .otherwise(SCALAR_BYTES)
        )
    else:
        size = F.lit(SCALAR_BYTES)
    return F.when(column.isNull(), NULL_BYTES).otherwise(size).cast("bigint")


def record_bytes(df: DataFrame, source: str = "sql") -> Column:
    """Size estimate of a whole record.

    SQL and document sources count an empty string as one byte; file sources
    count it as none.
    """
    if source not in ("sql", "document", "file"):
        raise ValueError(f"unknown source kind '{source}'")
    floor = 0 if source == "file" else 1
    sizes = [value_bytes(F.col(quoted(f.name)), f.dataType, floor) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, sizes)

