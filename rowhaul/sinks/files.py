"""File sinks. Part files follow the order of the DataFrame's partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from rowhaul.functions.json import encode
from rowhaul.functions.text import NULL_TEXT, csv_escape_sql, quoted, value_text
from rowhaul.operators.schema import check_names, require_flat

FORMATS = ("csv", "json", "jsonl", "extended-json")


def write_records(df: DataFrame, path: str, format: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Write ``df`` in one of the four formats."""
    name = format.lower()
    if name not in FORMATS:
        raise ValueError(f"unsupported format '{format}'")
    check_names(df.columns)
    if name == "csv":
        _write_csv(df, path, mode, compression)
    else:
        lines = json_lines(df, extended=name == "extended-json")
        if name == "json":
            lines = lines.mapInArrow(_array_text, "value string")
        lines.write.mode(mode).text(path, compression=compression)


def json_lines(df: DataFrame, extended: bool = False) -> DataFrame:
    """One JSON object per row, in a single ``value`` column; document values stay nested JSON."""
    nested = any(isinstance(f.dataType, T.VariantType) for f in df.schema.fields)
    return df.select(encode(df.schema.fields, extended, nested).alias("value"))


def _array_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One JSON array per partition, streamed: brackets and commas around the records."""
    started = False
    for batch in batches:
        values = batch.column(0)
        if not len(values):
            continue
        values = pc.binary_join_element_wise(pa.scalar(","), values, "")
        if not started:
            values = pa.concat_arrays([pc.utf8_replace_slice(values[:1], 0, 1, "["), values[1:]])
            started = True
        yield pa.RecordBatch.from_arrays([values], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if started else "[]"])], ["value"])


def _write_csv(df: DataFrame, path: str, mode: str, compression: str | None) -> None:
    require_flat(df.schema)
    text = df.select(*[value_text(f).alias(f.name) for f in df.schema.fields])
    text = text.select(*[F.expr(csv_escape_sql(quoted(n))).alias(n) for n in df.columns])
    text.write.mode(mode).csv(
        path, header=True, nullValue=NULL_TEXT,
        # A lone empty field would be an empty line, which readers drop.
        emptyValue='""' if len(df.columns) == 1 else "",
        quote='"', escape='"', lineSep="\n",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression,
    )
