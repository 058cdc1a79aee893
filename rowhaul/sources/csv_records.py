"""CSV records that are not one line each."""

from __future__ import annotations

import csv
import sys

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowhaul.functions.text import literal
from rowhaul.sources.pieces import joined_records, read_pieces

#: Reading rules that Spark's CSV parser gets, whether it takes files or single records (fixed values).
PARSER = {
    "quote": '"', "escape": '"', "nullValue": "\u0000", "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def quote_flips(value: Column) -> Column:
    """Whether a line changes from outside quotes to inside or back."""
    return (F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))) % 2


def _at_returns(text: str) -> str:
    """Records of a text that ends outside quotes, as SQL: a CR outside quotes also ends one."""
    runs = f"split({text}, '\"', -1)"
    cut = "split(element_at(runs, i + 1), '\\r', -1)"
    step = (
        "CASE WHEN i % 2 = 1 THEN named_struct('done', a.done, 'open', concat(a.open, '\"', element_at(runs, i + 1), '\"')) "
        f"WHEN size({cut}) = 1 THEN named_struct('done', a.done, 'open', concat(a.open, element_at(runs, i + 1))) "
        f"ELSE named_struct('done', concat(a.done, array(concat(a.open, {cut}[0])), slice({cut}, 2, size({cut}) - 2)), 'open', element_at({cut}, -1)) END"
    )
    # what follows the last CR is empty when the line ended in CR LF
    finish = "a -> CASE WHEN a.open = '' AND size(a.done) > 0 THEN a.done ELSE concat(a.done, array(a.open)) END"
    start = "named_struct('done', CAST(array() AS array<string>), 'open', '')"
    many = f"aggregate(sequence(0, size({runs}) - 1), {start}, (a, i) -> {step.replace('runs', runs)}, {finish})"
    return (
        f"CASE WHEN NOT contains({text}, '\\r') THEN array({text}) "
        f"WHEN instr({text}, '\\r') = length({text}) THEN array(substr({text}, 1, length({text}) - 1)) ELSE {many} END"
    )


def _ragged(width: int) -> str:
    """Error text for a record, as SQL: how many fields it has by its commas outside quotes."""
    outside = "filter(split(record, '\"', -1), (x, i) -> i % 2 = 0)"
    fields = f"aggregate({outside}, 1, (n, x) -> n + length(x) - length(replace(x, ',', '')))"
    return f"concat(file, ': a record needs {width} fields but has ', {fields}, CASE WHEN trim(record) = '' THEN ' on a blank line' ELSE '' END)"


def record_fields(spark: SparkSession, path, header: list[str], separator: str = "\n") -> DataFrame:
    """Fields ``c0``, ``c1``, ... of all records but the header of each file, which must be ``header``."""
    pieces, width = read_pieces(spark, path, separator), len(header)
    texts = joined_records(pieces, quote_flips(F.col("value")), separator)
    plain = texts.withColumn("text", F.when(F.col("number") == 1, F.expr("ltrim('\\uFEFF', text)")).otherwise(F.col("text")))
    each = plain.select("file", "number", F.posexplode(F.expr(_at_returns("text"))).alias("place", "record"))
    names = [f"c{i}" for i in range(width)]
    schema = ", ".join([*(f"{n} string" for n in names), "_bad string"])
    parsed = each.withColumn("fields", F.from_csv("record", schema, {**PARSER, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.expr(f"raise_error({_ragged(width)})").cast("string")
    # An empty text is one empty field; the parser has none for it.
    empty = F.col("record") == ""
    wrong = (empty & F.lit(width > 1)) | (~empty & F.col("fields._bad").isNotNull())
    first = F.when(wrong, bad).when(empty, F.lit("")).otherwise(F.coalesce("fields.c0", F.lit("")))
    texts = parsed.select("file", "number", "place", first.alias("c0"), *(F.coalesce(f"fields.{n}", F.lit("")).alias(n) for n in names[1:]))
    same = F.expr(" AND ".join(f"c{i} = {literal(h)}" for i, h in enumerate(header)))
    other = F.raise_error(F.concat("file", F.lit(": the CSV files do not share one header"))).cast("boolean")
    is_header = (F.col("number") == 1) & (F.col("place") == 0)
    return texts.where(F.when(is_header, F.when(same, F.lit(False)).otherwise(other)).otherwise(F.lit(True))).select(*names)


def split_header(text: str) -> list[str]:
    """Fields of one record text."""
    csv.field_size_limit(sys.maxsize)
    return next(csv.reader([text], strict=False), [""])
