"""File scans: CSV, JSON arrays, JSON Lines and Extended JSON.

Every scan fixes its schema from the first record, then reads the whole input
with it; each further record must have the same names in the same order. A
folder is the concatenation of its files in name order. JSON Lines and
Extended JSON split at any line, CSV and JSON arrays at any record.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from rowhaul import storage
from rowhaul.functions.json import (
    DATE, RECORD, decode, first_value_field, is_blank, number_digits_sql, one_record, parse_line, quick_decode, quickly_decoded, tagged,
    type_tag, variant_text,
)
from rowhaul.functions.text import csv_unescape_sql
from rowhaul.operators.schema import check_names
from rowhaul.sources.csv_records import PARSER, quote_flips, record_fields, split_header
from rowhaul.sources.pieces import joined_records, read_pieces
from rowhaul.types import DECIMAL_SCALE, JSON_NUMBER, decimal_type, logical

MAX_RECORD_BYTES = 4 * 1024 * 1024
#: What readers of JSON Lines say of a bad line.
_BAD_LINE = re.compile("(invalid UTF-8|exceeds the size limit|invalid JSON object|no properties|properties differ from the first record) in ")


def read_records(spark: SparkSession, path, format: str, **options) -> DataFrame:
    """Scan ``path`` in one of the formats ``csv``, ``json``, ``jsonl`` and ``extended-json``."""
    name = format.lower()
    if name == "csv":
        return read_csv(spark, path, **options)
    if name == "json":
        return read_json_array(spark, path, **options)
    if name in ("jsonl", "extended-json"):
        return read_jsonl(spark, path, extended=name == "extended-json", **options)
    raise ValueError(f"unsupported format '{format}'")


def _files(scan: DataFrame) -> list[str]:
    return sorted(scan.inputFiles())


def _no_records() -> ValueError:
    return ValueError("nothing to import: not one record was found")


# --- JSON -----------------------------------------------------------------


def _fault(value: Column, record: Column, names: list[str] | None, max_record_bytes: int) -> Column:
    """Why a line is not an acceptable record; null when it is (or is blank)."""
    fault = (
        F.when(~F.is_valid_utf8(value), "invalid UTF-8")
        .when(F.octet_length(value) > max_record_bytes, "exceeds the size limit")
        .when(is_blank("value"), F.lit(None).cast("string"))
    )
    if names:
        return _record_fault(record, names, fault)
    return fault.when(record.isNull(), "invalid JSON object").when(F.size(record) == 0, "no properties").when(
        F.size(F.array_distinct(F.map_keys(record))) != F.size(record), "repeated property"
    )


def _record_fault(record: Column, names: list[str], line_fault: Column | None = None) -> Column:
    """Why a parsed record cannot follow the first one; null when it can."""
    begin = F if line_fault is None else line_fault
    return (
        begin.when(record.isNull(), "invalid JSON object")
        .when(F.size(record) == 0, "no properties")
        .when(_names_differ(record, names), "properties differ from the first record")
    )


def _names_differ(record: Column, names: list[str]) -> Column:
    """Same names, same order, none repeated: the map's keys are the document's own sequence."""
    return F.map_keys(record) != F.array(*[F.lit(n) for n in names])


def _first_fields(record_rows: DataFrame, extended: bool, scale: int) -> list[T.StructField] | None:
    """Columns that the first row of ``record_rows`` (one ``record`` column) fixes; None when there is no row."""
    shown = record_rows.limit(1).select(
        F.map_keys("record").alias("names"),
        F.transform(F.map_values("record"), type_tag).alias("tags"),
        F.transform(F.map_values("record"), lambda v: F.try_variant_get(v, f'$["{DATE}"]', "string")).alias("dates"),
    ).collect()
    if not shown:
        return None
    row = shown[0]
    check_names(row.names)
    return [first_value_field(n, t, d, extended, scale) for n, t, d in zip(row.names, row.tags, row.dates)]


def _stop(fault: Column, where: Column) -> Column:
    return F.raise_error(F.concat(fault, F.lit(" in "), where))


def _select_values(records: DataFrame, fields: list[T.StructField], extended: bool) -> DataFrame:
    quick = [not extended and quickly_decoded(f) for f in fields]
    values = [f"get(record_values, {i})" for i in range(len(fields))]
    tags = records.select("record_values", *[
        (variant_text(v) if q else tagged(v, extended)).alias(f"t{i}") for i, (v, q) in enumerate(zip(values, quick))
    ])
    return tags.select(*[
        (quick_decode(v, f"t{i}", field) if q else decode(f"t{i}", field, extended)).alias(field.name, metadata=field.metadata or {})
        for i, (v, q, field) in enumerate(zip(values, quick, fields))
    ])


def _with_scales(records: DataFrame, fields: list[T.StructField], extended: bool) -> list[T.StructField]:
    """Give each number column the scale that all its values need, found in one pass; never less than the usual one if that fits."""
    at = [i for i, f in enumerate(fields) if logical(f) == JSON_NUMBER["logical"]]
    if not at:
        return fields
    need = {r.column: r for r in _digits_needed(records, at, extended).collect()}
    out = list(fields)
    for i in at:
        whole, part = (need[i].whole or 0, need[i].part or 0) if i in need else (0, 0)
        room = max(0, 38 - whole)
        scale = min(room, max(part, DECIMAL_SCALE))
        out[i] = T.StructField(fields[i].name, decimal_type(scale), True, fields[i].metadata)
    return out


def _digits_needed(records: DataFrame, at: list[int], extended: bool) -> DataFrame:
    """(column, whole, part) for the columns at ``at``: the most digits any of its numbers has before and after the point.

    One row per value, so that there is one expression however many columns there are.
    """
    values = F.array(*[F.expr(f"get(record_values, {i})") for i in at])
    each = records.select(F.posexplode(values).alias("nth", "value"))
    texts = each.select(F.get(F.lit(at), "nth").alias("column"), tagged("value", extended)["text"].alias("text"))
    whole, part = number_digits_sql("text")
    digits = texts.select("column", F.expr(whole).alias("whole"), F.expr(part).alias("part"))
    return digits.groupBy("column").agg(F.max("whole").alias("whole"), F.max("part").alias("part"))


def read_jsonl(
    spark: SparkSession,
    path,
    extended: bool = False,
    schema: T.StructType | None = None,
    decimal_scale: int | None = None,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> DataFrame:
    """JSON Lines, one object per line; blank lines are skipped, anything else stops the job.

    ``schema`` skips the look at the first record; with it, or with ``decimal_scale``, the numbers need no pass
    of their own that finds a scale for each column. That pass names a bad line by file and
    number; put jobs on the records under ``line_named`` to have them do so, too. ``jsonl_violations``
    reports all bad lines with their line numbers instead of stopping.
    """
    if max_record_bytes < 1:
        raise ValueError("max_record_bytes must be at least 1")
    scan = spark.read.text(path)
    if schema is None:
        fields = None
        for file in _files(scan):
            lines = spark.read.text(file)
            head = lines.where(_guard(max_record_bytes)).limit(1).select("value", parse_line("value").alias("parsed"))
            first = head.select(
                F.coalesce(
                    one_record("parsed", "value"),
                    F.raise_error(F.lit(f"invalid JSON object in {file}")).cast(RECORD),
                ).alias("record")
            )
            with line_named(spark, file, None, max_record_bytes):
                fields = _first_fields(first, extended, DECIMAL_SCALE if decimal_scale is None else decimal_scale)
            if fields is not None:
                break
        if fields is None:
            raise _no_records()
        if decimal_scale is None:
            with line_named(spark, path, [f.name for f in fields], max_record_bytes):
                fields = _with_scales(_jsonl_values(scan, fields, max_record_bytes), fields, extended)
    else:
        fields = schema.fields
    return jsonl_records(scan, fields, extended, max_record_bytes)


class BadLine(ValueError):
    """A line that is no acceptable record, by file and 1-based physical line."""

    def __init__(self, file: str, line: int, reason: str):
        super().__init__(f"{reason} in {file}, line {line}")
        self.file, self.line, self.reason = file, line, reason


@contextmanager
def line_named(spark: SparkSession, path, names: list[str] | None = None, max_record_bytes: int = MAX_RECORD_BYTES):
    """Any job that reads JSON Lines inside fails, if for a bad line, with the first one by file and line.

    Lines are counted only then. A task that meets a bad line knows the file
    but not how many lines the blocks before its own have.
    """
    try:
        yield
    except Exception as error:
        if not _BAD_LINE.search(str(error)):
            raise
        found = jsonl_violations(spark, path, names, max_record_bytes).orderBy("file", "line").first()
        if found is None:
            raise
        raise BadLine(found.file, found.line, found.reason) from error


def _guard(max_record_bytes: int) -> Column:
    """Row filter: skips blank lines, stops on lines that no later step may see."""
    value, where = F.col("value"), F.col("_metadata.file_path")
    return (
        F.when(~F.is_valid_utf8(value), _stop(F.lit("invalid UTF-8"), where).cast("boolean"))
        .when(F.octet_length(value) > max_record_bytes, _stop(F.lit("a record exceeds the size limit"), where).cast("boolean"))
        .otherwise(~is_blank("value"))
    )


def jsonl_records(
    lines: DataFrame, fields: list[T.StructField], extended: bool = False, max_record_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """Typed records of a text scan, batch or streaming, for columns fixed beforehand."""
    return _select_values(_jsonl_values(lines, fields, max_record_bytes), fields, extended)


def _jsonl_values(lines: DataFrame, fields: list[T.StructField], max_record_bytes: int) -> DataFrame:
    """The values of each record, as variants, in the order of ``fields``."""
    names = [f.name for f in fields]
    check_names(names)
    parsed = lines.where(_guard(max_record_bytes)).select(
        "value", parse_line("value").alias("parsed"), F.col("_metadata.file_path").alias("file")
    ).select("file", one_record("parsed", "value").alias("record"))
    fault = _record_fault(F.col("record"), names)
    return parsed.select(
        F.when(fault.isNotNull(), _stop(fault, F.col("file")).cast("array<variant>"))
        .otherwise(F.map_values("record")).alias("record_values")
    )


def jsonl_violations(
    spark: SparkSession, path, names: list[str] | None = None, max_record_bytes: int = MAX_RECORD_BYTES
) -> DataFrame:
    """Bad lines as (file, line, reason), ``line`` being the 1-based physical line of the file.

    ``names`` adds the check that every record has exactly these properties in this order.
    Line numbers come from line counts per file block: one narrow row per line is
    written once, so that both passes see the same split of the input.
    """
    folder = storage.new_folder(spark, "lines")
    scan = spark.read.text(path)
    parsed = scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seen"),
        "value",
        parse_line("value").alias("parsed"),
    ).select("file", "block", "seen", "value", one_record("parsed", "value").alias("record"))
    parsed.select(
        "file", "block", "seen",
        _fault(F.col("value"), F.col("record"), names, max_record_bytes).alias("reason"),
    ).write.parquet(folder)
    lines = spark.read.parquet(folder)
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("seen").alias("first_seen"))
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        lines.where(F.col("reason").isNotNull())
        .join(blocks.select("file", "block", "first_seen", before.alias("before")), ["file", "block"])
        .select("file", (F.col("before") + F.col("seen") - F.col("first_seen") + 1).alias("line"), "reason")
    )


SPACES = " \\t\\r\\n"


def _unescaped(value: Column) -> Column:
    """A text without its escaped backslashes and escaped quotes."""
    return F.replace(F.replace(value, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))


def _string_flips(value: Column) -> Column:
    """Whether a piece of JSON text changes from outside strings to inside or back."""
    bare = _unescaped(value)
    return (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2


class _ArrayShape(NamedTuple):
    joined: bool  # whether some string holds a closing brace
    first: str | None  # the first file with elements


def _array_shape(spark: SparkSession, path) -> _ArrayShape:
    """One pass over the text, without a parse: do closing braces end elements, and are files whole arrays if so.

    An element is an object of scalars, so it ends at its only closing brace
    outside strings. Counts per file block, then per file.
    """
    pieces = read_pieces(spark, path, "}")
    kind = _piece_kind("value")
    marked = pieces.select("file", "block", "seen", _string_flips(F.col("value")).alias("flips"), F.expr(kind).alias("kind"), (~F.is_valid_utf8("value")).cast("int").alias("invalid"))
    blocks = marked.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("flips").alias("flips"), F.max("invalid").alias("invalid"), F.count_if(F.col("kind") == "more").alias("more"),
        F.min_by("kind", "seen").alias("first"), F.max_by("kind", "seen").alias("last"),
    )
    files = blocks.groupBy("file").agg(
        F.sum("n").alias("n"), F.sum("flips").alias("flips"), F.max("invalid").alias("invalid"), F.sum("more").alias("more"),
        F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"),
    )
    whole = ((F.col("first") == "open") & (F.col("last") == "close") & (F.col("more") == F.col("n") - 2)) | ((F.col("n") == 1) & (F.col("first") == "empty"))
    row = files.agg(
        F.count(F.lit(1)).alias("files"), F.sum("flips").alias("flips"), F.min(F.when(F.col("invalid") == 1, F.col("file"))).alias("invalid"),
        F.min(F.when(~F.coalesce(whole, F.lit(False)), F.col("file"))).alias("broken"), F.min(F.when(F.col("n") > 1, F.col("file"))).alias("first"),
    ).first()
    if row.invalid:
        raise ValueError(f"invalid UTF-8 in {row.invalid}")
    if row.files and not row.flips and row.broken:
        raise ValueError(f"invalid JSON array in {row.broken}")
    return _ArrayShape(bool(row.flips), row.first)


def _piece_kind(value: str) -> str:
    """What a piece between closing braces is, as SQL: the array's opening, a further element, its close, an empty array, or null."""
    body = f"trim(BOTH '{SPACES}' FROM ltrim('\\uFEFF', {value}))"
    return (
        f"CASE WHEN startswith({body}, ',') THEN 'more' WHEN {body} = ']' THEN 'close' "
        f"WHEN startswith({body}, '[') THEN if(rlike({body}, r'^\\[[ \\t\\r\\n]*\\]$'), 'empty', 'open') END"
    )


def _array_elements(spark: SparkSession, path, joined: bool) -> DataFrame:
    """(record, file, leads) of every element; read by as many tasks as the files have splits, however they are laid out."""
    pieces, where = read_pieces(spark, path, "}"), F.col("file")
    if joined:
        texts = joined_records(pieces, _string_flips(F.col("value")), "}").withColumnRenamed("text", "value")
        kind = F.expr(_piece_kind("value"))
        wanted = F.when(F.col("total") == 1, "empty").when(F.col("number") == 1, "open").when(F.col("number") == F.col("total"), "close").otherwise("more")
        fits = F.when(F.coalesce(kind == wanted, F.lit(False)), kind.isin("open", "more")).otherwise(_stop(F.lit("invalid JSON array"), where).cast("boolean"))
        texts = texts.where(fits)
    else:
        texts = pieces.where(F.expr(_piece_kind("value")).isin("open", "more"))
    body = f"trim(BOTH '{SPACES}' FROM ltrim('\\uFEFF', value))"
    elements = texts.select("file", F.expr(f"startswith({body}, '[')").alias("leads"), F.expr(f"concat(substr({body}, 2), '}}')").alias("element"))
    parsed = elements.select("file", "leads", "element", parse_line("element").alias("parsed"))
    stop = _stop(F.lit("invalid JSON array or a record that is no object"), where).cast(RECORD)
    return parsed.select(F.coalesce(one_record("parsed", "element"), stop).alias("record"), "file", "leads")


def read_json_array(
    spark: SparkSession, path, schema: T.StructType | None = None, decimal_scale: int | None = None
) -> DataFrame:
    """Files that each hold one JSON array of objects, laid out in any way: they split at any closing brace."""
    shape = _array_shape(spark, path)
    if schema is None:
        if shape.first is None:
            raise _no_records()
        first = _array_elements(spark, shape.first, shape.joined).where("leads").select("record")
        fields = _first_fields(first, False, DECIMAL_SCALE if decimal_scale is None else decimal_scale)
        if decimal_scale is None:
            fields = _with_scales(_array_values(_array_elements(spark, path, shape.joined), fields), fields, False)
    else:
        fields = schema.fields
    return _select_values(_array_values(_array_elements(spark, path, shape.joined), fields), fields, False)


def _array_values(elements: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """The values of each array element, as variants, in the order of ``fields``."""
    names = [f.name for f in fields]
    check_names(names)
    record = F.col("record")
    fault = (
        F.when(record.isNull(), "a record that is no object")
        .when(_names_differ(record, names), "properties differ from the first record")
    )
    return elements.select(
        F.when(fault.isNotNull(), _stop(fault, F.col("file")).cast("array<variant>"))
        .otherwise(F.map_values(record)).alias("record_values")
    )


# --- CSV ------------------------------------------------------------------


class _Shape(NamedTuple):
    spans: bool  # some line is not one record
    blank: str | None  # a file with a blank line
    separator: str
    lines: int
    files: int


def _csv_shape(spark: SparkSession, path, separator: str = "\n") -> _Shape:
    """One pass over the text; tells how its records lie over lines.

    Stops on invalid UTF-8, on an open quote at the end of a file and, when each
    line is a record, on files whose header lines differ.
    """
    value = F.col("value")
    inner_return = (F.instr(value, "\r") > 0) & (F.instr(value, "\r") < F.length(value))
    head = F.when(F.col("block") == 0, F.col("seen"))
    lines = read_pieces(spark, path, separator).select(
        "file", "block", quote_flips(value).alias("flips"), head.alias("head"), F.contains(value, F.lit("\r")).cast("int").alias("returns"),
        inner_return.cast("int").alias("inner"), F.ltrim(F.rtrim(value, F.lit("\r")), F.lit("\uFEFF")).alias("text"),
        (~F.is_valid_utf8(value)).cast("int").alias("invalid"), (~value.rlike(r"[^\x00-\x20]") & (value != "\n")).cast("int").alias("blank"),
    )
    spans = F.max(F.greatest("flips", "inner")).alias("spans")
    files = lines.groupBy("file").agg(
        F.sum("flips").alias("flips"), spans, F.max("invalid").alias("invalid"), F.min_by("text", "head").alias("header"),
        F.max("returns").alias("returns"), F.count(F.lit(1)).alias("lines"), F.max("blank").alias("blank"),
    )
    row = files.agg(
        F.max("spans").alias("spans"), F.max("returns").alias("returns"), F.max("lines").alias("longest"), F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("files"),
        F.min(F.when(F.col("invalid") == 1, F.col("file"))).alias("invalid"),
        F.min(F.when(F.col("flips") % 2 == 1, F.col("file"))).alias("open"),
        F.min(F.when(F.col("blank") == 1, F.col("file"))).alias("blank"),
        (F.min("header") != F.max("header")).alias("mixed"),
    ).first()
    if row.spans is None:
        raise _no_records()
    if row.returns and row.longest == 1 and separator == "\n":
        return _csv_shape(spark, path, "\r")  # lines end in CR alone
    if row.invalid:
        raise ValueError(f"invalid UTF-8 in {row.invalid}")
    if row.open:
        raise ValueError(f"{row.open}: a quote opened here is never closed")
    if row.mixed and not row.spans:
        raise ValueError("the CSV files do not share one header")
    return _Shape(bool(row.spans), row.blank, separator, row.lines, row.files)


def _csv_header(spark: SparkSession, file: str) -> tuple[list[str], int]:
    """Header names of a file, its first record, and how many lines it takes: seldom more than one."""
    lines: list[str] = []
    for line in spark.read.text(file).toLocalIterator():
        lines.append(line.value)
        if sum(x.count('"') for x in lines) % 2 == 0:
            return check_names(split_header("\n".join(lines)), "CSV headers"), len(lines)
    raise _no_records()


def read_csv(spark: SparkSession, path, names: list[str] | None = None) -> DataFrame:
    """CSV with a header row; every column is text.

    ``\\N`` is null, an empty field is the empty string. Ragged records, an
    unterminated quote, invalid UTF-8 and an input without a record fail. All
    files must share one header. A first pass over the text makes the checks
    that need all of it and tells whether each line is one record. If so, Spark's
    reader takes them; if not, records are put together from their lines block by
    block, and parsed by the same rules. How large the files or their splits are
    does not matter.
    """
    shape = _csv_shape(spark, path)
    files = _files(spark.read.text(path))
    header, header_lines = _csv_header(spark, files[0])
    if names is not None and names != header:
        raise ValueError("the CSV header differs from the expected names")
    if shape.lines <= shape.files * header_lines and not shape.separator == "\r":
        raise _no_records()
    if shape.spans or len(header) == 1:
        texts = record_fields(spark, path, header, shape.separator)
    elif shape.blank:
        # Spark's reader would skip it.
        raise ValueError(f"{shape.blank}: a record needs {len(header)} fields but has 1 on a blank line")
    else:
        raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        options = {**PARSER, "multiLine": "false", "header": "true", "mode": "FAILFAST", "columnPruning": "false", "enforceSchema": "true"}
        scan = spark.read.options(**options).schema(raw).csv(path)
        # Two steps: null to empty text first, then the escape rule over a plain column.
        texts = scan.select(*[F.coalesce(f"c{i}", F.lit("")).alias(f"c{i}") for i in range(len(header))])
    return texts.select(*[F.expr(csv_unescape_sql(f"c{i}")).alias(name) for i, name in enumerate(header)])
