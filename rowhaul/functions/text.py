"""Culture-free text of typed values, and the CSV null/escape rules.

The rules are written as SQL text over a column reference: one parsed
expression per column, however long the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowhaul.types import logical

NULL_TEXT = r"\N"


def quoted(name: str) -> str:
    """A column name as an SQL reference."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """Text as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trim_zeros_sql(x: str) -> str:
    """Drop trailing zeros after a decimal point, and the point when nothing follows."""
    return f"CASE WHEN contains({x}, '.') THEN rtrim('.', rtrim('0', {x})) ELSE {x} END"


def iso_timestamp_sql(x: str, data_type: T.DataType) -> str:
    """ISO text with the fraction trimmed; an instant keeps its offset."""
    text = f"""rtrim('.', rtrim('0', date_format({x}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))"""
    return f"concat({text}, date_format({x}, 'xxx'))" if isinstance(data_type, T.TimestampType) else text


def _double_sql(x: str) -> str:
    # Shortest digits from the JVM, rewritten: plain notation between 1E-4 and 1E+15, two-digit exponents elsewhere.
    raw = f"string({x})"
    plain = f"string(try_cast({raw} AS decimal(38,20)))"
    exponent = f"int(split_part({raw}, 'E', 2))"
    scientific = (
        f"concat(rtrim('.', rtrim('0', split_part({raw}, 'E', 1))), if({exponent} < 0, 'E-', 'E+'), "
        f"lpad(string(abs({exponent})), 2, '0'))"
    )
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'NaN' WHEN {x} = double('Infinity') THEN 'Infinity' "
        f"WHEN {x} = double('-Infinity') THEN '-Infinity' WHEN {x} = 0 THEN '0' "
        f"WHEN abs({x}) >= 1e-4 AND abs({x}) < 1e15 THEN rtrim('.', rtrim('0', {plain})) "
        f"WHEN contains({raw}, 'E') THEN {scientific} ELSE {trim_zeros_sql(raw)} END"
    )


def value_text_sql(x: str, field: T.StructField) -> str:
    """Text of a flat value, independent of any locale. Null stays null."""
    data_type = field.dataType
    if isinstance(data_type, T.StringType):
        return x
    if isinstance(data_type, T.BooleanType):
        return f"CASE WHEN {x} THEN 'True' WHEN NOT {x} THEN 'False' END"
    if isinstance(data_type, T.BinaryType):
        return f"base64({x})"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp_sql(x, data_type)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return _double_sql(x)
    if isinstance(data_type, T.DecimalType):
        text = f"string({x})"
        if data_type.scale > 6:
            # Spark writes small values of such scales as 0E-9.
            text = f"if(contains({text}, 'E'), format_string('%.{data_type.scale}f', {x}), {text})"
        return trim_zeros_sql(f"({text})") if logical(field) == "json_number" else text
    return f"string({x})"


def value_text(field: T.StructField) -> Column:
    """Text of the column ``field`` describes."""
    return F.expr(value_text_sql(quoted(field.name), field))


def csv_escape_sql(x: str) -> str:
    """Protect text that would read back as null: one more backslash before ``\\N``."""
    return rf"if(startswith({x}, r'\') AND rlike({x}, r'^\\+N$'), concat(r'\', {x}), {x})"


def csv_unescape_sql(x: str) -> str:
    """``\\N`` is null; a longer run of backslashes loses one. Quoted and unquoted fields alike."""
    return (
        rf"CASE WHEN NOT startswith({x}, r'\') THEN {x} WHEN {x} = r'\N' THEN NULL "
        rf"WHEN rlike({x}, r'^\\\\+N$') THEN substr({x}, 2) ELSE {x} END"
    )


def csv_line(fields: list[T.StructField]) -> Column:
    """One CSV record as text, as the CSV sink writes it."""
    cells = []
    for field in fields:
        x = f"({csv_escape_sql('(' + value_text_sql(quoted(field.name), field) + ')')})"
        protected = rf"""concat('"', replace({x}, '"', '""'), '"')"""
        cells.append(rf"""coalesce(if(rlike({x}, r'[,"\r\n]'), {protected}, {x}), r'\N')""")
    return F.expr(f"concat_ws(',', {', '.join(cells)})")
