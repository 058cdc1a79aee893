"""JSON records: strict parse, typed decode, plain and extended encode.

A line is parsed once, into ``map<string,variant>``: the map keeps the
document's key order and repeated keys, the variants keep each value's own
type and all digits of its number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from rowhaul.functions.coerce import (
    INTEGRAL, NUMERIC, try_binary, try_date, try_decimal, try_instant, try_integral, try_local, try_number_sql, try_text_sql, try_uuid,
)
from rowhaul.functions.text import iso_timestamp_sql, literal, quoted, trim_zeros_sql, value_text_sql
from rowhaul.types import DECIMAL_LIMIT, JSON_NUMBER, UUID, decimal_type, is_flat, logical

RECORD = T.MapType(T.StringType(), T.VariantType())
# Strict JSON only: no single quotes, no NaN.
PARSE_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Wrapper names of Extended JSON (fixed values).
NUMBER_LONG, NUMBER_DECIMAL, DATE, WRAPPED_UUID, BINARY = "$numberLong", "$numberDecimal", "$date", "$uuid", "$binary"
WRAPPERS = (NUMBER_LONG, NUMBER_DECIMAL, DATE, WRAPPED_UUID, BINARY)


_OPTIONS_SQL = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in PARSE_OPTIONS.items()) + ")"


def parse_line(line: str) -> Column:
    """First step of reading a line: the values of the text as an array, null when it is no JSON.

    The added brackets make any text after the object an error.
    """
    return F.expr(f"from_json(concat('[', {quoted(line)}, ']'), 'array<map<string,variant>>', {_OPTIONS_SQL})")


def one_record(parsed: str, line: str) -> Column:
    """Second step: the record of a line that is exactly one object, else null."""
    x, p = quoted(line), quoted(parsed)
    # Text such as "{..}] [" closes the added bracket itself; it cannot also close an added brace.
    closed = f"(NOT contains({x}, ']') OR size(json_object_keys(concat('{{\"r\":', {x}, '}}'))) = 1)"
    return F.expr(f"CASE WHEN size({p}) = 1 AND {closed} THEN {p}[0] END")


def is_blank(line: str) -> Column:
    """No character but white space, as Unicode defines it."""
    return F.expr(rf"NOT rlike({quoted(line)}, r'(?U)\S')")


def type_tag(value: Column) -> Column:
    """Spark type text of a variant value, e.g. ``DECIMAL(2,1)``; ``VOID`` for JSON null."""
    return F.schema_of_variant(value)


def variant_text(value: str) -> Column:
    """Text of a scalar variant; a number's has all its digits."""
    return F.expr(f"try_variant_get({value}, '$', 'string')")


def wrapper_tag(name: str) -> str:
    return f"OBJECT<`{name}`: STRING>"


def _inner_sql(value: str, name: str) -> str:
    return f"""try_variant_get({value}, '$["{name}"]', 'string')"""


def tagged(value: str, extended: bool = False) -> Column:
    return F.expr(tagged_sql(value, extended))


def tagged_sql(value: str, extended: bool = False) -> str:
    """Kind and text of a scalar variant: all that decoding needs, computed once per value.

    The kind is the value's type text, or the wrapper's name; the text of a
    number has all its digits.
    """
    kind, text = f"schema_of_variant({value})", f"try_variant_get({value}, '$', 'string')"
    if extended:
        tags = [(literal(wrapper_tag(n)), n) for n in WRAPPERS]
        text = f"CASE {kind} " + " ".join(f"WHEN {t} THEN {_inner_sql(value, n)}" for t, n in tags) + f" ELSE {text} END"
        kind = f"CASE {kind} " + " ".join(f"WHEN {t} THEN {literal(n)}" for t, n in tags) + f" ELSE {kind} END"
    return f"named_struct('kind', {kind}, 'text', {text})"


def quickly_decoded(field: T.StructField) -> bool:
    """Whether ``quick_decode`` knows the column's type."""
    return isinstance(field.dataType, T.DecimalType) or (isinstance(field.dataType, T.StringType) and logical(field) is None)


def quick_decode(value: str, text: str, field: T.StructField) -> Column:
    """A scalar variant and its text to the column's type, as ``decode`` does it.

    The usual values of a column, short plain numbers or strings, need the text alone. All others
    are decoded in a lambda, which stays out of the generated code: of many columns
    that would be too long for the JVM to compile.
    """
    rest = f"transform(transform(array({value}), v -> {tagged_sql('v')}), t -> {decode_sql('t', field)})[0]"
    if isinstance(field.dataType, T.StringType):
        return F.expr(f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN {text} ELSE {rest} END")
    point = f"instr({text}, '.')"
    # true and false have an e, too
    plain = f"length({text}) < {len(DECIMAL_LIMIT)} AND NOT contains({text}, 'E') AND NOT contains({text}, 'e')"
    fits = f"({point} = 0 OR length({text}) - {point} <= {field.dataType.scale})"
    return F.expr(f"coalesce(CASE WHEN {plain} AND {fits} THEN try_cast({text} AS {field.dataType.simpleString()}) END, {rest})")


def _number_to_decimal(kind: str, text: str, data_type: T.DecimalType) -> str:
    """Exact decimal of a JSON number, null when scale or range cannot hold it."""
    value = f"try_cast({text} AS {data_type.simpleString()})"
    # Texts of decimals carry no trailing zeros; only numbers with an exponent arrive as doubles.
    keeps = (
        f"if({kind} = 'DOUBLE', double({value}) = double({text}), "
        f"instr({text}, '.') = 0 OR length({text}) - instr({text}, '.') <= {data_type.scale})"
    )
    fits = f"(length({text}) < {len(DECIMAL_LIMIT)} OR abs({value}) <= CAST('{DECIMAL_LIMIT}' AS decimal(38,0)))"
    return f"CASE WHEN {keeps} AND {fits} THEN {value} END"


def number_digits_sql(text: str) -> tuple[str, str]:
    """Digits before and after the decimal point that the number in ``text`` needs; null when it is none."""
    # nearly all numbers have no exponent, and one pattern is enough for them
    plain = f"rlike({text}, r'^[+-]?[0-9]+([.][0-9]+)?\\z')"
    plain_whole = f"length(ltrim('+-0', substring_index({text}, '.', 1)))"
    plain_part = f"if(instr({text}, '.') = 0, 0, length(rtrim('0', {text})) - instr({text}, '.'))"
    number = f"rlike({text}, r'^[+-]?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]{{1,4}})?$')"
    mantissa = f"ltrim('+-', regexp_replace({text}, r'[eE].*$', ''))"
    power = f"coalesce(try_cast(regexp_extract({text}, r'[eE](.*)$', 1) AS int), 0)"
    whole = f"length(ltrim('0', regexp_replace({mantissa}, r'[.].*$', '')))"
    part = f"length(rtrim('0', regexp_extract({mantissa}, r'[.](.*)$', 1)))"
    return tuple(
        f"CASE WHEN {plain} THEN {y} WHEN {number} THEN greatest(0, {x}) END"
        for y, x in ((plain_whole, f"{whole} + {power}"), (plain_part, f"{part} - {power}"))
    )


def _number_to_integral(kind: str, text: str, data_type: T.DataType) -> str:
    name = data_type.simpleString()
    return (
        f"CASE WHEN instr({text}, '.') = 0 THEN try_cast({text} AS {name}) "
        f"WHEN {kind} = 'DOUBLE' AND double({text}) % 1 = 0 THEN try_cast(double({text}) AS {name}) END"
    )


def decode(tag: str, field: T.StructField, extended: bool = False) -> Column:
    return F.expr(decode_sql(tag, field, extended))


def decode_sql(tag: str, field: T.StructField, extended: bool = False) -> str:
    """A tagged value to the column's type: scalars only, strict, null kept."""
    kind, text, data_type = f"{tag}.kind", f"{tag}.text", field.dataType
    name = data_type.simpleString()
    number = f"({kind} = 'BIGINT' OR {kind} = 'DOUBLE' OR startswith({kind}, 'DECIMAL'))"
    cases = [f"WHEN {kind} = 'STRING' THEN {try_text_sql(text, field)}"]

    def case(condition: str, result: str) -> None:
        cases.append(f"WHEN {condition} THEN {result}")

    if isinstance(data_type, T.StringType) and logical(field) is None:
        case(f"{kind} = 'BOOLEAN'", f"initcap({text})")
        case(number, trim_zeros_sql(text))
        if extended:
            case(f"{kind} IN ('{NUMBER_LONG}', '{NUMBER_DECIMAL}')", text)
    elif isinstance(data_type, NUMERIC + (T.BooleanType,)):
        if extended:
            case(f"{kind} = '{NUMBER_LONG}'", _from_wrapper(text, T.LongType(), field))
            case(f"{kind} = '{NUMBER_DECIMAL}'", _from_wrapper(text, decimal_type(), field))
        if isinstance(data_type, T.BooleanType):
            case(f"{kind} = 'BOOLEAN'", f"boolean({text})")
            case(number, f"double({text}) <> 0")
        else:
            if isinstance(data_type, T.DecimalType):
                case(number, _number_to_decimal(kind, text, data_type))
            elif isinstance(data_type, INTEGRAL):
                case(number, _number_to_integral(kind, text, data_type))
            else:
                case(number, f"try_cast({text} AS {name})")
            case(f"{kind} = 'BOOLEAN'", f"CAST(int(boolean({text})) AS {name})")
    elif extended:
        if isinstance(data_type, T.TimestampNTZType):
            case(f"{kind} = '{DATE}'", try_local(text))
        elif isinstance(data_type, T.TimestampType):
            case(f"{kind} = '{DATE}'", try_instant(text))
        elif isinstance(data_type, T.DateType):
            case(f"{kind} = '{DATE}'", try_date(text))
        elif isinstance(data_type, T.BinaryType):
            case(f"{kind} = '{BINARY}'", try_binary(text))
        elif logical(field) == "uuid":
            case(f"{kind} = '{WRAPPED_UUID}'", try_uuid(text))
    if extended:
        # The wrapped kinds are the common ones there.
        cases = [*cases[1:], cases[0]]
    what = literal(f"property '{field.name}': only scalar JSON values, and no loss; cannot be converted to {logical(field) or name}: ")
    failed = f"raise_error(concat({what}, {kind}, ' ', coalesce({text}, '')))"
    return f"CASE WHEN {kind} IS NOT NULL AND {kind} <> 'VOID' THEN coalesce(CASE {' '.join(cases)} END, {failed}) END"


def _from_wrapper(text: str, wrapped: T.DataType, field: T.StructField) -> str:
    """Text of a wrapped number to the column's type."""
    number = T.LongType() if isinstance(wrapped, T.LongType) else wrapped
    if isinstance(field.dataType, type(number)):
        return try_text_sql(text, field)
    inner = try_integral(text, number) if isinstance(number, T.LongType) else try_decimal(text, number)
    return try_number_sql(f"({inner})", number, field)


def first_value_field(name: str, tag: str, text: str | None, extended: bool, scale: int) -> T.StructField:
    """Column for the first record's value: its own type; null gives string."""
    number = T.StructField(name, decimal_type(scale), True, JSON_NUMBER)
    if tag == "VOID" or tag == "STRING":
        return T.StructField(name, T.StringType(), True)
    if tag == "BOOLEAN":
        return T.StructField(name, T.BooleanType(), True)
    if tag in ("BIGINT", "DOUBLE") or tag.startswith("DECIMAL"):
        return number
    if extended:
        if tag == wrapper_tag(NUMBER_LONG):
            return T.StructField(name, T.LongType(), True)
        if tag == wrapper_tag(NUMBER_DECIMAL):
            return number
        if tag == wrapper_tag(DATE):
            instant = text is not None and (text.endswith("Z") or any(s in text.partition("T")[2] for s in "+-"))
            return T.StructField(name, T.TimestampType() if instant else T.TimestampNTZType(), True)
        if tag == wrapper_tag(WRAPPED_UUID):
            return T.StructField(name, T.StringType(), True, UUID)
        if tag == wrapper_tag(BINARY):
            return T.StructField(name, T.BinaryType(), True)
        if tag.startswith("OBJECT<`") and tag.count("`: ") == 1:
            raise ValueError(f"property '{name}': unsupported Extended JSON value {tag}")
    raise ValueError(f"property '{name}': record values must be scalar JSON values, found {tag}")


def _finite_sql(x: str, data_type: T.DataType) -> str:
    if not isinstance(data_type, (T.FloatType, T.DoubleType)):
        return x
    return f"if(isnan({x}) OR abs({x}) = double('Infinity'), raise_error('JSON has no text for NaN or infinity'), {x})"


def _plain_sql(x: str, field: T.StructField) -> str:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp_sql(x, field.dataType)
    return _finite_sql(x, field.dataType)


def _wrap(name: str, x: str, text: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN named_struct('{name}', {text}) END"


def round_trip_date_sql(x: str, data_type: T.DataType) -> str:
    """Date text with seven fraction digits; an instant adds its offset, a plain date begins at midnight."""
    if isinstance(data_type, T.DateType):
        return f"concat(string({x}), 'T00:00:00.0000000')"
    text = f"""date_format({x}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'")"""
    return f"concat({text}, date_format({x}, 'xxx'))" if isinstance(data_type, T.TimestampType) else text


def _extended_sql(x: str, field: T.StructField) -> str:
    data_type = field.dataType
    if isinstance(data_type, T.LongType):
        return _wrap(NUMBER_LONG, x, f"string({x})")
    if isinstance(data_type, T.DecimalType):
        return _wrap(NUMBER_DECIMAL, x, value_text_sql(x, field))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return _wrap(DATE, x, round_trip_date_sql(x, data_type))
    if logical(field) == "uuid":
        return _wrap(WRAPPED_UUID, x, x)
    if isinstance(data_type, T.BinaryType):
        return _wrap(BINARY, x, f"base64({x})")
    return _finite_sql(x, data_type)


def encode(fields: list[T.StructField], extended: bool = False, nested: bool = False) -> Column:
    """The named columns as one JSON object, in order, nulls written.

    ``nested`` lets document values (variants, arrays, structs) through; files refuse them.
    """
    parts = []
    for field in fields:
        if not (nested or is_flat(field.dataType)):
            raise ValueError(f"column '{field.name}': {field.dataType.simpleString()} does not fit a flat record")
        value = (_extended_sql if extended else _plain_sql)(quoted(field.name), field)
        parts.append(f"{literal(field.name)}, {value}")
    return F.expr(f"to_json(named_struct({', '.join(parts)}), map('ignoreNullFields', 'false'))")
