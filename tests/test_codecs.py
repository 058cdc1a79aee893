import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from rowhaul.functions.coerce import coerce_columns, loses_fraction
from rowhaul.functions.json import decode, encode, number_digits_sql, one_record, parse_line, quick_decode, tagged, variant_text
from rowhaul.functions.sizes import record_bytes
from rowhaul.functions.text import csv_escape_sql, csv_unescape_sql, value_text

UUID = "6f9619ff-8b86-d011-b42d-00c04fc964ff"


def _text(spark, data_type, values, metadata=None):
    schema = T.StructType([T.StructField("v", data_type, True, metadata or {})])
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(value_text(df.schema["v"])).collect()]


def test_number_text_is_culture_free(spark):
    values = [1.0, 1e7, 0.001, 1e-4, 1e-5, 1.5e-7, 1e15, 1e16, 123456789012345680.0, -2.5, 0.0, None, float("nan"), float("-inf")]
    assert _text(spark, T.DoubleType(), values) == [
        "1", "10000000", "0.001", "0.0001", "1E-05", "1.5E-07", "1E+15", "1E+16", "1.2345678901234568E+17", "-2.5", "0",
        None, "NaN", "-Infinity",
    ]
    assert _text(spark, T.BooleanType(), [True, False, None]) == ["True", "False", None]
    assert _text(spark, T.DecimalType(12, 2), [Decimal("1.50"), Decimal("0.00")]) == ["1.50", "0.00"]
    number = {"logical": "json_number"}
    assert _text(spark, T.DecimalType(38, 9), [Decimal("1"), Decimal("1.5"), Decimal("0"), Decimal("0.000000001")], number) == [
        "1", "1.5", "0", "0.000000001"
    ]
    assert _text(spark, T.BinaryType(), [b"\x01\x02\x03"]) == ["AQID"]


def test_time_text(spark):
    at = dt.datetime(2026, 9, 26, 12, 34, 56)
    assert _text(spark, T.TimestampNTZType(), [at, at.replace(microsecond=120000)]) == ["2026-09-26T12:34:56", "2026-09-26T12:34:56.12"]
    assert _text(spark, T.TimestampType(), [at.replace(tzinfo=dt.timezone.utc)])[0].startswith("2026-09-26T12:34:56")


def test_csv_escape_round_trip(spark):
    values = ["", "\\N", "\\\\N", "\\\\\\N", "N", "\\", "\\M", "x\\N"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    escaped = df.select(F.expr(csv_escape_sql("v")).alias("v"))
    assert [r.v for r in escaped.collect()] == ["", "\\\\N", "\\\\\\N", "\\\\\\\\N", "N", "\\", "\\M", "x\\N"]
    assert [r.v for r in escaped.select(F.expr(csv_unescape_sql("v")).alias("v")).collect()] == values
    assert spark.createDataFrame([("\\N",)], "v string").select(F.expr(csv_unescape_sql("v"))).first()[0] is None


def _coerce(spark, value, source, target, source_metadata=None, metadata=None):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", source, True, source_metadata or {})]))
    return coerce_columns(df, T.StructType([T.StructField("v", target, True, metadata or {})])).first()[0]


@pytest.mark.parametrize("text,target,expected", [
    ("9223372036854775807", T.LongType(), 9223372036854775807),
    (" 7 ", T.IntegerType(), 7),
    ("1.50", T.DecimalType(38, 9), Decimal("1.5")),
    ("12345678901234567890.50", T.DecimalType(38, 9), Decimal("12345678901234567890.5")),
    ("true", T.BooleanType(), True),
    ("AQID", T.BinaryType(), bytearray(b"\x01\x02\x03")),
    ("2026-09-26T12:34:56.0000000", T.TimestampNTZType(), dt.datetime(2026, 9, 26, 12, 34, 56)),
    ("2026-09-26", T.DateType(), dt.date(2026, 9, 26)),
    ("2026-09-26T00:00:00.0000000", T.DateType(), dt.date(2026, 9, 26)),
    (None, T.DateType(), None),
    (None, T.LongType(), None),
])
def test_text_converts(spark, text, target, expected):
    assert _coerce(spark, text, T.StringType(), target) == expected


@pytest.mark.parametrize("text,target", [
    ("1.5", T.LongType()), ("x", T.LongType()), ("2147483648", T.IntegerType()), ("1e3", T.DecimalType(38, 9)),
    ("1.0000000001", T.DecimalType(38, 9)), ("yes", T.BooleanType()), ("2026", T.TimestampNTZType()), ("2026", T.TimestampType()),
    ("2026-09-26T12:34:56Z", T.TimestampNTZType()), ("2026-09-26T12:34:56.0000001", T.TimestampNTZType()), ("2026-09-26T12:34:56", T.DateType()),
    ("2026-09-26T00:00:00Z", T.DateType()), ("***", T.BinaryType()),
])
def test_text_that_does_not_fit_fails(spark, text, target):
    with pytest.raises(Exception, match="cannot be converted"):
        _coerce(spark, text, T.StringType(), target)


def test_dates_and_local_times(spark):
    day = dt.date(2026, 9, 26)
    midnight = dt.datetime(2026, 9, 26)
    assert _coerce(spark, day, T.DateType(), T.TimestampNTZType()) == midnight
    assert _coerce(spark, midnight, T.TimestampNTZType(), T.DateType()) == day
    with pytest.raises(Exception, match="cannot be converted to date"):
        _coerce(spark, midnight.replace(hour=1), T.TimestampNTZType(), T.DateType())


def test_uuid_forms(spark):
    uuid = {"logical": "uuid"}
    for text in (UUID.upper(), "{" + UUID + "}", UUID.replace("-", "")):
        assert _coerce(spark, text, T.StringType(), T.StringType(), metadata=uuid) == UUID
    with pytest.raises(Exception, match="cannot be converted to uuid"):
        _coerce(spark, "no-uuid", T.StringType(), T.StringType(), metadata=uuid)


def test_fractions_never_vanish(spark):
    wide = T.DecimalType(38, 9)
    assert _coerce(spark, Decimal("12"), wide, T.LongType()) == 12
    for value in ("1.5", "1.000000001"):
        with pytest.raises(Exception, match="cannot be converted"):
            _coerce(spark, Decimal(value), wide, T.LongType())
    with pytest.raises(Exception, match="cannot be converted"):
        _coerce(spark, Decimal("1.005"), T.DecimalType(10, 3), T.DecimalType(10, 2))
    with pytest.raises(Exception, match="cannot be converted"):
        _coerce(spark, 2.5, T.DoubleType(), T.IntegerType())
    df = spark.createDataFrame([(Decimal("1.000000001"),), (Decimal("2"),)], T.StructType([T.StructField("v", wide)]))
    assert [r[0] for r in df.select(loses_fraction("v")).collect()] == [True, False]


@pytest.mark.parametrize("line,ok", [
    ('{"a":1}', True), ('  {"a":1}  ', True), ('{"a":"}]"}', True), ('{"a":[{}]}', True),
    ('{"a":1} tail', False), ("{'a':1}", False), ('{"a":NaN}', False), ('{"a":01}', False), ('{"a":1}{"b":2}', False),
    ("[1]", False), ("null", False), ('{"a":1,}', False), ('{"a":1}]', False), ('{"a":1}] [{}', False), ('{"a":1}} {', False), ("{a:1}", False),
])
def test_only_exact_json_objects_parse(spark, line, ok):
    df = spark.createDataFrame([(line,)], "value string")
    parsed = df.select("value", parse_line("value").alias("parsed"))
    assert parsed.select(one_record("parsed", "value").isNotNull()).first()[0] is ok


def test_plain_and_extended_encoding(spark):
    schema = T.StructType([
        T.StructField("n", T.LongType()), T.StructField("i", T.IntegerType()), T.StructField("d", T.DecimalType(5, 2)),
        T.StructField("t", T.TimestampNTZType()), T.StructField("u", T.StringType(), True, {"logical": "uuid"}),
        T.StructField("b", T.BinaryType()), T.StructField("s", T.StringType()), T.StructField("f", T.BooleanType()),
    ])
    row = (9223372036854775807, 1, Decimal("1.25"), dt.datetime(2026, 9, 26, 12, 34, 56), UUID, b"\x01\x02\x03", 'say "hi"\n', True)
    df = spark.createDataFrame([row, (None,) * 8], schema)
    plain = [r[0] for r in df.select(encode(df.schema.fields)).collect()]
    assert plain[0] == (
        '{"n":9223372036854775807,"i":1,"d":1.25,"t":"2026-09-26T12:34:56","u":"' + UUID + '","b":"AQID","s":"say \\"hi\\"\\n","f":true}'
    )
    assert plain[1] == '{"n":null,"i":null,"d":null,"t":null,"u":null,"b":null,"s":null,"f":null}'
    extended = [r[0] for r in df.select(encode(df.schema.fields, extended=True)).collect()]
    assert extended[0] == (
        '{"n":{"$numberLong":"9223372036854775807"},"i":1,"d":{"$numberDecimal":"1.25"},'
        '"t":{"$date":"2026-09-26T12:34:56.0000000"},"u":{"$uuid":"' + UUID + '"},"b":{"$binary":"AQID"},'
        '"s":"say \\"hi\\"\\n","f":true}'
    )
    assert extended[1] == plain[1]


def test_json_has_no_infinity(spark):
    df = spark.createDataFrame([(float("inf"),)], "v double")
    with pytest.raises(Exception, match="NaN or infinity"):
        df.select(encode(df.schema.fields)).collect()


def test_record_sizes(spark):
    df = spark.createDataFrame([("é日", b"123", 5, None, "")], "a string, b binary, c int, d string, e string")
    assert df.select(record_bytes(df, "sql")).first()[0] == 5 + 3 + 16 + 1 + 1
    assert df.select(record_bytes(df, "file")).first()[0] == 5 + 3 + 16 + 1 + 0
    doc = spark.sql("""SELECT parse_json('{"k":[1,2]}') AS v, parse_json('"é"') AS s, parse_json('5') AS n, parse_json('null') AS z""")
    assert doc.select(record_bytes(doc, "document")).first()[0] == len('{"k":[1,2]}') + 2 + 16 + 1


SCALARS = [
    "1", "-0", "0.5", "-12.50", "1e3", "15e-1", "1.5E-12", "12345678901234567890.123456789", "79228162514264337593543950335",
    "79228162514264337593543950336", "0.0000000001", "true", "false", "null", '"12.5"', '" 7 "', '"1e3"', '"true"', '"x"', '""', '"NaN"',
    '"1.5000000000000"', '"12345678901234567890123456789012345678"', '{"a":1}', "[1]", '{"$date":"x"}',
]


@pytest.mark.parametrize("field", [
    T.StructField("v", T.DecimalType(38, 9), True, {"logical": "json_number"}), T.StructField("v", T.DecimalType(38, 0)),
    T.StructField("v", T.DecimalType(10, 2)), T.StructField("v", T.StringType()),
])
def test_quick_decode_equals_decode(spark, field):
    def read(scalar, quick):
        df = spark.createDataFrame([(scalar,)], "s string").select(F.parse_json("s").alias("x"))
        df = df.select("x", variant_text("x").alias("text"), tagged("x").alias("tag"))
        try:
            return df.select((quick_decode("x", "text", field) if quick else decode("tag", field)).alias("v")).first().v
        except Exception as error:
            return re.search("property 'v': [^\n]*?cannot be converted to [^\n\"]*", str(error))[0]

    for scalar in SCALARS:
        assert read(scalar, True) == read(scalar, False), scalar


def test_usual_values_need_no_type_text(spark):
    """The type of every number used to be written out; now only that of values whose text does not settle it."""
    field = T.StructField("v", T.DecimalType(38, 9), True, {"logical": "json_number"})
    df = spark.sql("SELECT parse_json('1.5') AS x").select("x", variant_text("x").alias("text")).select(quick_decode("x", "text", field).alias("v"))
    text = df._jdf.queryExecution().analyzed().toString()
    assert text.index("try_cast") < text.index("schema_of_variant") and df.first().v == Decimal("1.5")


def test_digits_of_numbers(spark):
    texts = ["0", "-0", "007", "-12.50", "+1.5", "100", "100.00", "0.05", "1e3", "1.5E-7", "12.5e2", "x", "1.", ".5", "1.5\n", "", None]
    whole, part = number_digits_sql("t")
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(whole).alias("w"), F.expr(part).alias("p"))
    assert [(r.w, r.p) for r in df.collect()] == [
        (0, 0), (0, 0), (1, 0), (2, 1), (1, 1), (3, 0), (3, 0), (0, 2), (4, 0), (0, 8), (4, 0), (None, None), (None, None), (None, None),
        (2, 1), (None, None), (None, None),
    ]
