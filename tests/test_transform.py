from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowhaul.operators.transform import _json_bytes_bound, json_bytes, limit_record_bytes, transform_batches, transform_columns, transform_records


@pytest.fixture()
def before(spark):
    return spark.createDataFrame([("before",), (None,)], "value string")


def test_record_function_gets_arguments(before):
    def _shout(record, arguments):
        if record["value"] is not None:
            record["value"] = record["value"].upper() + arguments["suffix"]

    assert [r.value for r in transform_records(before, _shout, {"suffix": "!"}).collect()] == ["BEFORE!", None]


def test_column_expressions(before):
    out = transform_columns(before, lambda df, a: df.withColumn("value", F.concat(F.upper("value"), F.lit(a["suffix"]))), {"suffix": "!"})
    assert [r.value for r in out.collect()] == ["BEFORE!", None]


def test_adding_or_dropping_a_column_is_rejected(spark, before):
    with pytest.raises(ValueError, match="none more and none fewer"):
        transform_columns(before, lambda df, a: df.withColumn("extra", F.lit(1)))
    with pytest.raises(ValueError, match="none more and none fewer"):
        transform_columns(before, lambda df, a: df.select(F.lit(1).alias("other")))

    def add(record, arguments):
        record["extra"] = 1

    with pytest.raises(Exception, match="none more and none fewer"):
        transform_records(before, add).collect()
    with pytest.raises(Exception, match="none more and none fewer"):
        transform_batches(before, lambda t, a: t.append_column("extra", t["value"])).collect()
    with pytest.raises(Exception, match="one record per record"):
        transform_batches(before.coalesce(1), lambda t, a: t.slice(0, 1)).collect()


def test_values_convert_back_to_their_types(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), True, "x", 2.0)], "i long, d decimal(10,2), b boolean, s string, f double")

    def change(record, arguments):
        record.update(i="42", d="2.25", b="False", s=7, f="0.5")

    assert tuple(transform_records(df, change).first()) == (42, Decimal("2.25"), False, "7", 0.5)
    out = transform_columns(df, lambda d, a: d.withColumns({"i": F.lit("42"), "d": F.lit(2), "s": F.col("i"), "b": F.lit("true")}))
    assert tuple(out.first()) == (42, Decimal("2.00"), True, "1", 2.0) and out.schema == df.schema


@pytest.mark.parametrize("value", ["x", "1.5", 1.5])
def test_values_that_do_not_convert_fail(spark, value):
    def change(record, arguments):
        record["i"] = value

    with pytest.raises(Exception, match="cannot be converted"):
        transform_records(spark.createDataFrame([(1,)], "i long"), change).collect()


def test_nulls_and_large_integers_pass_python(spark):
    df = spark.createDataFrame([(9007199254740993, None), (None, "x")], "n long, s string")
    assert transform_records(df, lambda r, a: None).collect() == df.collect()
    assert transform_batches(df, lambda t, a: t).collect() == df.collect()


def test_record_size_limit(spark):
    df = spark.createDataFrame([("a" * 50,)], "value string")
    assert limit_record_bytes(df, 62).count() == 1
    with pytest.raises(Exception, match="size limit"):
        limit_record_bytes(df, 61).collect()


def test_size_bound_never_falls_short(spark):
    worst = chr(1) * 40 + '"' * 40 + "日" * 40
    df = spark.createDataFrame([(worst, bytearray(range(50)), -(2**63), None)], "t string, b binary, n long, z string")
    exact = df.select(json_bytes(df)).first()[0]
    assert df.select(_json_bytes_bound(df)).first()[0] >= exact
    assert limit_record_bytes(df, exact).count() == 1
    with pytest.raises(Exception, match="size limit"):
        limit_record_bytes(df, exact - 1).collect()
