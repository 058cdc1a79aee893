import json

import pytest
from pyspark.sql import types as T

from rowhaul.operators.schema import check_names, key_nulls, map_columns, mapped_names, require_columns, require_flat
from rowhaul.sources.query import inspect, inspect_json, sql_query, validate
from rowhaul.types import Capability, create_table_sql, quote_name, sql_type


def test_duplicate_blank_and_missing_names_are_rejected():
    for names in (["id", "id"], ["id", " "], [""], []):
        with pytest.raises(ValueError):
            check_names(names)
    assert check_names(["a", "A"]) == ["a", "A"]
    with pytest.raises(ValueError):
        check_names(["a", "A"], case_sensitive=False)


def test_mapping_matches_case_insensitively_and_ignores_absent_columns():
    assert mapped_names(["Id", "value"], {"ID": "UserId", "other": "x"}) == ["UserId", "value"]


def test_mapping_must_stay_unique(spark):
    df = spark.createDataFrame([(1, "a")], "id int, value string")
    with pytest.raises(ValueError):
        map_columns(df, {"id": "VALUE"})
    with pytest.raises(ValueError):
        map_columns(df, {"id": " "})
    with pytest.raises(ValueError):
        mapped_names(["id"], {"id": "a", "ID": "b"})
    assert map_columns(df, {"id": "VALUE"}, case_sensitive=True).columns == ["VALUE", "value"]


def test_key_columns(spark):
    df = spark.createDataFrame([(None, "a"), ("x", None), (None, None)], "PartitionKey string, RowKey string")
    assert {tuple(r) for r in key_nulls(df, ["PartitionKey", "RowKey"]).collect()} == {("PartitionKey", 2), ("RowKey", 2)}
    with pytest.raises(ValueError, match="id"):
        require_columns(df, ["id"])


def test_identifier_quoting():
    assert quote_name("postgresql", "public", 'odd"name') == '"public"."odd""name"'
    assert quote_name("oracle", "public", 'odd"name') == '"public"."odd""name"'
    assert quote_name("sqlserver", "public", "odd]name") == "[public].[odd]]name]"
    assert quote_name("mysql", "public", "odd]name") == "`public`.`odd]name`"
    assert quote_name("mysql", "a`b") == "`a``b`"


def test_create_table_text():
    schema = T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("flag", T.BooleanType()),
        T.StructField("tiny", T.ShortType(), True, {"logical": "unsigned byte"}),
        T.StructField("price", T.DecimalType(38, 9)),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("token", T.StringType(), True, {"logical": "uuid"}),
        T.StructField("raw", T.BinaryType()),
    ])
    assert create_table_sql("postgresql", ("public", "t"), schema) == (
        'CREATE TABLE "public"."t" ("id" bigint NOT NULL, "flag" boolean, "tiny" smallint, "price" numeric, '
        '"at" timestamp, "token" uuid, "raw" bytea)'
    )
    assert create_table_sql("sqlserver", ("t",), schema) == (
        "CREATE TABLE [t] ([id] bigint NOT NULL, [flag] bit, [tiny] tinyint, [price] decimal(38,18), "
        "[at] datetime2, [token] uniqueidentifier, [raw] varbinary(max))"
    )
    assert create_table_sql("mysql", ("t",), schema) == (
        "CREATE TABLE `t` (`id` bigint NOT NULL, `flag` boolean, `tiny` tinyint unsigned, `price` decimal(65,30), "
        "`at` datetime(6), `token` char(36), `raw` longblob)"
    )
    assert create_table_sql("oracle", ("t",), schema) == (
        'CREATE TABLE "t" ("id" number(19) NOT NULL, "flag" number(1), "tiny" number(3), "price" number, '
        '"at" timestamp, "token" raw(16), "raw" blob)'
    )


@pytest.mark.parametrize("data_type", [T.TimestampType(), T.ArrayType(T.IntegerType()), T.VariantType()])
def test_types_without_a_column_type_are_refused(data_type):
    with pytest.raises(ValueError):
        sql_type("postgresql", T.StructField("x", data_type))


@pytest.mark.parametrize("provider,kind", [("postgresql", "timestamp"), ("sqlserver", "datetime2"), ("mysql", "datetime(6)"), ("oracle", "timestamp")])
def test_dates_are_kept_as_local_times(provider, kind):
    assert sql_type(provider, T.StructField("x", T.DateType())) == kind


def test_nested_columns_are_refused_by_flat_sinks(spark, sf):
    with pytest.raises(ValueError, match="embedding"):
        require_flat(spark.read.parquet(f"{sf}/embeddings.parquet").schema)


def test_inspect_and_validate(spark):
    df = sql_query(spark, "SELECT 1 AS id, CAST('x' AS STRING) AS name WHERE 1 = 0")
    assert validate(df) == 2
    assert [tuple(r) for r in inspect(df).collect()] == [(0, "id", "int", True), (1, "name", "string", True)]
    described = json.loads(inspect_json(df, "postgresql"))
    assert described["Provider"] == "postgresql" and described["Capabilities"] == "OrderedWrites"
    assert described["Columns"][0] == {"Name": "id", "Type": "int", "IsNullable": True}
    with pytest.raises(Exception):
        validate(sql_query(spark, "SELECT * FROM no_such_table"))


def test_query_arguments_are_bound(spark):
    assert sql_query(spark, "SELECT :v AS v", {"v": "a'; --"}).first().v == "a'; --"


def test_capability_names():
    assert str(Capability.NONE) == "None"
    assert str(Capability.NATIVE_BULK | Capability.ORDERED_WRITES) == "NativeBulk, OrderedWrites"
