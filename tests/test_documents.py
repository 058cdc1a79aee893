import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowhaul.functions.documents import json_value, kind, to_bson
from rowhaul.plans.jobs import load
from rowhaul.sinks.collections import DocumentCollection
from rowhaul.sources.documents import document_scan, first_document_names, public_connector_options, read_documents


def _docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n long, value string")


def _texts(df):
    return rows(df.select(*[F.try_variant_get(c, "$", "string").alias(c) for c in df.columns]))


def test_first_document_fixes_the_columns(spark):
    docs = _docs(spark, '{"b":1,"a":"x"}', '{"a":"y","late":true}', '{"b":null,"a":{"k":[1]}}')
    scan = document_scan(docs, order_by=["n"])
    assert scan.columns == ["b", "a"]
    got = scan.select(F.to_json("b").alias("b"), F.to_json("a").alias("a")).collect()
    assert sorted((r.b, r.a) for r in got if r.b) == [("1", '"x"')]
    assert {(r.b, r.a) for r in got} == {("1", '"x"'), (None, '"y"'), (None, '{"k":[1]}')}


def test_empty_results_have_the_key_columns(spark):
    docs = _docs(spark, '{"a":1}')
    none = "try_variant_get(doc, '$.a', 'int') = 2"
    assert document_scan(docs, "cosmosdb", none, ["n"]).columns == ["id"]
    assert document_scan(docs, "mongodb", none, ["n"]).columns == ["_id"]
    assert document_scan(docs, "azure-table-storage", none, ["n"]).columns == ["PartitionKey", "RowKey"]


def test_table_keys_come_first(spark):
    docs = _docs(spark, '{"v":1,"RowKey":"r","PartitionKey":"p"}')
    assert document_scan(docs, "azure-table-storage", order_by=["n"]).columns == ["PartitionKey", "RowKey", "v"]


def test_predicate_decides_the_first_document(spark):
    docs = _docs(spark, '{"s":"closed","x":1}', '{"s":"open","id":"2"}', '{"s":"open","y":1}')
    scan = document_scan(docs, predicate="try_variant_get(doc, '$.s', 'string') = 'open'", order_by=["n"])
    assert scan.columns == ["s", "id"] and scan.count() == 2


def test_collections_of_text_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"1"}\n\n{"id":"2","v":1}\n')
    docs = read_documents(spark, str(tmp_path))
    assert first_document_names(docs) == ["id"] and _texts(document_scan(docs)) == [("1",), ("2",)]
    with pytest.raises(ValueError, match="order_by"):
        document_scan(_docs(spark, '{"a":1}'))
    with pytest.raises(Exception, match="not a JSON document"):
        document_scan(_docs(spark, '{"a":1}', "oops"), order_by=["n"]).collect()


def test_json_typing(spark):
    values = ["null", "5", "5.25", "1e3", '"text"', '"2026-09-26"', '"2026-09-26T12:34:56+02:00"', '"2026"', "true", "[1]", '{"k":1}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, t string").select("i", F.parse_json("t").alias("v"))
    typed = df.select("i", json_value(F.col("v")).alias("v"))
    kinds = [r.k for r in typed.select("i", kind(F.col("v")).alias("k")).orderBy("i").collect()]
    assert kinds == ["null", "long", "decimal", "decimal", "text", "instant", "instant", "text", "boolean", "json", "json"]
    plain = df.select("i", json_value(F.col("v"), dates=False).alias("v"))
    assert [r.k for r in plain.orderBy("i").select(kind(F.col("v")).alias("k")).collect()][5:7] == ["text", "text"]
    instant = typed.where("i = 6").select(F.try_variant_get("v", "$", "timestamp").cast("string")).first()[0]
    assert instant == "2026-09-26 10:34:56"


def test_bson_typing_on_write(spark):
    at = dt.datetime(2026, 9, 26, 12, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [('{"a":1}', "[1]", "{oops", 'x', None, at)], "o string, l string, b string, s string, z string, t timestamp"
    )
    out = df.select(*[to_bson(f).alias(f.name) for f in df.schema.fields])
    kinds = out.select(*[kind(F.col(c)).alias(c) for c in out.columns]).first()
    assert tuple(kinds) == ("json", "json", "text", "text", "null", "json")
    assert out.select(F.to_json("t")).first()[0] == '{"$date":"2026-09-26T12:00:00.000000Z"}'


def _load(df, target, **options):
    return load(df, target, transaction="none", **options)


def test_cosmos_round_trip_and_insert_only(spark, tmp_path):
    target = DocumentCollection(spark, f"{tmp_path}/c", "cosmosdb")
    df = spark.createDataFrame([("one", "alpha"), ("two", None)], "id string, value string")
    with pytest.raises(ValueError, match="does not exist"):
        _load(df, target)
    assert _load(df, target, create_table=True).written == 2
    assert _texts(document_scan(target.documents(), order_by=["id"])) == rows(df)
    _load(spark.createDataFrame([("three", "x")], "id string, value string"), target, create_table=True)  # created if absent
    with pytest.raises(ValueError, match="existing key"):
        _load(spark.createDataFrame([("four", "x"), ("one", "y")], "id string, value string"), target)
    with pytest.raises(ValueError, match="repeated key"):
        _load(spark.createDataFrame([("five", "x"), ("five", "y")], "id string, value string"), target)
    with pytest.raises(ValueError, match="null key"):
        _load(spark.createDataFrame([(None, "x")], "id string, value string"), target)
    assert target.documents().count() == 3
    with pytest.raises(ValueError, match="require id"):
        _load(spark.createDataFrame([("x",)], "key string"), target)
    _load(spark.createDataFrame([("six",)], "key string"), target, mapping={"key": "id"})
    with pytest.raises(ValueError, match="unique"):
        _load(spark.createDataFrame([("x", "y")], "id string, b string"), target, mapping={"b": "id"})


def test_mongo_round_trip(spark, tmp_path):
    target = DocumentCollection(spark, f"{tmp_path}/m", "mongodb")
    at = dt.datetime(2026, 9, 26, 12, 34, 56, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame(
        [("one", 2**60, Decimal("1.25"), at, '{"k":1}'), ("two", None, None, None, None)],
        "_id string, n long, d decimal(10,2), t timestamp, j string",
    )
    _load(df, target, create_table=True)
    scan = document_scan(target.documents(), "mongodb", order_by=["_id"])
    got = scan.select(
        F.try_variant_get("_id", "$", "string"), F.try_variant_get("n", "$", "long"), F.try_variant_get("d", "$", "decimal(10,2)"),
        F.try_variant_get("t", "$", "timestamp"), F.try_variant_get("j", "$", "string"),
    )
    assert rows(got) == rows(df)
    generated = DocumentCollection(spark, f"{tmp_path}/g", "mongodb")
    _load(df.drop("_id"), generated, create_table=True)
    assert generated.documents().where("length(_id) = 24").select("_id").distinct().count() == 2


def test_table_store_round_trip(spark, tmp_path):
    target = DocumentCollection(spark, f"{tmp_path}/t", "azure-table-storage")
    df = spark.createDataFrame(
        [("partition", "one", "alpha", 7, "x"), ("partition", "two", None, None, "y")],
        "PartitionKey string, RowKey string, Value string, Small short, Timestamp string",
    )
    _load(df, target, create_table=True)
    scan = document_scan(target.documents(), "azure-table-storage", order_by=["PartitionKey", "RowKey"])
    assert scan.columns == ["PartitionKey", "RowKey", "Value", "Small"]
    assert _texts(scan) == [("partition", "one", "alpha", "7"), ("partition", "two", None, None)]
    with pytest.raises(ValueError, match="existing key"):
        _load(df.limit(1), target)
    with pytest.raises(ValueError, match="RowKey"):
        _load(df.drop("RowKey"), target)


def test_repeated_commit_adds_nothing(spark, tmp_path):
    target = DocumentCollection(spark, f"{tmp_path}/c", "cosmosdb")
    df = spark.createDataFrame([("one",)], "id string")
    target.prepare(df.schema, True)
    target.write(df, "step-1")
    target.write(df, "step-1")
    assert target.documents().count() == 1


def test_public_connector_options():
    name, options = public_connector_options("mongodb", uri="mongodb://h", database="d", collection="c", filter='{"a": 1}')
    assert name == "mongodb" and options["aggregation.pipeline"] == '[{"$match": {"a": 1}}]'
    name, options = public_connector_options("cosmosdb", endpoint="e", key="k", database="d", collection="c", query="SELECT * FROM c")
    assert name == "cosmos.oltp" and options["spark.cosmos.write.strategy"] == "ItemAppend"
    with pytest.raises(ValueError):
        public_connector_options("azure-table-storage")
