"""What the plans may and may not contain, whatever the size of the data."""

import re

import pytest
from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry_points
from rowhaul.operators.batching import batch_by_rows, batch_rows_and_bytes, batch_table, number_rows, partition_chunks
from rowhaul.operators.transform import transform_columns
from rowhaul.sinks.collections import key_conflicts
from rowhaul.sinks.files import json_lines, write_records
from rowhaul.sources.files import _digits_needed, read_jsonl
from rowhaul.sources.query import register_tables, sql_query


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


@pytest.fixture(scope="module")
def numbered(events):
    return number_rows(events, ["event_id"], unique_order=True)


def test_query_text_is_pushed_down(spark, sf):
    register_tables(spark, {"events": f"{sf}/events.parquet"})
    text = plan(sql_query(spark, "SELECT user_id FROM events WHERE event_type = 'click' AND user_id > 3"))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(user_id), EqualTo(event_type,click), GreaterThan(user_id,3)]" in text
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string>", text)


def test_row_batches_neither_shuffle_nor_leave_the_jvm(numbered):
    text = plan(batch_by_rows(numbered, 100))
    assert "Exchange" not in text.replace("BroadcastExchange", "") and "Python" not in text and "Window" not in text


def test_commit_ranges_read_only_their_rows(numbered):
    text = plan(numbered.between(100, 200))
    assert "PushedFilters: [IsNotNull(_row), GreaterThanOrEqual(_row,100), LessThan(_row,200)]" in text


def test_byte_batches_cut_over_narrow_columns(numbered):
    text = plan(batch_rows_and_bytes(numbered, 100, 3000, segment_rows=100, columns=[]))
    assert re.search(r"ArrowEvalPython \[number\(_segment#\d+L, _bytes#\d+L, held_rows#\d+L, held_bytes#\d+L, open_batch#\d+L\)", text)
    assert text.replace("BroadcastExchange", "").count("Exchange hashpartitioning") == 1
    assert "props" not in text


def test_byte_batches_move_no_whole_row(numbered):
    text = plan(batch_rows_and_bytes(numbered, 100, 3000))
    assert "props" in text and "Exchange" not in text.replace("BroadcastExchange", "") and "Python" not in text


def test_many_batch_edges_are_not_broadcast(spark, numbered):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batched = batch_rows_and_bytes(numbered, 100, 3000)
        assert "SortMergeJoin [_stretch" in plan(batched)
        assert batched.count() == numbered.total
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_batch_table_reads_no_payload(numbered):
    text = plan(batch_table(numbered, 100, 3000))
    for column in ("props", "event_type", "value"):
        assert column not in text


def test_filters_of_batched_rows_reach_the_scan(numbered):
    text = plan(batch_rows_and_bytes(numbered, 100, 3000).where("user_id = 3"))
    assert "EqualTo(user_id,3)" in text


def test_chunk_windows_are_bounded_by_the_batch(numbered):
    text = plan(partition_chunks(batch_by_rows(numbered, 100), "event_type"))
    assert re.search(r"hashpartitioning\(_batch#\d+L, event_type#\d+", text)


def test_key_check_combines_before_the_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(key_conflicts(orders, orders, ["o_custkey"]))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text and "Join" not in text
    assert "o_totalprice" not in text


def test_encode_and_native_transforms_stay_in_the_jvm(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    changed = transform_columns(customers, lambda df, a: df.withColumn("c_name", F.upper("c_name")))
    text = plan(json_lines(changed, extended=True))
    assert "Python" not in text and "Exchange" not in text


def test_json_lines_parse_once_and_split(spark, events, tmp_path):
    write_records(events, f"{tmp_path}/out", "extended-json")
    text = plan(read_jsonl(spark, f"{tmp_path}/out", extended=True))
    assert text.count("from_json") == 1 and "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_query_multiplies_rows(spark, sf, name):
    text = plan(entry_points.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_digits_of_numbers_take_one_expression_however_many_columns(spark):
    """Each column used to bring patterns of its own: eight made a method that the JVM only interprets."""
    values = spark.sql("SELECT transform(sequence(1, 8), i -> parse_json('1.5')) AS record_values")
    needed = _digits_needed(values, list(range(8)), False)
    text = needed._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= len(re.findall("variant_get", text, re.I)) <= 2
    assert sorted(map(tuple, needed.collect())) == [(i, 1, 1) for i in range(8)]
