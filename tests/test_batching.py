from functools import reduce

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rowhaul.functions.sizes import record_bytes
from rowhaul.operators.batching import (
    BATCH, POSITION, batch_by_rows, batch_rows_and_bytes, batch_table, number_rows, oversize, partition_chunks, reject_oversize,
    resplit_batches,
)
from rowhaul.operators.greedy import advance, compose, cut, summarise
from rowhaul.operators.transform import json_bytes


def serial(sizes, rows, cap):
    """One pass, one row at a time: the definition that the parallel form must equal."""
    out, held_rows, held, batch = [], 0, 0, -1
    for size in sizes:
        if held_rows == 0 or held_rows >= rows or held + size > cap:
            batch, held_rows, held = batch + 1, 0, 0
        held_rows, held = held_rows + 1, held + size
        out.append(batch)
    return out


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_segments_cut_like_one_pass(data):
    cap, rows = data.draw(st.integers(1, 30)), data.draw(st.integers(1, 12))
    sizes = data.draw(st.lists(st.integers(0, cap), min_size=1, max_size=80))
    edges = sorted(data.draw(st.sets(st.integers(1, len(sizes)), max_size=8)) | {len(sizes)})
    segments = [np.array(sizes[a:b]) for a, b in zip([0, *edges], edges)]
    summaries = [summarise(s, rows, cap) for s in segments]
    held_rows, held, batch, got = 0, 0, -1, []
    for sizes_, summary in zip(segments, summaries):
        after = [int(v) for v in advance(summary, np.int64(held_rows), np.int64(held), rows, cap)]
        started, held_rows, held = cut(sizes_, held_rows, held, rows, cap)
        got += list(batch + started)
        batch += int(started[-1])
        assert after == [held_rows, held, int(started[-1])]
    assert got == serial(sizes, rows, cap)
    whole = reduce(lambda a, b: compose(a, b, rows, cap), summaries)
    assert [int(v) for v in advance(whole, np.int64(0), np.int64(0), rows, cap)] == [held_rows, held, batch + 1]
    assert len(whole.exit_rows) <= rows


@pytest.mark.parametrize("segment_rows,block_segments", [(1 << 20, 256), (37, 4), (1, 3), (200, 1)])
def test_byte_batches_equal_one_pass(spark, sf, segment_rows, block_segments):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(4)
    numbered = number_rows(docs, ["doc_id"], unique_order=True)
    out = batch_rows_and_bytes(numbered, 20, 40_000, segment_rows, block_segments)
    got = [(r.doc_id, r[BATCH]) for r in out.select("doc_id", BATCH).orderBy("doc_id").collect()]
    sizes = [r[0] for r in docs.orderBy("doc_id").select(record_bytes(docs)).collect()]
    assert [b for _, b in got] == serial(sizes, 20, 40_000)


def test_numbering_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k"), F.lit("x").alias("v"))
        numbered = number_rows(df, ["k"], unique_order=True)
        assert len(numbered.parts) == 8 and numbered.total == 10_000
        ranks = [r[0] for r in numbered.rows().orderBy("k").select(POSITION).collect()]
        assert ranks == list(range(10_000))
        middle = numbered.between(2500, 7500)
        keys = sorted(r.k for r in df.select("k").collect())
        assert sorted(r.k for r in middle.select("k").collect()) == keys[2500:7500]
        assert middle.columns == ["k", "v"] and numbered.between(5, 5).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_frequent_key_keeps_arrival_order_and_spreads(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 20_000, 1, 4).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
        numbered = number_rows(df, ["k"])
        assert max(n for _, n, _ in numbered.parts) < 8000  # four fifths of the rows share one key
        got = numbered.rows().orderBy(POSITION).select("id", "k").collect()
        assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_without_order_rows_keep_partition_order(spark):
    numbered = number_rows(spark.range(0, 1000, 1, 5))
    got = batch_by_rows(numbered, 300).orderBy("id").select(POSITION, BATCH).collect()
    assert [r[0] for r in got] == list(range(1000)) and [r[1] for r in got] == [i // 300 for i in range(1000)]


def test_empty_input(spark):
    numbered = number_rows(spark.range(0), ["id"], unique_order=True)
    assert numbered.total == 0 and batch_rows_and_bytes(numbered, 10, 100).count() == 0 and batch_table(numbered).count() == 0


def test_batch_table(spark):
    df = spark.createDataFrame([(i, "x" * (10 * (i % 5))) for i in range(100)], "id long, t string")
    numbered = number_rows(df, ["id"], unique_order=True)
    sizes = [16 + max(1, 10 * (i % 5)) for i in range(100)]
    batches = serial(sizes, 7, 200)
    got = [tuple(r) for r in batch_table(numbered, 7, 200).orderBy("batch").collect()]
    for batch, first, rows, total in got:
        assert [b for b in batches].index(batch) == first and batches.count(batch) == rows
        assert total == sum(s for s, b in zip(sizes, batches) if b == batch) <= 200
    assert len(got) == batches[-1] + 1


def test_filters_do_not_change_batch_numbers(spark):
    df = spark.createDataFrame([(i, "x" * 50) for i in range(200)], "id long, t string")
    out = batch_rows_and_bytes(number_rows(df, ["id"], unique_order=True), 100, 400)
    everything = {r.id: r[BATCH] for r in out.collect()}
    assert {r.id: r[BATCH] for r in out.where("id % 3 = 0").collect()} == {k: v for k, v in everything.items() if k % 3 == 0}


def test_oversize_records(spark):
    df = spark.createDataFrame([("a" * 10,), ("b" * 100,)], "t string")
    assert [r.t[0] for r in oversize(df, 50).collect()] == ["b"]
    assert reject_oversize(df, 100).count() == 2
    with pytest.raises(Exception, match="more than max_batch_bytes"):
        reject_oversize(df, 50).collect()
    with pytest.raises(ValueError, match="more than max_batch_bytes"):
        batch_rows_and_bytes(number_rows(df), 10, 50)


def test_limits_and_reserved_names(spark):
    numbered = number_rows(spark.range(3))
    for rows, size in ((0, 10), (10, 0)):
        with pytest.raises(ValueError):
            batch_rows_and_bytes(numbered, rows, size)
    with pytest.raises(ValueError, match="reserved"):
        number_rows(spark.range(3).withColumnRenamed("id", BATCH))


def test_chunks_stay_inside_batch_and_key(spark):
    df = spark.range(0, 1000, 1, 3).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("PartitionKey"))
    out = partition_chunks(batch_by_rows(number_rows(df, ["id"], unique_order=True), 500), "PartitionKey")
    sizes = {(r[BATCH], r.PartitionKey, r.chunk): r["count"] for r in out.groupBy(BATCH, "PartitionKey", "chunk").count().collect()}
    assert max(sizes.values()) == 100
    assert sizes[(0, "hot", 4)] == 50 and sizes[(1, "rare", 0)] == 50


def test_transformed_records_are_split_again(spark):
    df = spark.createDataFrame([("a" * 50,), ("b" * 50,)], "value string").coalesce(1)
    batched = batch_by_rows(number_rows(df), 10)
    size = json_bytes(batched.select("value"))
    out = resplit_batches(batched, size, 75).groupBy("split").agg(F.sum(size).alias("bytes")).orderBy("split").collect()
    assert [r.split for r in out] == [0, 1] and all(50 <= r.bytes <= 75 for r in out)
    with pytest.raises(Exception, match="size limit"):
        resplit_batches(batched, size, 40).collect()
