import json

import pytest
from pyspark.sql import types as T

from conftest import rows
from rowhaul.sinks.committed import CommittedTable
from rowhaul.sinks.files import write_records
from rowhaul.sources.files import read_csv
from rowhaul.streaming.incremental import record_stream, start_import


def _run(stream, table, checkpoint, name="s", **options):
    start_import(stream, table, checkpoint, name, create_table=True, **options).awaitTermination()


@pytest.mark.parametrize("fmt", ["jsonl", "extended-json", "csv"])
def test_incremental_import_takes_each_file_once(spark, tmp_path, fmt):
    kind = T.LongType() if fmt == "extended-json" else T.StringType() if fmt == "csv" else T.DecimalType(38, 9)
    schema = T.StructType([T.StructField("id", kind), T.StructField("t", T.StringType())])
    first = spark.createDataFrame([(1, 'a "q"\nb'), (2, None), (3, ""), (4, "\\N")], "id long, t string")
    write_records(first.repartition(4), f"{tmp_path}/in/one", fmt)
    stream = record_stream(spark, f"{tmp_path}/in/*", fmt, schema, max_files=2)
    table = CommittedTable(spark, f"{tmp_path}/t")
    _run(stream, table, f"{tmp_path}/cp")
    assert sorted((int(r.id), r.t) for r in table.read().collect()) == sorted(tuple(r) for r in first.collect())
    commits = table.commits()
    assert len(commits) >= 1
    _run(stream, table, f"{tmp_path}/cp")
    assert table.commits() == commits
    write_records(spark.createDataFrame([(5, "new")], "id long, t string"), f"{tmp_path}/in/two", fmt)
    _run(stream, table, f"{tmp_path}/cp")
    assert table.read().count() == 5


def test_repeated_steps_commit_once(spark, tmp_path):
    write_records(spark.range(0, 100, 1, 4), f"{tmp_path}/in", "extended-json")
    schema = T.StructType([T.StructField("id", T.LongType())])
    table = CommittedTable(spark, f"{tmp_path}/t")
    for attempt in ("a", "b"):  # as if the stream's own checkpoint had been lost
        _run(record_stream(spark, f"{tmp_path}/in", "extended-json", schema), table, f"{tmp_path}/cp-{attempt}")
    assert rows(table.read()) == rows(spark.range(100))


def test_bad_records_stop_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text('{"id":1}\n{"other":2}\n')
    schema = T.StructType([T.StructField("id", T.DecimalType(38, 9))])
    table = CommittedTable(spark, f"{tmp_path}/t")
    with pytest.raises(Exception, match="properties differ"):
        _run(record_stream(spark, f"{tmp_path}/in", "jsonl", schema), table, f"{tmp_path}/cp")
    assert table.read().count() == 0


def test_unknown_stream_format(spark, tmp_path):
    with pytest.raises(ValueError):
        record_stream(spark, str(tmp_path), "xml", T.StructType([T.StructField("id", T.LongType())]))


def test_other_rows_under_a_recorded_step_are_refused(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    table = CommittedTable(spark, f"{tmp_path}/t")
    for name in ("a", "b"):
        write_records(spark.createDataFrame([(ord(name),)], "id long"), f"{tmp_path}/{name}", "extended-json")
    _run(record_stream(spark, f"{tmp_path}/a", "extended-json", schema), table, f"{tmp_path}/cp-a")
    with pytest.raises(Exception, match="already recorded"):
        _run(record_stream(spark, f"{tmp_path}/b", "extended-json", schema), table, f"{tmp_path}/cp-b")
    _run(record_stream(spark, f"{tmp_path}/b", "extended-json", schema), table, f"{tmp_path}/cp-c", name="second")
    assert rows(table.read()) == [(97,), (98,)]


@pytest.mark.parametrize("data,names", [
    (b"a\nx\n\nz\n", ["a"]), (b"a,b\r\n1,2\r\n3,\\N\r\n", ["a", "b"]), (b'a,b\n1,"x\ny"\n2,""\n', ["a", "b"]), (b"a\rx\r\r", ["a"]),
])
def test_csv_steps_follow_the_batch_rules(spark, tmp_path, data, names):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_bytes(data)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    table = CommittedTable(spark, f"{tmp_path}/t")
    _run(record_stream(spark, f"{tmp_path}/in", "csv", schema), table, f"{tmp_path}/cp", mapping={"a": "A"})
    assert table.read().columns == ["A", *names[1:]]
    assert rows(table.read()) == rows(read_csv(spark, f"{tmp_path}/in"))


@pytest.mark.parametrize("data", [b'a,b\n1,"open\n3,x\n', b"a,b\n1,\xff\n", b"a,b\n1\n", b"a,c\n1,2\n"])
def test_bad_csv_stops_the_stream(spark, tmp_path, data):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_bytes(data)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "ab"])
    table = CommittedTable(spark, f"{tmp_path}/t")
    with pytest.raises(Exception):
        _run(record_stream(spark, f"{tmp_path}/in", "csv", schema), table, f"{tmp_path}/cp")
    assert table.read().count() == 0


def test_array_files_arrive_in_steps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps([{"id": 10 * k + i, "t": "}"} for i in range(4)], indent=2))
    schema = T.StructType([T.StructField("id", T.DecimalType(38, 0)), T.StructField("t", T.StringType())])
    table = CommittedTable(spark, f"{tmp_path}/t")
    _run(record_stream(spark, f"{tmp_path}/in", "json", schema, max_files=1), table, f"{tmp_path}/cp")
    assert sorted(int(r.id) for r in table.read().collect()) == [10 * k + i for k in range(3) for i in range(4)]
    assert len(table.commits()) == 3
