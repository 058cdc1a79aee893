import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rowhaul import storage
from rowhaul.plans.checkpoint import CheckpointStore, TransferCheckpoint, plan_fingerprint
from rowhaul.plans.jobs import copy, exec_query, export_records, import_records
from rowhaul.plans.results import TransferResult, WriteStatus, transfer_progress, transfer_result
from rowhaul.sinks.committed import CommittedTable
from rowhaul.sinks.collections import DocumentCollection
from rowhaul.sources.files import read_records


class Broken(Exception):
    pass


class Recording(CommittedTable):
    """Counts writes and breaks after a given number of them, before or after the commit."""

    def __init__(self, spark, path, allowed=None, after_commit=False):
        super().__init__(spark, path)
        self.allowed, self.after_commit, self.written, self.prepared = allowed, after_commit, [], []

    def prepare(self, schema, create):
        self.prepared.append(create)
        super().prepare(schema, create)

    def write(self, df, commit, info=None):
        if self.allowed is not None and len(self.written) >= self.allowed:
            if self.after_commit:
                super().write(df, commit, info)
            raise Broken
        self.written.append((commit, info))
        super().write(df, commit, info)


@pytest.fixture()
def source(spark):
    spark.range(0, 100, 1, 3).select("id", F.concat(F.lit("v"), "id").alias("value")).createOrReplaceTempView("source_rows")
    return "SELECT id, value FROM source_rows"


def test_checkpoint_store(spark, tmp_path):
    store = CheckpointStore(spark, f"{tmp_path}/a/cp.json")
    assert store.load() is None
    mark = TransferCheckpoint(2, 25, "next", "plan")
    store.save(mark)
    store.save(mark)
    assert store.load() == mark
    assert not [n for n in storage.list_names(spark, f"{tmp_path}/a") if "tmp" in n]
    store.delete()
    assert store.load() is None


def test_fingerprint_follows_the_plan():
    base = plan_fingerprint(query="select 1", batch_rows=100)
    assert base == plan_fingerprint(batch_rows=100, query="select 1") and len(base) == 64
    assert base != plan_fingerprint(query="select 2", batch_rows=100) != plan_fingerprint(query="select 1", batch_rows=101)


def test_three_batches_three_commits(spark, source, tmp_path):
    table = Recording(spark, f"{tmp_path}/t")
    result = copy(spark, source, table, create_table=True, order_by=["id"], unique_order=True, batch_rows=40, batches_per_commit=1)
    assert result == TransferResult(100, 100, WriteStatus.SUCCEEDED)
    assert [i["rows"] for _, i in table.written] == [40, 40, 20]
    assert rows(table.read()) == rows(spark.sql(source))


def test_resume_after_failure(spark, source, tmp_path):
    options = dict(create_table=True, order_by=["id"], unique_order=True, checkpoint=f"{tmp_path}/cp", batch_rows=10, batches_per_commit=2)
    with pytest.raises(Broken):
        copy(spark, source, Recording(spark, f"{tmp_path}/t", allowed=2), **options)
    saved = json.load(open(f"{tmp_path}/cp"))
    assert (saved["batches"], saved["rows"]) == (4, 40)
    assert CommittedTable(spark, f"{tmp_path}/t").read().count() == 40
    again = Recording(spark, f"{tmp_path}/t")
    assert copy(spark, source, again, resume=True, **options) == TransferResult(100, 100)
    assert len(again.written) == 3 and again.prepared == [False]
    assert rows(again.read()) == rows(spark.sql(source))
    assert not storage.exists(spark, f"{tmp_path}/cp") and not storage.exists(spark, f"{tmp_path}/cp.rows")


def test_commit_without_its_marker_is_not_repeated(spark, source, tmp_path):
    options = dict(create_table=True, order_by=["id"], unique_order=True, checkpoint=f"{tmp_path}/cp", batch_rows=10, batches_per_commit=2)
    with pytest.raises(Broken):
        copy(spark, source, Recording(spark, f"{tmp_path}/t", allowed=1, after_commit=True), **options)
    assert json.load(open(f"{tmp_path}/cp"))["batches"] == 2 and CommittedTable(spark, f"{tmp_path}/t").read().count() == 40
    table = CommittedTable(spark, f"{tmp_path}/t")
    copy(spark, source, table, resume=True, **options)
    assert rows(table.read()) == rows(spark.sql(source))


def test_other_plan_is_refused_before_the_sink_is_touched(spark, source, tmp_path):
    CheckpointStore(spark, f"{tmp_path}/cp").save(TransferCheckpoint(1, 10, None, "old-plan"))
    table = Recording(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError, match="left by another transfer"):
        copy(spark, source, table, create_table=True, checkpoint=f"{tmp_path}/cp", resume=True)
    assert table.prepared == [] and not table.exists()


def test_resume_of_an_empty_source_suppresses_create(spark, tmp_path):
    options = dict(create_table=True, checkpoint=f"{tmp_path}/cp")
    with pytest.raises(Broken):
        copy(spark, "SELECT id FROM range(5)", Recording(spark, f"{tmp_path}/t", allowed=0), **options)
    assert copy(spark, "SELECT id FROM range(0)", Recording(spark, f"{tmp_path}/e"), create_table=True) == TransferResult(0, 0)


@pytest.mark.parametrize("options", [
    dict(resume=True), dict(checkpoint="x", transaction="none"), dict(checkpoint="x", transaction="all"), dict(transaction="some"),
])
def test_scopes_that_make_no_sense(spark, source, tmp_path, options):
    table = Recording(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError):
        copy(spark, source, table, create_table=True, **options)
    assert table.prepared == []


@pytest.mark.parametrize("store", ["cosmosdb", "mongodb", "azure-table-storage"])
@pytest.mark.parametrize("scope", ["batch", "all"])
def test_document_stores_refuse_transactions(spark, source, tmp_path, store, scope):
    with pytest.raises(ValueError, match="does not support"):
        copy(spark, source, DocumentCollection(spark, f"{tmp_path}/c", store), create_table=True, transaction=scope)


@pytest.mark.parametrize("scope", ["none", "all"])
def test_single_commit_scopes(spark, source, tmp_path, scope):
    table = Recording(spark, f"{tmp_path}/t")
    assert copy(spark, source, table, create_table=True, transaction=scope) == TransferResult(100, 100)
    assert len(table.written) == 1 and rows(table.read()) == rows(spark.sql(source))


@pytest.mark.parametrize("scope", ["none", "all"])
def test_failure_leaves_nothing_behind(spark, tmp_path, scope):
    table = CommittedTable(spark, f"{tmp_path}/t")
    text = "SELECT id, if(id = 90, raise_error('lost'), 'x') AS v FROM range(0, 100, 1, 4)"
    with pytest.raises(Exception, match="lost"):
        copy(spark, text, table, create_table=True, transaction=scope)
    assert table.read().count() == 0


def test_tables_are_created_once_and_checked(spark, source, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError, match="does not exist"):
        copy(spark, source, table)
    copy(spark, source, table, create_table=True)
    with pytest.raises(ValueError, match="already exists"):
        copy(spark, source, table, create_table=True)
    copy(spark, source, table)
    assert table.read().count() == 200
    with pytest.raises(ValueError, match="no column"):
        copy(spark, "SELECT 1 AS other", table)
    copy(spark, "SELECT '7' AS ID", table)
    assert table.read().where("id = 7 AND value IS NULL").count() == 1
    with pytest.raises(Exception, match="cannot be converted"):
        copy(spark, "SELECT 'x' AS id", table)


def test_mapping_in_a_copy(spark, source, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t")
    copy(spark, source, table, mapping={"VALUE": "Name"}, create_table=True, batch_rows=30, batches_per_commit=1)
    assert table.read().columns == ["id", "Name"]
    with pytest.raises(ValueError, match="unique"):
        copy(spark, source, CommittedTable(spark, f"{tmp_path}/u"), mapping={"value": "ID"}, create_table=True)


def test_byte_limit_moves_commit_edges(spark, tmp_path):
    spark.range(0, 50, 1, 1).select("id", F.repeat(F.lit("x"), (F.col("id") % 7).cast("int") * 10).alias("t")).createOrReplaceTempView("sized")
    table = Recording(spark, f"{tmp_path}/t")
    copy(spark, "SELECT * FROM sized", table, create_table=True, order_by=["id"], unique_order=True, batch_rows=10, max_batch_bytes=200, batches_per_commit=3)
    assert table.read().count() == 50 and len(table.written) > 3
    with pytest.raises(ValueError, match="more than max_batch_bytes"):
        copy(spark, "SELECT * FROM sized", CommittedTable(spark, f"{tmp_path}/u"), create_table=True, max_batch_bytes=30)
    with pytest.raises(Exception, match="more than max_batch_bytes"):
        copy(spark, "SELECT * FROM sized", CommittedTable(spark, f"{tmp_path}/v"), create_table=True, max_batch_bytes=30, transaction="all")


def test_unicode_and_nulls_survive_a_copy(spark, tmp_path):
    spark.createDataFrame([(1, "alpha"), (2, None), (3, "日本語")], "id int, value string").createOrReplaceTempView("small")
    table = CommittedTable(spark, f"{tmp_path}/t")
    assert copy(spark, "SELECT * FROM small", table, create_table=True, batch_rows=2, batches_per_commit=1).written == 3
    assert rows(table.read()) == rows(spark.table("small"))


def test_export_transform_import(spark, source, tmp_path):
    result = export_records(
        spark, source, f"{tmp_path}/out", "extended-json", transform=lambda df: df.withColumn("value", F.upper("value")), order_by=["id"]
    )
    assert result == TransferResult(100, 100)
    table = CommittedTable(spark, f"{tmp_path}/t")
    back = import_records(
        spark, f"{tmp_path}/out", "extended-json", table, transform=lambda df: df.withColumn("id", F.col("id") + 1),
        mapping={"value": "Name"}, create_table=True,
    )
    assert back.written == 100 and rows(table.read()) == sorted(((i + 1, f"V{i}") for i in range(100)), key=repr)
    with pytest.raises(Exception, match="size limit"):
        export_records(spark, source, f"{tmp_path}/big", "jsonl", transform=lambda df: df.withColumn("value", F.repeat("value", 50)), max_batch_bytes=60)


def test_exec(spark, source, tmp_path):
    assert exec_query(spark, source, f"{tmp_path}/out", "csv").read == 100
    assert read_records(spark, f"{tmp_path}/out", "csv").count() == 100
    with pytest.raises(Exception):
        exec_query(spark, source, f"{tmp_path}/out", "csv")
    exec_query(spark, source, f"{tmp_path}/out", "csv", mode="overwrite")


def test_results_stop_at_the_first_failure(spark):
    batches = spark.createDataFrame(
        [(0, 10, 10, "Succeeded"), (1, 10, 4, "Failed"), (2, 10, 10, "Succeeded")], "batch long, read long, written long, status string"
    )
    assert tuple(transfer_result(batches).first()) == (20, 14, "Failed")
    assert tuple(transfer_result(batches.where("batch <> 1")).first()) == (20, 20, "Succeeded")
    assert tuple(transfer_result(batches.limit(0)).first()) == (0, 0, "Succeeded")


def test_progress(spark):
    batches = spark.createDataFrame([(i, i * 4, 4) for i in range(10)], "batch long, first long, rows long")
    assert [r.written for r in transfer_progress(batches, 10).orderBy("batch").collect()] == [12, 20, 32, 40]
    assert [r.written for r in transfer_progress(batches, 3).orderBy("batch").collect()] == [4, 8, 12, 16, 20, 24, 28, 32, 36, 40]
    assert transfer_progress(batches, 0).count() == 0
    with pytest.raises(ValueError):
        transfer_progress(batches, -1)


def test_shared_folder_comes_from_the_session(spark):
    assert storage.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("lost", ["_SUCCESS", "part-"])
def test_resume_needs_the_whole_numbered_copy(spark, source, tmp_path, lost):
    options = dict(create_table=True, order_by=["id"], unique_order=True, checkpoint=f"{tmp_path}/cp", batch_rows=10, batches_per_commit=2)
    with pytest.raises(Broken):
        copy(spark, source, Recording(spark, f"{tmp_path}/t", allowed=2), **options)
    for path in (tmp_path / "cp.rows").iterdir():
        if path.name.startswith(lost):
            path.unlink()
    table = CommittedTable(spark, f"{tmp_path}/t")
    if lost == "_SUCCESS":  # committers need not write it
        copy(spark, source, table, resume=True, **options)
        assert rows(table.read()) == rows(spark.sql(source))
    else:
        with pytest.raises(ValueError, match="start the transfer anew"):
            copy(spark, source, table, resume=True, **options)


def test_imports_follow_the_files_by_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    sizes = {"1": 30, "2": 400, "3": 120, "4": 1}
    want = []
    for name, n in sizes.items():
        ids = [f"{name}-{k:04d}" for k in range(n)]
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join(json.dumps({"id": i, "t": "x" * (len(i) * 7)}) + "\n\n" for i in ids))
        want += ids
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("2000", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            table = CommittedTable(spark, f"{tmp_path}/t{size}")
            import_records(spark, f"{tmp_path}/in", "jsonl", table, create_table=True, batch_rows=100, batches_per_commit=1)
            staged = table.staged_rows(table.commits()[0].split("-")[1])
            assert [r.id for r in staged.orderBy("place").collect()] == want
            result = import_records(spark, f"{tmp_path}/in", "jsonl", CommittedTable(spark, f"{tmp_path}/s{size}"), create_table=True, batch_rows=100, batches_per_commit=1, stop_after=3)
            assert (result.read, result.written) == (300, 300)
            assert sorted(r.id for r in CommittedTable(spark, f"{tmp_path}/s{size}").read().collect()) == want[:300]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_staged_rows_are_written_once(spark, source, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t")
    told = []
    result = copy(
        spark, source, table, create_table=True, order_by=["id"], unique_order=True, batch_rows=10, batches_per_commit=2, stop_after=3,
        progress=told.append, progress_interval=40,
    )
    assert result == TransferResult(60, 60) and [p.written for p in told] == [40]
    assert sorted(r.id for r in table.read().collect()) == list(range(60)) and len(storage.list_names(spark, f"{tmp_path}/t/data")) == 1
    copy(spark, source, table, batch_rows=30, batches_per_commit=1)
    assert table.read().count() == 160
    with pytest.raises(Exception, match="cannot be converted"):
        copy(spark, "SELECT 'x' AS id", table)
    assert len(storage.list_names(spark, f"{tmp_path}/t/data")) == 2 and table.read().count() == 160


def test_a_failed_run_says_what_it_wrote(spark, source, tmp_path):
    text = "SELECT id, if(id < 55, CAST(id AS STRING), 'none') AS value FROM range(100)"
    table = CommittedTable(spark, f"{tmp_path}/t")
    copy(spark, "SELECT id, id AS value FROM range(0)", table, create_table=True)
    options = dict(order_by=["id"], unique_order=True, checkpoint=f"{tmp_path}/cp", batch_rows=10, batches_per_commit=1)
    result = copy(spark, text, table, errors="result", **options)
    assert (result.read, result.written, result.status) == (60, 50, WriteStatus.FAILED) and "cannot be converted" in result.error
    assert sorted(r.id for r in table.read().collect()) == list(range(50))
    with pytest.raises(Exception, match="cannot be converted"):
        copy(spark, text, table, resume=True, **options)
    with pytest.raises(ValueError, match="errors"):
        copy(spark, text, table, errors="ignore")
    with pytest.raises(ValueError, match="interval"):
        copy(spark, source, table, progress_interval=-1)


def test_a_marker_takes_few_calls_to_the_jvm(spark, tmp_path, monkeypatch):
    """A transfer of many commits writes as many markers, one after another."""
    from rowhaul import storage

    storage.write_small(spark, f"{tmp_path}/m/first", "x")
    client, sent = spark.sparkContext._gateway._gateway_client, []
    plain = type(client).send_command
    monkeypatch.setattr(type(client), "send_command", lambda self, command, *a, **k: sent.append(command) or plain(self, command, *a, **k))
    storage.write_small(spark, f"{tmp_path}/m/second", "x")
    assert sum(not c.startswith("m\n") for c in sent) <= 30  # without those that let go of objects
    storage.write_small(spark, f"{tmp_path}/m/second", "y")
    assert storage.read_small(spark, f"{tmp_path}/m/second") == "y"
    assert [n for n in storage.list_names(spark, f"{tmp_path}/m") if not n.startswith(".")] == ["first", "second"]
