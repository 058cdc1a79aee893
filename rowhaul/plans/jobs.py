"""The transfers: export, import, copy and exec."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping
from contextlib import nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rowhaul import storage
from rowhaul.functions.sizes import record_bytes
from rowhaul.operators.batching import (
    BATCH_ROWS, MAX_BATCH_BYTES, NumberedRows, batch_table, number_rows, reject_oversize,
)
from rowhaul.operators.schema import map_columns, nullable
from rowhaul.operators.transform import limit_record_bytes
from rowhaul.plans.checkpoint import CheckpointStore, TransferCheckpoint, plan_fingerprint
from rowhaul.plans.results import PROGRESS_INTERVAL, Progress, ProgressReports, TransferResult, WriteStatus
from rowhaul.sinks.committed import StagedRows
from rowhaul.sinks.files import write_records
from rowhaul.sources.files import line_named, read_records
from rowhaul.sources.query import sql_query
from rowhaul.types import Capability

TRANSACTIONS = ("none", "batch", "all")
# Batches in one commit unless the caller says otherwise, whatever the size of the input. With 1, each batch stands alone.
BATCHES_PER_COMMIT = 1000

Transform = Callable[[DataFrame], DataFrame]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _transformed(df: DataFrame, transform: Transform | None, max_record_bytes: int) -> DataFrame:
    return df if transform is None else limit_record_bytes(transform(df), max_record_bytes)


def export_records(
    spark: SparkSession, query: str, path: str, format: str, transform: Transform | None = None,
    max_batch_bytes: int = MAX_BATCH_BYTES, order_by: list[str] | None = None, **write_options,
) -> TransferResult:
    """Query to file. ``order_by`` sorts the output across the part files."""
    df = _transformed(sql_query(spark, query), transform, max_batch_bytes)
    if order_by:
        df = ordered(df, order_by)
    counted, seen = _counted(reject_oversize(df, max_batch_bytes, "sql"))
    write_records(counted, path, format, **write_options)
    return TransferResult(seen.get["rows"], seen.get["rows"])


def exec_query(spark: SparkSession, query: str, path: str, format: str, **options) -> TransferResult:
    """Query to file without a transform."""
    return export_records(spark, query, path, format, None, **options)


def ordered(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Source order kept to the sink: ranges over tasks, sorted inside each.

    Rows of equal keys stay in the order they arrive in, by which a frequent key also spreads over tasks.
    """
    keys = [*order_by, "_arrival"]
    numbered = df.withColumn("_arrival", F.monotonically_increasing_id())
    return numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_arrival")


def import_records(
    spark: SparkSession, path, format: str, sink, transform: Transform | None = None,
    mapping: Mapping[str, str] | None = None, create_table: bool = False, transaction: str = "batch",
    batch_rows: int = BATCH_ROWS, max_batch_bytes: int = MAX_BATCH_BYTES,
    batches_per_commit: int | None = None, read_options: Mapping | None = None, **reporting,
) -> TransferResult:
    """File to table: parse, transform, rename, write. Imports cannot resume.

    A bad line of JSON Lines is named by file and line number.

    Batches follow the files by name and the records in them. Where a step between needs a
    shuffle (records put together from pieces) or Python (a transform may), they follow the order in
    which that step delivers them.
    """
    options = dict(read_options or {})
    if format.lower() in ("jsonl", "extended-json"):
        options.setdefault("max_record_bytes", max_batch_bytes)
    records = read_records(spark, path, format, **options)
    by_line = format.lower() in ("jsonl", "extended-json")
    with line_named(spark, path, records.columns, options["max_record_bytes"]) if by_line else nullcontext():
        return load(
            _transformed(records, transform, max_batch_bytes), sink, mapping, create_table, transaction, batch_rows, max_batch_bytes,
            batches_per_commit=batches_per_commit, source="file", by_file=transform is None, **reporting,
        )


def copy(
    spark: SparkSession, query: str, sink, mapping: Mapping[str, str] | None = None, create_table: bool = False,
    transaction: str = "batch", batch_rows: int = BATCH_ROWS, max_batch_bytes: int = MAX_BATCH_BYTES,
    order_by: list[str] | None = None, unique_order: bool = False,
    checkpoint: str | None = None, resume: bool = False, batches_per_commit: int | None = None, **reporting,
) -> TransferResult:
    """Query to table, restartable with ``checkpoint``."""
    return load(
        sql_query(spark, query), sink, mapping, create_table, transaction, batch_rows, max_batch_bytes,
        order_by, unique_order, checkpoint, resume, batches_per_commit, plan={"query": query}, **reporting,
    )


def load(
    df: DataFrame, sink, mapping: Mapping[str, str] | None = None, create_table: bool = False,
    transaction: str = "batch", batch_rows: int = BATCH_ROWS, max_batch_bytes: int = MAX_BATCH_BYTES,
    order_by: list[str] | None = None, unique_order: bool = False,
    checkpoint: str | None = None, resume: bool = False, batches_per_commit: int | None = None,
    plan: Mapping | None = None, source: str = "sql", progress: Callable[[Progress], None] | None = None,
    progress_interval: int = PROGRESS_INTERVAL, stop_after: int | None = None, errors: str = "raise",
    by_file: bool = False,
) -> TransferResult:
    """Write ``df`` to a sink under a transaction scope.

    ``none`` and ``all`` are one plain write each, which a committed table
    shows whole or not at all. ``batch`` numbers the rows and commits
    ``batches_per_commit`` batches at a time, in order; with a checkpoint a
    failed run resumes after the last commit, from the numbered copy the first
    attempt made. Without one, a sink that can stage rows gets them in one write,
    and commits only say how far they count.

    ``by_file`` says that ``df`` comes straight from a scan of files, whose order
    the batches then follow: by file name, and by place in the file.

    ``progress`` is called after commits that pass a multiple of
    ``progress_interval`` rows; ``stop_after`` ends the run after so many commits,
    for a later resume. With ``errors="result"`` a commit that fails ends the run
    with a result that says so and what was written; else the error is raised.
    """
    spark = df.sparkSession
    if errors not in ("raise", "result"):
        raise ValueError(f"errors must be 'raise' or 'result', not '{errors}'")
    reports = ProgressReports(progress, progress_interval)
    _check_scope(sink, transaction, checkpoint, resume)
    renamed = map_columns(df, mapping, sink.case_sensitive)
    sink.validate(renamed.schema)
    fingerprint = plan_fingerprint(
        plan=dict(plan or {}), schema=df.schema.json(), destination=[sink.provider, sink.location],
        mapping=sorted((mapping or {}).items()), create_table=create_table, transaction=transaction,
        batch_rows=batch_rows, max_batch_bytes=max_batch_bytes, order_by=[str(k) for k in order_by or []],
        batches_per_commit=batches_per_commit,
    )
    store = CheckpointStore(spark, checkpoint) if checkpoint else None
    done = store.load() if store and resume else None
    if done and done.fingerprint != fingerprint:
        raise ValueError(f"{checkpoint} was left by another transfer: its query, destination, mapping or batch settings are not these")
    # A resumed transfer reuses the table its first attempt created.
    sink.prepare(nullable(renamed.schema), create_table and done is None)
    if transaction != "batch":
        counted, seen = _counted(reject_oversize(renamed, max_batch_bytes, source))
        sink.write(counted, uuid.uuid4().hex)
        sink.complete()
        reports.after(seen.get["rows"])
        return TransferResult(seen.get["rows"], seen.get["rows"])

    sizes, numbering = record_bytes(df, source), {"order_by": order_by, "unique_order": unique_order, "by_file": by_file}
    if store is None and getattr(sink, "stage", None):
        run = uuid.uuid4().hex
        try:
            numbered = sink.stage(df, run, lambda rows: map_columns(rows, mapping, sink.case_sensitive), size=sizes, **numbering)
            ranges = _commit_ranges(numbered, batch_rows, max_batch_bytes, batches_per_commit)
        except Exception:
            sink.drop_staged(run)
            raise

        def staged(first: int, end: int) -> StagedRows:
            return StagedRows(run, None if end == numbered.total else numbered.place(end))

        return _committed(sink, ranges, lambda batch: f"{batch:012d}", staged, numbered.total, reports, stop_after, errors)
    rows_folder = f"{checkpoint}.rows" if checkpoint else storage.new_folder(spark, "rows")
    if checkpoint and done is None:
        storage.delete(spark, rows_folder)
    if done and done.copy != _copy_of(spark, rows_folder):
        raise ValueError(f"the rows numbered by the first attempt are not all in {rows_folder} any more; start the transfer anew")
    numbered = number_rows(df, size=sizes, folder=rows_folder, finished=done is not None, **numbering)
    copied = _copy_of(spark, rows_folder) if store else ""
    run = fingerprint[:16] if checkpoint else uuid.uuid4().hex
    ranges = [r for r in _commit_ranges(numbered, batch_rows, max_batch_bytes, batches_per_commit) if not done or r[2] > done.batches]

    def part(first: int, end: int) -> DataFrame:
        return map_columns(numbered.between(first, end), mapping, sink.case_sensitive)

    def mark(end_batch: int, end: int) -> None:
        if store:
            store.save(TransferCheckpoint(end_batch, end, copied, fingerprint))

    result = _committed(sink, ranges, lambda batch: f"{run}-{batch:012d}", part, numbered.total, reports, stop_after, errors, mark)
    if result.status == WriteStatus.SUCCEEDED and result.written == numbered.total:
        if store:
            store.delete()
        storage.delete(spark, rows_folder)
    return result


def _committed(
    sink, ranges: list, name: Callable[[int], str], part: Callable, total: int, reports: ProgressReports,
    stop_after: int | None, errors: str, mark: Callable[[int, int], None] = lambda end_batch, end: None,
) -> TransferResult:
    """Commit stretches of rows one after another; the first that fails ends the run."""
    written = ranges[0][1] if ranges else total
    reports.written = written
    for batch, first, end_batch, end in ranges[:stop_after]:
        try:
            sink.write(part(first, end), name(batch), {"first_batch": batch, "end_batch": end_batch, "rows": end - first})
        except Exception as error:
            if errors == "raise":
                raise
            return TransferResult(end, written, WriteStatus.FAILED, f"{type(error).__name__}: {error}"[:1000])
        mark(end_batch, end)
        written = end
        reports.after(written)
    if written == total:
        sink.complete()
    return TransferResult(written, written)


def _copy_of(spark: SparkSession, folder: str) -> str:
    """Digest of the part names of the numbered copy: what a resume must find again."""
    parts = [n for n in storage.list_names(spark, folder) if n.startswith("part-")]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def _check_scope(sink, transaction: str, checkpoint: str | None, resume: bool) -> None:
    """Refuse what the sink or the scope cannot do, before anything is created or read."""
    if transaction not in TRANSACTIONS:
        raise ValueError(f"unknown transaction scope '{transaction}'")
    if resume and not checkpoint:
        raise ValueError("nothing to resume from: name the checkpoint")
    if checkpoint and transaction != "batch":
        raise ValueError(f"transaction '{transaction}' has no commits to restart after; use 'batch' with a checkpoint")
    needed = {"batch": Capability.BATCH_TRANSACTIONS, "all": Capability.ALL_TRANSACTION}.get(transaction)
    if needed and needed not in sink.capabilities:
        raise ValueError(f"{sink.provider} does not support transaction scope '{transaction}'")


def _commit_ranges(numbered: NumberedRows, batch_rows: int, max_batch_bytes: int, batches_per_commit: int | None):
    """(first batch, first row, end batch, end row) of each commit; only commit edges reach the driver."""
    total = numbered.total
    if total == 0:
        return []
    if numbered.max_row_bytes * batch_rows <= max_batch_bytes:
        # No batch reaches the byte limit: all edges follow from the row count.
        batches = -(-total // batch_rows)
        step = batches_per_commit or BATCHES_PER_COMMIT
        edges = [(b, b * batch_rows) for b in range(0, batches, step)]
    else:
        table = storage.new_folder(numbered.spark, "batches")
        batch_table(numbered, batch_rows, max_batch_bytes).write.parquet(table)
        written = numbered.spark.read.parquet(table)
        batches = written.count()
        step = batches_per_commit or BATCHES_PER_COMMIT
        edges = sorted((r.batch, r.first) for r in written.where(F.col("batch") % step == 0).collect())
    ends = [*edges[1:], (batches, total)]
    return [(b, first, end_b, end) for (b, first), (end_b, end) in zip(edges, ends)]
