"""Incremental import: files that arrive in a folder, taken in bounded steps, each committed once."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rowhaul import storage
from rowhaul.operators.schema import map_columns, nullable
from rowhaul.plans.results import PROGRESS_INTERVAL, Progress, ProgressReports
from rowhaul.sources.files import MAX_RECORD_BYTES, jsonl_records, read_records


class FileStream(NamedTuple):
    """A stream of file names, and how the records of a step's files are read."""

    files: DataFrame  # streaming, one column: path
    read: Callable[[list[str]], DataFrame]
    schema: T.StructType

    @property
    def sparkSession(self) -> SparkSession:
        return self.files.sparkSession


def record_stream(
    spark: SparkSession, folder: str, format: str, schema: T.StructType,
    max_files: int | None = None, max_bytes: str | None = None, max_record_bytes: int = MAX_RECORD_BYTES,
) -> DataFrame | FileStream:
    """Streaming scan of a folder of JSON Lines, Extended JSON, CSV or JSON-array files with a fixed schema.

    Records of the first two end at any line, so lines are the stream. What ends a CSV
    record or an array element depends on all text before it: there the stream is of file
    names, and the batch reader takes the files of each step, by its own rules.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    name = format.lower()
    if name in ("jsonl", "extended-json"):
        lines = reader.format("text").load(folder)
        return jsonl_records(lines, schema.fields, name == "extended-json", max_record_bytes)
    if name not in ("csv", "json"):
        raise ValueError(f"unsupported streaming format '{format}'")
    options = {"names": schema.names} if name == "csv" else {"schema": schema}
    # only names are asked for, so no file is opened here
    files = reader.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(folder).select("path")
    fields = [T.StructField(f.name, T.StringType()) for f in schema.fields] if name == "csv" else schema.fields
    return FileStream(files, lambda paths: read_records(spark, paths, name, **options), T.StructType(fields))


def start_import(
    stream: DataFrame | FileStream, sink, checkpoint: str, name: str, mapping: dict[str, str] | None = None,
    create_table: bool = False, available_now: bool = True,
    progress: Callable[[Progress], None] | None = None, progress_interval: int = PROGRESS_INTERVAL,
) -> StreamingQuery:
    """Run a stream into a sink: every step is one commit named after the stream and its epoch.

    A step repeated after a crash finds its commit recorded and adds nothing.
    After a start with another checkpoint, a recorded step counts as repeated
    only if its rows are the same, by number and checksum; other rows under that
    name are refused, so give a stream that starts anew a name of its own. With
    ``available_now`` the query takes what is there, in steps, and stops. ``progress``
    is told of the rows that this run has committed, as in a transfer.
    """
    spark, reports = stream.sparkSession, ProgressReports(progress, progress_interval)
    by_file = isinstance(stream, FileStream)
    shown = spark.createDataFrame([], stream.schema) if by_file else stream
    renamed = map_columns(shown, mapping, sink.case_sensitive)
    sink.prepare(nullable(renamed.schema), create_table and not sink.exists())
    totals = [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)")).cast("string").alias("checksum")]

    def step(rows: DataFrame, epoch: int) -> None:
        if by_file:
            paths = sorted(r.path for r in rows.collect())
            if not paths:
                return
            rows = map_columns(stream.read(paths), mapping, sink.case_sensitive)
        commit, query = f"{name}-{epoch:012d}", json.loads(storage.read_small(spark, f"{checkpoint}/metadata"))["id"]
        known = sink.recorded(commit) if hasattr(sink, "recorded") else None
        if known is not None and known.get("query") != query:
            found = rows.agg(*totals).first().asDict()
            if found != {k: known.get(k) for k in found}:
                raise ValueError(f"step {epoch} of stream '{name}' is already recorded in {sink.location} with other rows")
            return
        seen = Observation(f"step-{uuid.uuid4().hex}")
        if known is None:
            sink.write(rows.observe(seen, *totals), commit, lambda: {"epoch": epoch, "query": query, **seen.get})
            reports.after(reports.written + seen.get["rows"])

    writer = (stream.files if by_file else renamed).writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
