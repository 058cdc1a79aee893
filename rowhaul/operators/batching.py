"""Numbered rows and size-bounded batches.

``number_rows`` writes the rows once, in order, to the shared folder. Each
written row carries the run it belongs to and a number that grows along the run
(Spark's own row id). A run is a partition or, for rows in the order of the files
they come from, a file block, however Spark packs blocks into tasks. A row's
global position is its place in the run plus the row counts of the runs before
it: one small count per run, no single-task window. The written copy also pins
order and runs for every later pass, whatever executors are lost on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowhaul import storage
from rowhaul.functions.sizes import record_bytes
from rowhaul.operators.greedy import Summary, advance, compose, cut, summarise
from rowhaul.functions.text import quoted

BATCH_ROWS = 1000
MAX_BATCH_BYTES = 4 * 1024 * 1024
CHUNK_ROWS = 100

ROW = "_row"
POSITION = "_position"
BATCH = "_batch"
BYTES = "_bytes"
_ROW = ROW
FILE = "_file"
BLOCK = "_block"
#: Columns that order the written rows.
PLACE = (FILE, BLOCK, ROW)
_ARRIVAL = "_arrival"
_SEGMENT = "_segment"
_STRETCH = "_stretch"
_FROM = "_batch_from"
_END = "_batch_end"
RESERVED = (POSITION, BATCH, BYTES, _ROW, FILE, BLOCK, _ARRIVAL, _SEGMENT, _STRETCH, _FROM, _END)

SEGMENT_ROWS = 1 << 20
BLOCK_SEGMENTS = 256
#: Rows of summaries that one task composes.
SUMMARY_ROWS = 1 << 22


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value.cast("bigint"), F.lit(by).cast("bigint"))


class Run(NamedTuple):
    """Rows that follow one another in the written copy."""

    file: str  # empty for a partition
    block: int
    first: int  # row id
    rows: int
    copy: str  # the written file that holds them


def before(place: tuple[str, int, int]) -> Column:
    """Which written rows come before a place (file, block, row id)."""
    file, block, row = place
    if not file:
        return F.col(ROW) < row  # runs are partitions, whose row ids are in their order
    in_file = (F.col(BLOCK) < block) | ((F.col(BLOCK) == block) & (F.col(ROW) < row))
    return (F.col(FILE) < file) | ((F.col(FILE) == file) & in_file)


@dataclass(frozen=True)
class NumberedRows:
    """Rows written in order, with what is needed to number them."""

    spark: SparkSession
    folder: str
    runs: tuple[Run, ...]  # in order
    max_row_bytes: int

    @property
    def parts(self) -> tuple[tuple[int, int, str], ...]:
        """(block, rows, written file) of each run, in order."""
        return tuple((r.block, r.rows, r.copy) for r in self.runs)

    @property
    def total(self) -> int:
        return sum(r.rows for r in self.runs)

    def _offsets(self, segment_rows: int) -> DataFrame:
        rows, earlier, segments = [], 0, 0
        for run in self.runs:
            rows.append((run.file, run.block, run.first, earlier, segments))
            earlier += run.rows
            segments += -(-run.rows // segment_rows)
        return self.spark.createDataFrame(rows, f"{FILE} string, {BLOCK} long, _first long, _before long, _segments long")

    def segment_count(self, segment_rows: int = SEGMENT_ROWS) -> int:
        return sum(-(-r.rows // segment_rows) for r in self.runs)

    def rows(self, segment_rows: int = SEGMENT_ROWS, columns: list[str] | None = None) -> DataFrame:
        """The rows with their 0-based position, size estimate and segment number."""
        local = F.col(_ROW) - F.col("_first")
        written = self.spark.read.parquet(self.folder)
        data = [c for c in written.columns if c not in RESERVED] if columns is None else columns
        return (
            written.join(self._offsets(segment_rows), [FILE, BLOCK])
            .select(
                *[quoted(c) for c in data],
                (F.col("_before") + local).alias(POSITION),
                F.col(BYTES),
                (F.col("_segments") + _div(local, segment_rows)).alias(_SEGMENT),
            )
        )

    def place(self, position: int) -> tuple[str, int, int]:
        """(file, block, row id) that all rows before ``position`` come before, and no others."""
        earlier, last = 0, ("", 0, 0)
        for run in self.runs:
            if position <= earlier + run.rows:
                return run.file, run.block, run.first + position - earlier
            earlier, last = earlier + run.rows, (run.file, run.block, run.first + run.rows)
        return last

    def between(self, first: int, end: int) -> DataFrame:
        """The original columns of the rows at positions ``first`` to ``end - 1``, reading only their files."""
        files, earlier = set(), 0
        for run in self.runs:
            if earlier < end and first < earlier + run.rows:
                files.add(run.copy)
            earlier += run.rows
        written = self.spark.read.parquet(self.folder)
        if not files:
            return written.where(F.lit(False)).drop(BYTES, *PLACE)
        some = self.spark.read.schema(written.schema).parquet(*sorted(files))
        return some.where(~before(self.place(first)) & before(self.place(end))).drop(BYTES, *PLACE)


def _one_scan(df: DataFrame) -> bool:
    """Whether all rows come from one scan; of others Spark cannot tell the file."""
    return df._jdf.queryExecution().analyzed().collectLeaves().length() == 1


def number_rows(
    df: DataFrame,
    order_by: list[str | Column] | None = None,
    unique_order: bool = False,
    size: Column | None = None,
    folder: str | None = None,
    finished: bool = False,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    by_file: bool = False,
) -> NumberedRows:
    """Fix the order of ``df`` and number its rows.

    Without ``order_by`` rows keep the order the source delivers them in and
    nothing is shuffled. ``unique_order`` promises that no two rows share a
    key; without it rows of equal keys keep their arrival order, and their
    arrival number also spreads a frequent key over many tasks. ``finished``
    says that ``folder`` holds the copy already; the source is not read then.
    ``shape`` turns the rows into what is written, keeping the size column.
    ``by_file`` says that rows come straight from a scan of files: they are
    ordered by file name and place in the file, whatever order Spark reads them in.
    """
    spark = df.sparkSession
    clash = [c for c in df.columns if c in RESERVED]
    if clash:
        raise ValueError(f"column names reserved here: {clash}")
    folder = folder or storage.new_folder(spark, "rows")
    if not finished:
        work = df.withColumn(BYTES, record_bytes(df) if size is None else size)
        arrival = None
        if order_by:
            keys = [F.col(quoted(k)) if isinstance(k, str) else k for k in order_by]
            if not unique_order:
                arrival = storage.new_folder(spark, "arrival")
                work.withColumn(_ARRIVAL, F.monotonically_increasing_id()).write.parquet(arrival)
                work = spark.read.parquet(arrival)
                keys = [*keys, F.col(_ARRIVAL)]
            work = work.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_ARRIVAL)
        work = shape(work) if shape else work
        file, block = F.lit(""), F.spark_partition_id().cast("long")
        if by_file and not order_by and _one_scan(work):
            file, block = F.input_file_name(), F.when(F.input_file_name() == "", block).otherwise(F.input_file_block_start())
        placed = work.withColumns({FILE: file, BLOCK: block, _ROW: F.monotonically_increasing_id()})
        placed.write.mode("overwrite").parquet(folder)
        if arrival:
            storage.delete(spark, arrival)
    found = (
        spark.read.parquet(folder)
        .groupBy(FILE, BLOCK)
        .agg(
            F.count(F.lit(1)).alias("n"), F.min(_ROW).alias("first"), F.max(_ROW).alias("last"), F.max(BYTES).alias("widest"),
            F.max("_metadata.file_path").alias("copy"), F.min("_metadata.file_path").alias("other"),
        )
        .collect()
    )
    if any(r.copy != r.other for r in found):
        raise RuntimeError("each partition must be written as one file: leave spark.sql.files.maxRecordsPerFile at 0")
    if any(r.last - r.first + 1 != r.n for r in found):
        raise RuntimeError("the rows of a file block must be written one after another")
    runs = tuple(sorted(Run(r[FILE], r[BLOCK], r.first, r.n, r.copy) for r in found))
    return NumberedRows(spark, folder, runs, max((r.widest for r in found), default=0))


def _check_limits(batch_rows: int, max_batch_bytes: int) -> None:
    if batch_rows < 1 or max_batch_bytes < 1:
        raise ValueError("batch_rows and max_batch_bytes must be at least 1")


def batch_by_rows(numbered: NumberedRows, batch_rows: int = BATCH_ROWS, columns: list[str] | None = None) -> DataFrame:
    """Batch number from the position alone: every ``batch_rows`` rows make a batch."""
    _check_limits(batch_rows, 1)
    rows = numbered.rows(columns=columns).drop(_SEGMENT)
    return rows.withColumn(BATCH, _div(F.col(POSITION), batch_rows))


def batch_rows_and_bytes(
    numbered: NumberedRows,
    batch_rows: int = BATCH_ROWS,
    max_batch_bytes: int = MAX_BATCH_BYTES,
    segment_rows: int = SEGMENT_ROWS,
    block_segments: int = BLOCK_SEGMENTS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Batches closed by row count or before the row that would exceed the byte limit, numbered from 0.

    The result is the same as one serial pass over all rows. A row larger than
    the limit stops the job. Batches are cut over positions and sizes alone. The
    rows, read where they lie, then look up their batch in a table of batch
    edges, which Spark broadcasts while it is small. Beyond that, the rows move
    once, by stretches of ``batch_rows`` positions, none larger than another.
    """
    _check_limits(batch_rows, max_batch_bytes)
    if numbered.max_row_bytes > max_batch_bytes:
        raise ValueError(f"one row takes {numbered.max_row_bytes} bytes, more than max_batch_bytes={max_batch_bytes}")
    if numbered.max_row_bytes * batch_rows <= max_batch_bytes:
        return batch_by_rows(numbered, batch_rows, columns)  # no batch can reach the byte limit
    narrow = _numbered_sizes(numbered, batch_rows, max_batch_bytes, segment_rows, block_segments)
    if columns == []:
        return narrow
    table = storage.new_folder(numbered.spark, "edges")
    _batch_edges(narrow).write.parquet(table)
    # A batch has batch_rows rows at most, so it lies in two stretches of as many positions, or in one.
    edges = numbered.spark.read.parquet(table)
    end = F.col("first") + F.col("rows")
    stretches = F.sequence(_div(F.col("first"), batch_rows), _div(end - 1, batch_rows))
    spans = edges.select(F.col("batch").alias(BATCH), F.col("first").alias(_FROM), end.alias(_END), F.explode(stretches).alias(_STRETCH))
    rows = numbered.rows(segment_rows, columns).drop(_SEGMENT)
    data, inside = rows.columns, (F.col(_FROM) <= F.col(POSITION)) & (F.col(POSITION) < F.col(_END))
    placed = rows.withColumn(_STRETCH, _div(F.col(POSITION), batch_rows)).join(spans, [_STRETCH]).where(inside)
    return placed.select(*[quoted(c) for c in data], BATCH)


def _numbered_sizes(numbered: NumberedRows, batch_rows: int, max_batch_bytes: int, segment_rows: int, block_segments: int) -> DataFrame:
    """Position, size and batch number of every row: what is shuffled by segments has these and the segment's entry only."""
    entries = None
    if numbered.segment_count(segment_rows) > 1:
        entries = _segment_entries(numbered, batch_rows, max_batch_bytes, segment_rows, block_segments)
    rows = numbered.rows(segment_rows, columns=[])
    # a single segment is entered with no batch open
    entered = rows.withColumns(_nothing_held()) if entries is None else rows.join(entries, _SEGMENT)
    in_order = entered.repartition(_SEGMENT).sortWithinPartitions(_SEGMENT, POSITION)
    number = cut_udf(batch_rows, max_batch_bytes)
    return in_order.select(POSITION, BYTES, number(_SEGMENT, BYTES, "held_rows", "held_bytes", "open_batch").alias(BATCH))


def _nothing_held() -> dict[str, Column]:
    zero = F.lit(0).cast("long")
    return {"held_rows": zero, "held_bytes": zero, "open_batch": F.lit(-1).cast("long")}


def _batch_edges(narrow: DataFrame) -> DataFrame:
    return narrow.groupBy(F.col(BATCH).alias("batch")).agg(
        F.min(POSITION).alias("first"), F.count(F.lit(1)).alias("rows"), F.sum(BYTES).alias("bytes")
    )


def cut_udf(batch_rows: int, max_batch_bytes: int):
    """Number batches over rows that arrive grouped and in order; only these five columns reach Python.

    Not deterministic to Spark: it counts along the partition, so no filter may slip below it.
    """

    def number(chunks: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        group, rows, held, batch = None, 0, 0, -1
        for groups, sizes, held_rows, held_bytes, open_batch in chunks:
            keys, sizes = groups.to_numpy(), sizes.to_numpy(np.int64)
            out = np.empty(len(keys), np.int64)
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for lo, hi in zip([0, *edges], [*edges, len(keys)]):
                if lo == hi:
                    continue
                if group is None or keys[lo] != group:
                    group, rows, held, batch = keys[lo], held_rows.iloc[lo], held_bytes.iloc[lo], open_batch.iloc[lo]
                started, rows, held = cut(sizes[lo:hi], rows, held, batch_rows, max_batch_bytes)
                out[lo:hi] = batch + started
                batch = out[hi - 1]
            yield pd.Series(out)

    number.__annotations__ = {"chunks": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(number, "long").asNondeterministic()


_SUMMARY = (
    "segment long, count long, total long, prefix array<long>, "
    "exit_rows array<long>, exit_bytes array<long>, starts array<long>"
)


def _frame(segment: int, s: Summary) -> pd.DataFrame:
    return pd.DataFrame({
        "segment": [segment], "count": [s.count], "total": [s.total], "prefix": [s.prefix],
        "exit_rows": [s.exit_rows], "exit_bytes": [s.exit_bytes], "starts": [s.starts],
    })


def _summary(row) -> Summary:
    return Summary(
        int(row.count_), int(row.total), *[np.asarray(a, np.int64) for a in (row.prefix, row.exit_rows, row.exit_bytes, row.starts)]
    )


def _summaries(pdf: pd.DataFrame) -> list[tuple[int, Summary]]:
    ordered = pdf.rename(columns={"count": "count_"}).sort_values("segment")
    return [(int(r.segment), _summary(r)) for r in ordered.itertuples(index=False)]


def _segment_entries(numbered: NumberedRows, batch_rows: int, cap: int, segment_rows: int, block_segments: int) -> DataFrame:
    """What the open batch holds when each segment begins: (segment, held_rows, held_bytes, open_batch).

    Segments are summarised in parallel. ``block_segments`` neighbours are composed
    to one summary, level by level, until so few are left that one task walks
    over them; what it finds on entry to each goes down the levels again. A
    summary is as long as a batch has rows, so fewer are taken together when
    batches are long. None reaches the driver.
    """
    spark = numbered.spark
    fan = max(2, min(block_segments, SUMMARY_ROWS // batch_rows))
    entry = "segment long, held_rows long, held_bytes long, open_batch long"

    def summarise_segment(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf.sort_values(POSITION)[BYTES].to_numpy(np.int64)
        return _frame(int(key[0]), summarise(sizes, batch_rows, cap))

    def compose_block(key: tuple[Any, ...], pdf: pd.DataFrame) -> pd.DataFrame:
        return _frame(int(key[0]), reduce(lambda a, b: compose(a, b, batch_rows, cap), [s for _, s in _summaries(pdf)]))

    def walk_block(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        rows, held, batch = int(first.held_rows), int(first.held_bytes), int(first.open_batch)
        out = []
        for segment, summary in _summaries(pdf):
            out.append((segment, rows, held, batch))
            r, b, started = advance(summary, np.int64(rows), np.int64(held), batch_rows, cap)
            rows, held, batch = int(r), int(b), batch + int(started)
        return pd.DataFrame(out, columns=["segment", "held_rows", "held_bytes", "open_batch"])

    def kept(rows: DataFrame, label: str) -> DataFrame:
        folder = storage.new_folder(spark, label)
        rows.write.parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)

    sizes = numbered.rows(segment_rows, columns=[])
    levels = [kept(sizes.groupBy(_SEGMENT).applyInPandas(summarise_segment, _SUMMARY), "segments")]
    count = numbered.segment_count(segment_rows)
    while count > fan:
        levels.append(kept(levels[-1].groupBy(_div(F.col("segment"), fan).alias("segment")).applyInPandas(compose_block, _SUMMARY), "segments"))
        count = -(-count // fan)
    walked = levels[-1].withColumns({"block": F.lit(0).cast("long"), **_nothing_held()})
    entries = kept(walked.groupBy("block").applyInPandas(walk_block, entry), "entries")
    for level in levels[-2::-1]:
        parents = entries.withColumnRenamed("segment", "block")
        walked = level.withColumn("block", _div(F.col("segment"), fan)).join(parents, "block")
        entries = kept(walked.groupBy("block").applyInPandas(walk_block, entry), "entries")
    return entries.withColumnRenamed("segment", _SEGMENT)


def batch_table(numbered: NumberedRows, batch_rows: int = BATCH_ROWS, max_batch_bytes: int = MAX_BATCH_BYTES) -> DataFrame:
    """One row per batch: (batch, first, rows, bytes). Only positions and sizes move, never the records."""
    return _batch_edges(batch_rows_and_bytes(numbered, batch_rows, max_batch_bytes, columns=[]))


def oversize(df: DataFrame, max_bytes: int, source: str = "file") -> DataFrame:
    """Records whose size estimate exceeds the limit."""
    return df.where(record_bytes(df, source) > max_bytes)


def reject_oversize(df: DataFrame, max_bytes: int, source: str = "file") -> DataFrame:
    """``df`` itself, stopping the job at the first record above the limit."""
    size = record_bytes(df, source)
    too_large = F.raise_error(F.concat(F.lit("one row takes "), size.cast("string"), F.lit(f" bytes, more than max_batch_bytes={max_bytes}"))).cast("boolean")
    return df.where(F.when(size > max_bytes, too_large).otherwise(F.lit(True)))


def partition_chunks(batched: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS, chunk: str = "chunk") -> DataFrame:
    """Within each batch, rows of one key are cut into chunks in arrival order.

    The window covers one key of one batch, so it never exceeds the batch size however frequent the key is.
    """
    order = Window.partitionBy(BATCH, quoted(key)).orderBy(POSITION)
    return batched.withColumn(chunk, _div(F.row_number().over(order) - 1, chunk_rows))


def resplit_batches(batched: DataFrame, size: Column, max_bytes: int, split: str = "split") -> DataFrame:
    """Cut each batch again so that no part exceeds ``max_bytes`` of the given size (first part 0)."""
    data = batched.columns
    zero = F.lit(0).cast("long")
    ordered = (
        batched.withColumn("_size", size.cast("long"))
        .withColumn("_size", F.when(
            F.col("_size") > max_bytes, F.raise_error(F.lit("transformed record exceeds the size limit")).cast("long")
        ).otherwise(F.col("_size")))
        .repartition(BATCH)
        .sortWithinPartitions(BATCH, POSITION)
    )
    number = cut_udf(np.iinfo(np.int64).max // 4, max_bytes)
    return ordered.select(*[quoted(c) for c in data], number(BATCH, "_size", zero, zero, F.lit(-1).cast("long")).alias(split))
