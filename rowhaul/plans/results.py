"""Outcome and progress of a transfer as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import IntEnum

from pyspark.sql import DataFrame, SparkSession, functions as F

PROGRESS_INTERVAL = 10_000


class WriteStatus(IntEnum):
    SUCCEEDED = 0
    FAILED = 1
    UNKNOWN = 2


@dataclass(frozen=True)
class TransferResult:
    read: int
    written: int
    status: WriteStatus = WriteStatus.SUCCEEDED
    error: str = ""

    def frame(self, spark: SparkSession) -> DataFrame:
        row = [(self.read, self.written, self.status.name.capitalize())]
        return spark.createDataFrame(row, "read long, written long, status string")


@dataclass(frozen=True)
class Progress:
    """Running totals of a transfer after a commit."""

    read: int
    written: int


class ProgressReports:
    """Hands totals to ``report`` after each commit that passes a multiple of ``interval`` written rows (0: never)."""

    def __init__(self, report: Callable[[Progress], None] | None, interval: int = PROGRESS_INTERVAL):
        if interval < 0:
            raise ValueError("the progress interval cannot be negative")
        self.report, self.interval, self.written = report, interval, 0

    def after(self, written: int) -> None:
        """``written`` rows are committed in all."""
        if self.report and self.interval and written // self.interval > self.written // self.interval:
            self.report(Progress(written, written))
        self.written = written


def transfer_result(batches: DataFrame) -> DataFrame:
    """Totals over per-batch results (batch, read, written, status).

    The first batch that did not succeed ends the run: it still counts with
    what it wrote, later batches do not count at all.
    """
    # One value, found first, so that the totals stay a plain two-step aggregate.
    stop = batches.where(F.col("status") != "Succeeded").agg(F.min("batch")).first()[0]
    counted = batches if stop is None else batches.where(F.col("batch") <= stop)
    return counted.agg(
        F.coalesce(F.sum("read"), F.lit(0)).alias("read"),
        F.coalesce(F.sum("written"), F.lit(0)).alias("written"),
        F.coalesce(F.max(F.when(F.col("status") != "Succeeded", F.col("status"))), F.lit("Succeeded")).alias("status"),
    )


def transfer_progress(batches: DataFrame, interval: int = PROGRESS_INTERVAL) -> DataFrame:
    """Reports at the batches whose end passes a multiple of ``interval`` written rows (0: none).

    A batch knows its first position, so the running totals need no window over all batches.
    """
    if interval < 0:
        raise ValueError("the progress interval cannot be negative")
    written = F.col("first") + F.col("rows")
    report = batches.select("batch", written.alias("read"), written.alias("written"), "first")
    if interval == 0:
        return report.where(F.lit(False)).drop("first")
    step = F.lit(interval).cast("bigint")
    passed = F.call_function("div", F.col("written"), step) > F.call_function("div", F.col("first"), step)
    return report.where(passed).drop("first")
