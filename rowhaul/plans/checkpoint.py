"""Restart markers and the fingerprint that ties a marker to its plan."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from rowhaul import storage


@dataclass(frozen=True)
class TransferCheckpoint:
    batches: int
    rows: int
    copy: str  # digest of the numbered copy that the commits are cut from
    fingerprint: str


class CheckpointStore:
    """One marker file, replaced in a single rename."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self) -> TransferCheckpoint | None:
        if not storage.exists(self.spark, self.path):
            return None
        return TransferCheckpoint(**json.loads(storage.read_small(self.spark, self.path)))

    def save(self, checkpoint: TransferCheckpoint) -> None:
        storage.write_small(self.spark, self.path, json.dumps(asdict(checkpoint)))

    def delete(self) -> None:
        storage.delete(self.spark, self.path)


def plan_fingerprint(**plan) -> str:
    """SHA-256 over everything that decides which rows land in which batch, and where."""
    return hashlib.sha256(json.dumps(plan, sort_keys=True, default=str).encode("utf-8")).hexdigest().upper()
