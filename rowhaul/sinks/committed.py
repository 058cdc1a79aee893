"""Tables on a shared filesystem whose rows appear commit by commit.

A commit is one Spark write to a folder of its own, then one small marker
file. Readers see folders with a marker only, so a failed or repeated write
never shows partial or doubled rows.

Many commits of one transfer are staged by a single write: its rows are numbered
in order, and a commit's marker, which names the place its rows end before,
shows one more stretch of them. So a transfer is written once however many
commits it has, and one that breaks leaves the rows of its first commits.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowhaul import storage
from rowhaul.functions.coerce import coerce
from rowhaul.operators.batching import BLOCK, BYTES, FILE, PLACE, ROW, NumberedRows, before, number_rows
from rowhaul.operators.schema import check_names, require_flat
from rowhaul.types import SINK_CAPABILITIES

#: Name of a staged commit: run, first batch, and whether nothing is left after it.
_STAGED = re.compile("staged-([0-9a-f]{32})-([0-9]+)-(part|whole)")


class StagedRows(NamedTuple):
    """What a commit of a staged run adds: all its rows before a place, or all there are."""

    run: str
    end: tuple[str, int, int] | None



class CommittedTable:
    """A table folder; ``write`` is idempotent per commit name."""

    provider = "table"
    capabilities = SINK_CAPABILITIES["table"]
    case_sensitive = False

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def location(self) -> str:
        return self.path

    def exists(self) -> bool:
        return storage.exists(self.spark, f"{self.path}/_table.json")

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(storage.read_small(self.spark, f"{self.path}/_table.json")))

    def validate(self, schema: T.StructType) -> None:
        check_names(schema.fieldNames(), "destination columns", case_sensitive=self.case_sensitive)
        require_flat(schema)

    def prepare(self, schema: T.StructType, create: bool) -> None:
        """Create the table, which must not exist yet, or check that ``schema`` fits the existing one."""
        self.validate(schema)
        if create:
            if self.exists():
                raise ValueError(f"table {self.path} already exists")
            storage.write_small(self.spark, f"{self.path}/_table.json", schema.json())
        elif not self.exists():
            raise ValueError(f"table {self.path} does not exist")
        else:
            known = {f.name.casefold() for f in self.schema().fields}
            missing = [n for n in schema.fieldNames() if n.casefold() not in known]
            if missing:
                raise ValueError(f"table {self.path} has no column {missing}")

    def commits(self) -> list[str]:
        return [n.removesuffix(".json") for n in storage.list_names(self.spark, f"{self.path}/_commits") if n.endswith(".json")]

    def recorded(self, commit: str) -> dict | None:
        """What the marker of a commit says; null when there is none."""
        marker = f"{self.path}/_commits/{commit}.json"
        return json.loads(storage.read_small(self.spark, marker)) if storage.exists(self.spark, marker) else None

    def stage(self, df: DataFrame, run: str, shape: Callable[[DataFrame], DataFrame], **numbering) -> NumberedRows:
        """Write all rows of a run, numbered and invisible; ``shape`` renames columns."""
        fitted = lambda rows: self._fit(shape(rows), BYTES)
        return number_rows(df, folder=f"{self.path}/data/staged-{run}", shape=fitted, **numbering)

    def drop_staged(self, run: str) -> None:
        """Remove the rows of a run of which nothing was committed."""
        if not any(c.startswith(f"staged-{run}-") for c in self.commits()):
            storage.delete(self.spark, f"{self.path}/data/staged-{run}")

    def write(self, df: DataFrame | StagedRows, commit: str, info: dict | Callable[[], dict] | None = None) -> None:
        """Add the rows of ``df`` under a commit name; a commit already recorded is left alone.

        ``info`` goes into the marker; a function is called once the rows are written.
        """
        if isinstance(df, StagedRows):
            commit = f"staged-{df.run}-{commit}-{'part' if df.end else 'whole'}"
            info = {**(info or {}), "end": df.end}
        marker = f"{self.path}/_commits/{commit}.json"
        if storage.exists(self.spark, marker):
            return
        if not isinstance(df, StagedRows):
            folder = f"{self.path}/data/{commit}"
            self._fit(df).write.mode("overwrite").parquet(folder)
            try:
                self._accept(self.spark.read.schema(self.schema()).parquet(folder))
            except Exception:
                storage.delete(self.spark, folder)
                raise
        storage.write_small(self.spark, marker, json.dumps({"commit": commit, **((info() if callable(info) else info) or {})}))

    def _accept(self, rows: DataFrame) -> None:
        """Look at the written rows of a commit before it counts; refuse them by an error."""

    def complete(self) -> None:
        pass

    def _fit(self, df: DataFrame, *more: str) -> DataFrame:
        have = {f.name.casefold(): f for f in df.schema.fields}
        columns = []
        for field in self.schema().fields:
            source = have.get(field.name.casefold())
            value = F.lit(None).cast(field.dataType) if source is None else coerce(source, field)
            if not field.nullable:
                value = F.coalesce(value, F.raise_error(F.lit(f"column '{field.name}' must not be null")).cast(field.dataType))
            columns.append(value.alias(field.name, metadata=field.metadata or {}))
        return df.select(*columns, *more)

    def read(self) -> DataFrame:
        """The committed rows."""
        schema, whole, parts = self.schema(), [], {}
        for commit in self.commits():
            staged = _STAGED.fullmatch(commit)
            if staged is None:
                whole.append(f"{self.path}/data/{commit}")
            else:
                parts[staged[1]] = commit  # names of a run sort by batch
        whole += [f"{self.path}/data/staged-{run}" for run, last in parts.items() if last.endswith("-whole")]
        rows = self.spark.read.schema(schema).parquet(*whole) if whole else self.spark.createDataFrame([], schema)
        order = [T.StructField(FILE, T.StringType()), T.StructField(BLOCK, T.LongType()), T.StructField(ROW, T.LongType())]
        for run, last in parts.items():
            if last.endswith("-part"):
                some = self.spark.read.schema(T.StructType([*schema.fields, *order])).parquet(f"{self.path}/data/staged-{run}")
                rows = rows.unionByName(some.where(before(self.recorded(last)["end"])).drop(*PLACE))
        return rows

    def staged_rows(self, run: str) -> DataFrame:
        """All rows of a staged run with what orders them, as ``place``."""
        order = [T.StructField(FILE, T.StringType()), T.StructField(BLOCK, T.LongType()), T.StructField(ROW, T.LongType())]
        some = self.spark.read.schema(T.StructType([*self.schema().fields, *order])).parquet(f"{self.path}/data/staged-{run}")
        return some.withColumn("place", F.struct(*PLACE)).drop(*PLACE)
