"""Keyed document collections: inserts only, a key that is already there fails the write."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowhaul import storage
from rowhaul.functions.documents import ENTITY_KEYS, ENTITY_SYSTEM, entity_value, to_bson
from rowhaul.functions.json import encode
from rowhaul.functions.text import quoted, value_text
from rowhaul.operators.schema import check_names, require_columns
from rowhaul.sinks.committed import CommittedTable
from rowhaul.types import SINK_CAPABILITIES

KEYS = {"cosmosdb": ("id",), "mongodb": ("_id",), "azure-table-storage": ENTITY_KEYS}
DOCUMENT = "document"


class DocumentCollection(CommittedTable):
    """A collection with the key and typing rules of one document store.

    Rows are kept as their key columns (text) and the document (JSON text), so
    the key check reads the keys only.
    """

    case_sensitive = True
    stage = None  # a collection has no transactions

    def __init__(self, spark: SparkSession, path: str, store: str):
        super().__init__(spark, path)
        self.provider, self.keys = store, KEYS[store]
        self.capabilities = SINK_CAPABILITIES[store]

    def validate(self, schema: T.StructType) -> None:
        names = check_names(schema.fieldNames(), "destination columns", case_sensitive=True)
        missing = [k for k in self.keys if k not in names]
        if missing and self.provider != "mongodb":
            raise ValueError(f"{self.provider} records require {' and '.join(missing)}; map a source column to it")

    def prepare(self, schema: T.StructType, create: bool) -> None:
        """Create the collection if it is absent and ``create`` is set."""
        self.validate(schema)
        if not self.exists():
            if not create:
                raise ValueError(f"collection {self.path} does not exist")
            stored = T.StructType([*[T.StructField(k, T.StringType()) for k in self.keys], T.StructField(DOCUMENT, T.StringType())])
            storage.write_small(self.spark, f"{self.path}/_table.json", stored.json())

    def write(self, df: DataFrame, commit: str, info: dict | None = None) -> None:
        """Insert documents; nothing counts when a key is null, repeated or already stored.

        The documents are written once, and their written keys are what is checked.
        """
        if commit not in self.commits():
            super().write(self._documents(df), commit, info)

    def _accept(self, rows: DataFrame) -> None:
        clash = key_conflicts(rows, self.read() if self.commits() else None, list(self.keys)).limit(3).collect()
        if clash:
            shown = [{k: r[k] for k in (*self.keys, "reason")} for r in clash]
            raise ValueError(f"{self.provider} insert refused: {json.dumps(shown, ensure_ascii=False)}")

    def documents(self) -> DataFrame:
        """Stored documents as text, for ``document_scan``; ordered by key."""
        return self.read().select(*self.keys, F.col(DOCUMENT).alias("value"))

    def _documents(self, df: DataFrame) -> DataFrame:
        if self.provider == "azure-table-storage":
            kept = [f for f in df.schema.fields if f.name not in ENTITY_SYSTEM]
            df = df.select(*[entity_value(f).alias(f.name, metadata=f.metadata or {}) for f in kept])
            document = encode(df.schema.fields, extended=True)
        elif self.provider == "mongodb":
            if "_id" not in df.columns:
                df = df.withColumn("_id", F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 24))
            keys = [_key_text(f).alias(f"_key_{f.name}") for f in df.schema.fields if f.name in self.keys]
            df = df.select(*[to_bson(f).alias(f.name) for f in df.schema.fields], *keys)
            document = encode([f for f in df.schema.fields if not f.name.startswith("_key_")], nested=True)
            return df.select(*[F.col(quoted(f"_key_{k}")).alias(k) for k in self.keys], document.alias(DOCUMENT))
        else:
            document = encode(df.schema.fields, nested=True)
        fields = {f.name: f for f in df.schema.fields}
        return df.select(*[_key_text(fields[k]).alias(k) for k in self.keys], document.alias(DOCUMENT))


def _key_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.VariantType):
        return F.try_variant_get(quoted(field.name), "$", "string")
    return value_text(field)


def key_conflicts(new: DataFrame, stored: DataFrame | None, keys: list[str]) -> DataFrame:
    """Keys that keep an insert from happening, one row each with the reason.

    One aggregation over both sides' keys; counts combine before the shuffle,
    so a key repeated millions of times costs one row per task.
    """
    require_columns(new, keys)
    columns = [F.col(quoted(k)) for k in keys]
    marked = new.select(*columns, F.lit(1).alias("new"), F.lit(0).alias("old"))
    if stored is not None:
        marked = marked.unionByName(stored.select(*columns, F.lit(0).alias("new"), F.lit(1).alias("old")))
    counts = marked.groupBy(*columns).agg(F.sum("new").alias("new"), F.sum("old").alias("old"))
    missing = columns[0].isNull()
    for column in columns[1:]:
        missing = missing | column.isNull()
    reason = (
        F.when((F.col("new") > 0) & missing, "null key")
        .when((F.col("new") > 0) & (F.col("old") > 0), "existing key")
        .when(F.col("new") > 1, "repeated key")
    )
    return counts.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*columns, "reason", "new", "old")
