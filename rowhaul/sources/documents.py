"""Document scans: JSON documents whose first one fixes the columns.

A collection is a set of JSON objects, one per line of text or one per row of
a column. Later documents may lack columns (null) or have more (dropped);
nested values stay JSON, as variants.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowhaul.functions.documents import ENTITY_KEYS, bson_value, json_value
from rowhaul.functions.json import RECORD, is_blank, one_record, parse_line
from rowhaul.functions.text import quoted
from rowhaul.operators.schema import check_names

# Columns of an empty result, per store (fixed values).
EMPTY_COLUMNS = {"cosmosdb": ("id",), "mongodb": ("_id",), "azure-table-storage": ENTITY_KEYS}

# How each store's values read. Table entities are typed scalars, kept in the same wrappers.
_TYPING: dict[str, Callable[[Column], Column]] = {
    "cosmosdb": json_value, "mongodb": bson_value, "azure-table-storage": bson_value,
}


def read_documents(spark: SparkSession, path) -> DataFrame:
    """Text lines of a collection stored as JSON Lines, ready for ``document_scan``."""
    return spark.read.text(path).where(~is_blank("value")).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def document_scan(
    documents: DataFrame,
    store: str = "cosmosdb",
    predicate: Column | str | None = None,
    order_by: list[str | Column] | None = None,
    value: str = "value",
    names: list[str] | None = None,
    typed: bool = True,
) -> DataFrame:
    """Documents that satisfy ``predicate`` as rows of variant columns.

    The predicate sees the parsed document as ``doc``, e.g.
    ``try_variant_get(doc, '$.status', 'string') = 'open'``. The first document
    is the first by ``order_by`` (columns of ``documents``), by file and place
    for ``read_documents``; partial aggregates find it.
    """
    matching = documents
    if predicate is not None:
        matching = documents.withColumn("doc", F.try_parse_json(value)).where(predicate).drop("doc")
    if names is None:
        names = first_document_names(matching, store, order_by, value)
    check_names(names)
    record = F.coalesce(
        one_record("parsed", value), F.raise_error(F.concat(F.lit("not a JSON document: "), F.left(value, F.lit(80)))).cast(RECORD)
    )
    typing = _TYPING[store] if typed else (lambda v: v)
    parsed = matching.select(value, parse_line(value).alias("parsed")).select(record.alias("record"))
    return parsed.select(*[typing(F.try_element_at("record", F.lit(n))).alias(n) for n in names])


def first_document_names(
    documents: DataFrame, store: str = "cosmosdb", order_by: list[str | Column] | None = None, value: str = "value"
) -> list[str]:
    """Property names of the first document; the store's key columns when there is none."""
    if order_by is None:
        if not {"file", "block", "place"} <= set(documents.columns):
            raise ValueError("order_by is needed to tell which document comes first")
        first = documents.agg(F.min_by(value, F.struct("file", "block", "place")).alias("doc"))
    else:
        # The keys alone find the first document; then one row is fetched with its text.
        keys = [F.col(quoted(k)) if isinstance(k, str) else k for k in order_by]
        least = documents.agg(F.min(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])).alias("least")).first().least
        if least is None:
            first = documents.limit(0).select(F.col(value).alias("doc"))
        else:
            same = [k.eqNullSafe(F.lit(v)) for k, v in zip(keys, least)]
            first = documents.where(reduce(lambda a, b: a & b, same)).limit(1).select(F.col(value).alias("doc"))
    row = first.select(F.json_object_keys("doc").alias("names")).first()
    names = list(row.names) if row and row.names else list(EMPTY_COLUMNS[store])
    if store == "azure-table-storage":
        names = [*ENTITY_KEYS, *[n for n in names if n not in ENTITY_KEYS]]
    return names


def public_connector_options(store: str, **options: str) -> tuple[str, dict[str, str]]:
    """Format name and options for the public Spark connectors, for sessions that have their jars."""
    if store == "cosmosdb":
        return "cosmos.oltp", {
            "spark.cosmos.accountEndpoint": options["endpoint"], "spark.cosmos.accountKey": options["key"],
            "spark.cosmos.database": options["database"], "spark.cosmos.container": options["collection"],
            **({"spark.cosmos.read.customQuery": options["query"]} if "query" in options else {}),
            "spark.cosmos.write.strategy": "ItemAppend",
        }
    if store == "mongodb":
        return "mongodb", {
            "connection.uri": options["uri"], "database": options["database"], "collection": options["collection"],
            **({"aggregation.pipeline": '[{"$match": ' + options["filter"] + "}]"} if options.get("filter") else {}),
            "operationType": "insert", "ordered": "true",
        }
    raise ValueError(f"no public Spark connector for '{store}'")
