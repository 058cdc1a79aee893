"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.frames import written


def _least(edges: DataFrame) -> DataFrame:
    """For each u the least v, combined before the shuffle, joined back to the edges."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node with a link.

    Each round points the larger neighbours of a node, then its smaller ones, to
    the least of them; rounds are few even for long chains. Nothing of the graph
    comes to the driver but a count and a checksum; every round is written to
    the shared folder.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges, before = written(edges, "links"), None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before or now[0] == 0:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = _least(large).select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = written(small.select("e.u", "e.v").where("u > v").distinct(), "links")
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
