"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A document's id gives it a place on a ring of fixed places. Going clockwise, the
first virtual node owns it. Every shard has a capacity, floor or ceiling of the
mean, so that all capacities add up to the number of documents. A shard takes
the documents of its arcs in a fixed order until it is full; those that overflow
continue clockwise to the next virtual node of a shard with room. So counts
differ by at most one, and a document away from the overflow stays where its own
place puts it when the number of shards changes.

Only counts for each arc, the stretch that one virtual node owns, reach the
driver: their number is shards times virtual nodes, whatever the data. The plan
made of them says which ranks of an arc go to which shard, from which slot on.

Ranks need no arc in one task. Equal rows are counted first, combined before the
shuffle, and stand for each other. An arc is cut into ``PARTS`` parts by a hash of
the whole row, so one id with many texts spreads; a rank is the sum of the parts
before it and a place within the part. Rows counted together get their ranks
by blocks of ``BLOCK``, spread over tasks where there are several.

Defined results: a null text has size 16 and the checksum of no bytes; null and
repeated ids have a place like any other; equal rows take neighbouring slots;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowhaul.llm.frames import written

SHARDS = 40
NODES = 64
#: Places on the ring.
PLACES = 1 << 16
#: Parts of an arc, each ranked by itself.
PARTS = 1024
#: Equal rows that are numbered together.
BLOCK = 1 << 16


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise; of two nodes at one place the one of the lower shard stays."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for node in range(nodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8], "big") % PLACES
            at.setdefault(place, shard)
    return sorted(at.items())


def deal(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Spans (arc, first rank, end rank, shard, slot of the first) that give every shard its capacity."""
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, spans, overflow = [0] * shards, [], []

    def put(arc: int, rank: int, shard: int, n: int) -> None:
        spans.append((arc, rank, rank + n, shard, used[shard]))
        used[shard] += n

    for arc, n in enumerate(counts):
        own = min(n, room[owners[arc]] - used[owners[arc]])
        if own:
            put(arc, 0, owners[arc], own)
        if n > own:
            overflow.append((arc, own, n))
    for arc, rank, end in overflow:
        node = arc
        while rank < end:
            node = (node + 1) % len(owners)
            n = min(end - rank, room[owners[node]] - used[owners[node]])
            if n:
                put(arc, rank, owners[node], n)
                rank += n
    return spans


def arc_of_places(spark: SparkSession, places: list[int]) -> DataFrame:
    """The arc of each place: that of the first node at it or behind it; places behind the last node belong to the first."""
    ends = [*places, PLACES - 1]
    stretches = ",".join(f"{a + 1}:{b}:{k % len(places)}" for k, (a, b) in enumerate(zip([-1, *ends], ends)) if a < b)
    rows = spark.range(1).select(F.explode(F.split(F.lit(stretches), ",")).alias("s"))
    part = lambda k: F.split_part("s", F.lit(":"), F.lit(k)).cast("int")
    return rows.select(F.explode(F.sequence(part(1), part(2))).alias("place"), part(3).alias("arc"))


def spans_of(spark: SparkSession, spans: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The plan as a table."""
    rows = spark.range(1).select(F.explode(F.split(F.lit(",".join(":".join(map(str, s)) for s in spans)), ",")).alias("s")).where("s != ''")
    names = (("_arc", "int"), ("first", "long"), ("end", "long"), ("shard", "int"), ("slot0", "long"))
    return rows.select(*(F.split_part("s", F.lit(":"), F.lit(k)).cast(t).alias(n) for k, (n, t) in enumerate(names, 1)))


def shard(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law has none)."""
    spark = df.sparkSession
    nodes_at = ring(shards, nodes)
    places, owners = [p for p, _ in nodes_at], [s for _, s in nodes_at]
    content = F.coalesce(F.col(text), F.lit(""))
    docs = df.select(F.col(doc_id).alias("doc_id"), (F.octet_length(content) + 16).cast("long").alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"))
    hashed = F.xxhash64(F.lit("place"), F.col("doc_id"))
    # equal rows are one row with their number
    rows = docs.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("place", F.pmod(hashed, F.lit(PLACES)).cast("int"))
    rows = rows.join(F.broadcast(arc_of_places(spark, places)), "place").drop("place")
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)).cast("int")), "ring")
    parts = rows.groupBy("arc", "part").agg(F.sum("n").alias("sum"))
    counts = [0] * len(places)
    for arc, n in parts.groupBy("arc").agg(F.sum("sum")).collect():
        counts[arc] = n
    before = lambda amount, window: F.coalesce(F.sum(amount).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = parts.select("arc", "part", before("sum", Window.partitionBy("arc").orderBy("part")).alias("ahead"))
    inside = before("n", Window.partitionBy("arc", "part").orderBy("doc_id", "size", "text_crc32"))
    ranked = rows.withColumn("inside", inside).join(ahead, ["arc", "part"]).withColumn("from", F.col("ahead") + F.col("inside"))
    ranked = ranked.select("doc_id", "size", "text_crc32", "arc", "from", "n")
    # a block of equal rows for each task at a time
    blocks = ranked.where(F.col("n") > BLOCK).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK).cast("long"))))
    blocks = blocks.select("doc_id", "size", "text_crc32", "arc", (F.col("from") + F.col("block")).alias("from"), F.least(F.col("n") - F.col("block"), F.lit(BLOCK)).alias("n"))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id", "size", "text_crc32", "from")
    numbered = ranked.where(F.col("n") <= BLOCK).unionByName(blocks).withColumn("rank", F.explode(F.sequence("from", F.col("from") + F.col("n") - 1)))
    spans = F.broadcast(spans_of(spark, deal(counts, owners, shards)))
    return numbered.join(spans, (F.col("arc") == F.col("_arc")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
