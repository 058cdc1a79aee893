"""Records that may cross file blocks, cut out in parallel.

Files are read as pieces that end at a separator: lines of a CSV, or what lies
up to a closing brace in a JSON array. A separator inside quotes does not end a
record. Whether a piece begins inside quotes depends on all quotes before it, so
each block is first summed up as what it does to that state: how often it flips,
and how many records end in it from either state. Sums over a file's blocks give
every block its state and the number of its first record. One shuffle by block
then numbers the pieces; pieces of a record that stays in its block are put
together where they are, and only those of records that cross a block edge
travel once more, by record number.

All of it is DataFrame expressions. The states are a table of one row for each
block, joined by file and block; nothing of it reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rowhaul import storage


def read_pieces(spark: SparkSession, path, separator: str) -> DataFrame:
    """Text between separators, with the file block each piece begins in and its place among the pieces of the task."""
    return spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seen"), "value",
    )


def block_states(pieces: DataFrame, flips: Column) -> DataFrame:
    """One row for each block: ``inside`` quotes at its start (0 or 1), records that end in it and before it, and in the whole file."""
    spark = pieces.sparkSession
    in_block = Window.partitionBy("file", "block").orderBy("seen")
    narrow = pieces.select("file", "block", "seen", flips.alias("flips"))
    sums = narrow.withColumn("odd", F.sum("flips").over(in_block) % 2).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.sum("odd").alias("odd"), F.sum("flips").alias("flips")
    )
    folder = storage.new_folder(spark, "blocks")
    sums.write.parquet(folder)
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = spark.read.parquet(folder).withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    counted = entered.withColumn("ends", F.when(F.col("inside") == 0, F.col("n") - F.col("odd")).otherwise(F.col("odd")))
    return counted.select(
        "file", "block", "inside", "ends", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("before"), F.sum("ends").over(whole).alias("total")
    )


def joined_records(pieces: DataFrame, flips: Column, separator: str) -> DataFrame:
    """(file, number, total, text) of every record: its number in the file from 1 on, and how many the file has."""
    in_block = Window.partitionBy("file", "block").orderBy("seen")
    moved = F.raise_error(F.lit("the file splits changed between two passes; keep the session's split settings")).cast("int")
    placed = pieces.withColumn("flips", flips).join(block_states(pieces, flips), ["file", "block"], "left")
    placed = placed.withColumn("state", (F.coalesce("inside", moved) + F.sum("flips").over(in_block)) % 2)
    ended = (F.col("state") == 0).cast("int")
    numbered = placed.withColumn("number", F.col("before") + F.sum(ended).over(in_block) - ended + 1)
    crosses = ((F.col("inside") == 1) & (F.col("number") == F.col("before") + 1)) | (F.col("number") > F.col("before") + F.col("ends"))
    parts = F.array_sort(F.collect_list(F.struct("block", "seen", "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"]), separator).alias("text")
    total = F.max("total").alias("total")
    within = numbered.where(~crosses).groupBy("file", "block", "number").agg(text, total).drop("block")
    across = numbered.where(crosses).groupBy("file", "number").agg(text, total)
    return within.unionByName(across).select("file", "number", "total", "text")
