"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key whose rate is its quality weight; in key
order a source's documents are a weighted sample without replacement. A
source's target is met by complete epochs first, then by the documents whose
running size, in key order, fits what is left; a document larger than what is
left is passed over. Keys come from a hash of the id, the text and a seed, so
reruns agree.

All of it is DataFrame expressions. Texts are read once; sizes and keys are
written to the shared folder. Sizes are summed for each source and key part
before any shuffle; only the part of a source in which its budget ends is
ordered, so a source with most of the rows is no one task's load.

Defined results: a null text has size 0; documents of size 0 are taken 0 words;
a null source is a source of its own, the last one; equal rows draw equal keys
and one may be taken without the other; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowhaul.llm.frames import written
from rowhaul.llm.select import fill_budget

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 20


def quality_weight(chars: F.Column, words: F.Column) -> F.Column:
    """Between 0.2 and 1: less for texts whose words are far from usual lengths, as in tables, keys and run-together text."""
    mean = F.coalesce(chars, F.lit(0)) / F.greatest(words, F.lit(1))
    return F.greatest(F.lit(0.2), 1 / (1 + F.abs(mean - 7) / 7))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``target`` for each row (source, source_size): a share of all sizes by weight, none above ``epochs`` times its size.

    Sources fill up in order of size over weight. With the first k full, the
    others share what is left by weight; k is right when the next is not full.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(float(epochs))
    level = (F.col("total") * share - F.col("full")) / F.col("open")
    below = fill.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        sizes.withColumn("weight", pick)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum(cap).over(below), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
        .withColumn("level", level)
        # the level holds from the first source on that is not full at it
        .withColumn("place", F.row_number().over(fill))
        .withColumn("final", F.min(F.when(cap > F.col("level") * F.col("weight"), F.struct("place", "level"))).over(everything)["level"])
    )
    return filled.select("source", "source_size", F.least(cap, F.coalesce(F.col("final") * F.col("weight"), cap)).alias("target"))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """One row for each document: doc_id, size, source, source_size, target, taken, times (how often it is taken)."""
    t, size = F.col(text), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    tie = F.xxhash64(t, F.lit(seed + 1))
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), tie.alias("tie"), F.length(t).alias("chars"),
                     F.xxhash64(F.col(doc_id), t, F.lit(seed)).alias("draw"))
    uniform = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    weight = quality_weight(F.col("chars"), F.col("size"))
    # an exponential key of rate w, mapped in order to 0..1
    keyed = written(docs.withColumn("key", 1 - F.exp(F.log(uniform) / weight / 4)).drop("draw", "chars").withColumn("row", F.monotonically_increasing_id()), "keys")
    goals = targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")))
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(F.lit(0)))
    goals = goals.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
    goals = written(goals, "goals")
    picked = fill_budget(keyed, goals, "source", "key", "size", ["doc_id", "tie"], "row")
    g = goals.select(F.col("source").alias("_source"), "source_size", "target", "epochs")
    times = F.when(F.col("size") > 0, F.col("epochs") + F.when(F.col("picked") & (F.col("epochs") < EPOCHS), 1).otherwise(0)).otherwise(F.lit(0))
    return (
        picked.join(g, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("times", times.cast("long"))
        .select("doc_id", "size", "source", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "tie")
    )


def apply_mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; rows taken 0 times go."""
    taken = mix(df, doc_id, text, source, seed).groupBy(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("source").alias("_source"))
    taken = taken.agg(F.sum("times").alias("_times"), F.count("*").alias("_rows")).where("_times > 0")
    rows = df.withColumn("_hash", F.xxhash64(F.col(text), F.lit(seed + 1))).join(
        taken, F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")) & F.col(source).eqNullSafe(F.col("_source"))
    )
    # equal rows share what they are taken together; the first ones, by their other columns, get the rest
    several = Window.partitionBy("_id", "_tie", "_source").orderBy(F.xxhash64(F.to_json(F.struct(*(F.col(c) for c in df.columns)))))
    alone = rows.where("_rows = 1").withColumn("_n", F.col("_times"))
    shared = rows.where("_rows > 1").withColumn("_rank", F.row_number().over(several))
    shared = shared.withColumn("_n", F.floor(F.col("_times") / F.col("_rows")) + (F.col("_rank") <= F.col("_times") % F.col("_rows")).cast("long"))
    both = alone.select(*df.columns, "_n").unionByName(shared.where("_n > 0").select(*df.columns, "_n"))
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*df.columns)
