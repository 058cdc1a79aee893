"""Quality by importance resampling.

Two generative models of hashed word unigrams and bigrams, one of target texts
and one of all texts, give each document a log likelihood ratio for each
n-gram. Adding Gumbel noise to it and taking the largest draws a sample of
documents in proportion to their importance, without replacement. The sample has
as many documents as the corpus is estimated to have target documents: the share
of target documents among all labelled ones, times all documents.

The model of all texts counts every document, and that of the target every
document whose label is in a bounded sample of labels (``LABELS``). Counts are
summed within tasks and combined before the shuffle; only ``BUCKETS`` sums reach
the driver. The k largest keys are found from sums over parts of the key range.

Defined results: a text without words (or null) has log_weight null and is not
kept; with no target label there is nothing to choose by: all weights are 0 and
all documents with words are kept; a document labelled twice is a target if one
of its labels says so; equal rows draw equal noise; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.select import within_budget
from rowhaul.llm.words import Words, pieces, window_hashes, windows_within

BUCKETS = 1 << 14
LABELS = 20_000
#: N-grams that a document's mean log ratio counts as.
SCALE = 50.0
SEED = 3


def _grams(column) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, bucket) of every unigram and bigram."""
    words = Words(column)
    hashes, of = words.hashes(lower=True), words.text_of()
    pairs = window_hashes(hashes, 2)
    inside = np.flatnonzero(windows_within(words.first, 2, len(pairs)))
    buckets = np.concatenate([hashes, pairs[inside]]) >> np.uint64(50)
    return np.concatenate([of, of[inside]]), buckets.astype(np.int64), len(words.counts)


def _count(batches):
    all_counts, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches):
        of, buckets, _ = _grams(batch.column(0))
        wanted = np.asarray(batch.column(1).fill_null(False))
        all_counts += np.bincount(buckets, minlength=BUCKETS)
        target += np.bincount(buckets[wanted[of]], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS), pa.int32()), pa.array(all_counts), pa.array(target)], names=["bucket", "n_all", "n_target"])


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """Log ratio of target to all for each bucket, smoothed by one."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    some = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELS).withColumn("wanted", F.lit(True))
    marked = docs.join(F.broadcast(some.withColumnRenamed("doc_id", "_id")), F.col(doc_id) == F.col("_id"), "left").select(F.col(text).alias("text"), "wanted")
    counts = marked.mapInArrow(_count, "bucket int, n_all long, n_target long").groupBy("bucket").agg(F.sum("n_all"), F.sum("n_target")).collect()
    sums = np.zeros((2, BUCKETS))
    for bucket, n_all, n_target in counts:
        sums[:, bucket] = n_all, n_target
    if not sums[1].any():
        return np.zeros(BUCKETS)
    smooth = np.log(sums + 1) - np.log((sums + 1).sum(axis=1, keepdims=True))
    return smooth[1] - smooth[0]


def target_share(labels: DataFrame) -> float:
    """Share of target documents among all labelled ones; 1 if none is a target."""
    each = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("IF(quality = 1, 1, 0)")).alias("target"))
    return each.agg(F.avg("target")).first()[0] or 1.0


def importance_sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", kept: float | None = None, seed: int = SEED) -> DataFrame:
    """One row for each document: doc_id, log_weight, gumbel_key, kept. ``labels`` has doc_id and quality (1: target).

    ``kept`` is the share of the documents with words that the sample holds; without it the labels tell its size.
    """
    ratios = log_ratios(docs, labels, doc_id, text)

    def score(batches):
        for batch in pieces(batches):
            of, buckets, n = _grams(batch.column(1))
            number = np.bincount(of, minlength=n)
            mean = np.bincount(of, ratios[buckets], minlength=n) / np.maximum(number, 1)
            weight = pa.array(mean * SCALE, pa.float64(), mask=number == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), weight], names=["doc_id", "draw", "log_weight"])

    kind = docs.schema[doc_id].dataType.simpleString()
    drawn = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text), F.lit(seed)).alias("draw"))
    scored = drawn.mapInArrow(score, f"doc_id {kind}, draw long, log_weight double")
    uniform = (F.shiftrightunsigned("draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    keyed = scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    # the largest keys first, mapped in order to 0..1; a null key comes last
    ordered = keyed.withColumn("key", F.coalesce(0.5 - F.atan(F.col("gumbel_key") / 20) / F.lit(np.pi), F.lit(1.0))).withColumn("one", F.lit(1).cast("long"))
    # one group, said so that its join has a key to compare
    ordered = ordered.withColumn("group", F.pmod("draw", F.lit(1).cast("long")))
    # documents without words are never targets, yet labelled like all others
    size = F.count("log_weight") * F.lit(kept) if kept is not None else F.least(F.round(F.count("*") * F.lit(target_share(labels))), F.count("log_weight"))
    budget = scored.groupBy().agg((F.floor(size) + F.lit(0.0)).alias("budget"), F.pmod(F.count("*"), F.lit(1).cast("long")).alias("group"))
    picked = within_budget(ordered, budget, "group", "key", "one", ["draw"])
    return picked.select("doc_id", "log_weight", "gumbel_key", (F.col("picked") & F.col("log_weight").isNotNull()).alias("kept"))
