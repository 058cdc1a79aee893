"""Which sets of shingles become candidates, and what stays on disk on the way."""

import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rowhaul.llm import shingles
from rowhaul.llm.frames import written

NONE = np.zeros(1 << shingles._COUNTERS, bool)


def shuffled_files(spark) -> int:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_written_rows_leave_no_shuffle_files(spark):
    before = shuffled_files(spark)
    counts = spark.range(100_000).groupBy((F.col("id") % 1000).alias("key")).count()
    out = written(counts.join(counts.withColumnRenamed("count", "other"), "key"), "freed")
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    for _ in range(50):
        if shuffled_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffled_files(spark) <= before
    assert setting in (None, "false")
    assert out.count() == 1000 and out.agg(F.sum("count"), F.sum("other")).first() == (100_000, 100_000)


def candidates(monkeypatch, df, **how):
    """Pairs as they reach the components, and members of groups."""
    pairs, members = [], []
    components, tiles = shingles.connected_components, shingles._tiles

    def first_pairs(edges, *ends):
        pairs.append(edges.count())
        return components(edges, *ends)

    def first_members(rows, block):
        members.append(rows.count())
        return tiles(rows, block)

    monkeypatch.setattr(shingles, "connected_components", first_pairs)
    monkeypatch.setattr(shingles, "_tiles", first_members)
    out = shingles.near_duplicates(df, **how)
    return out, pairs[0], members[0]


def test_unlike_texts_are_hardly_candidates(spark, monkeypatch):
    """A shingle that two unlike texts share fills a cell alone here and there; groups of such texts would soon hold the whole table."""
    rng = random.Random(11)
    phrases = [" ".join(f"p{rng.randrange(1 << 40)}" for _ in range(5)) for _ in range(1500)]
    texts = []
    for _ in range(1500):
        parts = [" ".join(f"v{rng.randrange(1 << 40)}" for _ in range(rng.randrange(2, 30))) for _ in range(8)]
        texts.append(" ".join(x for part in parts for x in (part, rng.choice(phrases))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out, _, members = candidates(monkeypatch, df, n=5, num=80, den=100)
    assert members < 120
    assert out.where("component_id = doc_id").count() == 1500


def test_copies_meet_once(spark, monkeypatch):
    text = " ".join(f"v{k}" for k in range(300))
    df = spark.createDataFrame([(1000 + k, text) for k in range(64)], "doc_id long, text string").repartition(8)
    monkeypatch.setattr(shingles, "BUCKET", 64)
    out, pairs, members = candidates(monkeypatch, df, n=5, num=80, den=100)
    assert (pairs, members) == (0, 0)
    assert {r.component_id for r in out.collect()} == {1000}


def test_linked_sets_share_a_key():
    rng = random.Random(12)
    for num, den, n in ((80, 100, 1), (85, 100, 1)):
        bands = shingles.Bands(num, den)
        for _ in range(400):
            size = rng.randrange(1, 400)
            common = [f"c{rng.randrange(1 << 40)}" for _ in range(size)]
            # as many elements in one of them only as a link allows
            own = [f"d{k}" for k in range(size * (den - num) // num)]
            cut = rng.randrange(len(own) + 1)
            texts = [" ".join(common + own[:cut]), " ".join(common + own[cut:])]
            sets = shingles.Sets(pa.array(texts), n)
            if sets.names()[0] == sets.names()[1]:
                continue
            both = len(np.intersect1d(*sets.sets))
            assert den * both >= num * (sets.sizes.sum() - both)
            flags = NONE.copy()
            flags[rng.randrange(2) :: 2] = True
            for shared in (NONE, flags):
                keys, owner = sets.keys(bands, shared)
                assert len(np.intersect1d(keys[owner == 0], keys[owner == 1]))


def test_packed_values_come_back():
    values = np.array([0, 1, (1 << 40) - 1, 1 << 39], np.uint64)
    assert shingles._unpacked([shingles._packed(values[:1], 5).tobytes(), b"", shingles._packed(values[1:], 5).tobytes()], 5, np.uint64).tolist() == values.tolist()
    assert len(shingles._unpacked([], 6, np.int64)) == 0
