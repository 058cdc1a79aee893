"""Centroid clustering of integer vectors by bit planes.

A component x becomes the integer floor(64 x). Bit b of all 64 components of a
vector is one unsigned 64-bit word, its plane b; as many planes are kept as the
vector's integers need in two's complement, so the last one has a negative
weight. The dot product of a vector and a centroid is the sum, over every pair
of planes, of the weights' product times the number of ones in the planes' AND;
with both squared lengths it gives the exact squared distance. Component sums
of a cluster are counts of ones, weighted likewise.

How it is spread. Vectors are packed once into a table in the shared folder,
about a quarter of what they were; every round reads that. A task adds up its
vectors for each cluster, so a round shuffles clusters times components numbers
a task, and as many reach the driver, which are the new centroids.

Defined results: vectors that are null, of another length or with a null or
non-finite component have no row; a component beyond 2**21 either way counts as
that bound, as no squared distance beyond would surely fit a long; vectors
without an id are seeds last; with fewer vectors than clusters each is a seed;
equal rows are vectors of their own; an inertia beyond a long is null; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.frames import written
from rowhaul.llm.words import pieces

COMPONENTS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Largest integer of a component, as a power of two.
BITS = 27

_RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def planes_of(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 64) integers as (n, p) planes, and how many of the p each row needs (the rest repeat its last)."""
    size = np.where(ints < 0, ~ints, ints).max(axis=1, initial=0)
    need = np.ceil(np.log2(size + 1.0)).astype(np.int64) + 1
    most = int(need.max(initial=1))
    bits = (ints[:, None, :] >> np.arange(most)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0], need


def weights(n: int) -> np.ndarray:
    """Weight of each of n planes in two's complement."""
    out = np.int64(1) << np.arange(n, dtype=np.int64)
    out[-1] = -out[-1]
    return out


def dots(planes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Dot products of vectors (n, p) and centroids (k, q), from popcounts of every pair of planes."""
    out = np.zeros((len(planes), len(others)), np.int64)
    for a, wa in enumerate(weights(planes.shape[1])):
        for b, wb in enumerate(weights(others.shape[1])):
            out += np.bitwise_count(planes[:, a, None] & others[None, :, b]) * (wa * wb)
    return out


def _unpacked(column) -> np.ndarray:
    """Planes of a batch, all with as many as the widest: a row's last plane repeats."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) // 8
    need = np.diff(offsets)
    flat = np.frombuffer(data, np.uint64, int(offsets[-1]))
    return flat[offsets[:-1, None] + np.minimum(np.arange(need.max(initial=1)), need[:, None] - 1)]


def _pack(batches):
    for batch in pieces(batches):
        vectors = batch.column(1)
        fit = np.flatnonzero(np.asarray(vectors.is_valid()) & (np.asarray(vectors.value_lengths().fill_null(0)) == COMPONENTS))
        vectors = vectors.take(pa.array(fit))
        inner = vectors.flatten()
        values = np.asarray(inner.fill_null(np.nan), np.float64).reshape(-1, COMPONENTS)
        good = np.isfinite(values).all(axis=1)
        ints = np.floor(np.clip(values[good], -(2.0 ** (BITS - 6)), 2.0 ** (BITS - 6) - 1 / SCALE) * SCALE).astype(np.int64)
        planes, need = planes_of(ints)
        kept = planes[np.arange(planes.shape[1]) < need[:, None]]
        offsets = np.concatenate([[0], np.cumsum(need * 8)]).astype(np.int64)
        packed = pa.Array.from_buffers(pa.large_binary(), len(need), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])
        ids = batch.column(0).take(pa.array(fit[good]))
        yield pa.RecordBatch.from_arrays([ids, packed.cast(pa.binary()), pa.array((ints * ints).sum(axis=1))], names=["vec_id", "planes", "norm"])


class Centroids:
    """Integer centroids and their planes."""

    def __init__(self, ints: np.ndarray):
        self.ints = ints
        self.planes, _ = planes_of(ints)
        self.norms = (ints * ints).sum(axis=1)

    def nearest(self, planes: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of vectors; of equally near centroids the first."""
        far = norms[:, None] + self.norms - 2 * dots(planes, self.planes)
        best = far.argmin(axis=1)
        return best, far[np.arange(len(best)), best]


def component_sums(planes: np.ndarray, cluster: np.ndarray, clusters: int) -> np.ndarray:
    """(clusters, 64) sums of the vectors' integers: ones of each plane, by weight."""
    member = (cluster == np.arange(clusters)[:, None]).astype(np.float64)
    out = np.zeros((clusters, COMPONENTS), np.int64)
    for a, w in enumerate(weights(planes.shape[1])):
        ones = np.unpackbits(np.ascontiguousarray(planes[:, a]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += (member @ ones).astype(np.int64) * w
    return out


def _assigned(packed: DataFrame, centroids: Centroids):
    def blocks(batches):
        for batch in pieces(batches):
            if batch.num_rows:
                planes, norms = _unpacked(batch.column(1)), batch.column(2).to_numpy()
                yield batch, planes, *centroids.nearest(planes, norms)

    return blocks


def _moved(packed: DataFrame, centroids: Centroids) -> Centroids:
    """Every centroid that has vectors replaced by the floor of their mean."""
    k, blocks = len(centroids.ints), _assigned(packed, centroids)

    def add(batches):
        sums, number = np.zeros((k, COMPONENTS), np.int64), np.zeros(k, np.int64)
        for _, planes, cluster, _ in blocks(batches):
            sums += component_sums(planes, cluster, k)
            number += np.bincount(cluster, minlength=k)
        cells = np.concatenate([sums, number[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells.size), pa.int32()), pa.array(cells.ravel())], names=["cell", "amount"])

    totals = [0] * (k * (COMPONENTS + 1))
    for cell, amount in packed.mapInArrow(add, "cell int, amount long").groupBy("cell").agg(F.sum(F.col("amount").cast("decimal(38,0)"))).collect():
        totals[cell] = int(amount)
    rows = [totals[c * (COMPONENTS + 1) : (c + 1) * (COMPONENTS + 1)] for c in range(k)]
    return Centroids(np.array([[x // row[-1] for x in row[:-1]] if row[-1] else list(old) for row, old in zip(rows, centroids.ints)], np.int64).reshape(k, COMPONENTS))


def _inertias(packed: DataFrame, centroids: Centroids) -> list[int]:
    blocks, k = _assigned(packed, centroids), len(centroids.ints)

    def add(batches):
        # halves, so that no sum of a task overflows
        sums = np.zeros((k, 2), np.int64)
        for _, _, cluster, distance in blocks(batches):
            np.add.at(sums, cluster, np.stack([distance >> 32, distance & 0xFFFFFFFF], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["cluster", "high", "low"])

    whole = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("high", "low")]
    out = [0] * k
    for cluster, high, low in packed.mapInArrow(add, "cluster int, high long, low long").groupBy("cluster").agg(*whole).collect():
        out[cluster] = (int(high) << 32) + int(low)
    return out


def seeds(packed: DataFrame, clusters: int, seed: int) -> Centroids:
    """The vectors whose seed and id have the least SHA-256."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = packed.select("planes", "vec_id", drawn.alias("drawn")).orderBy(F.col("drawn").asc_nulls_last(), "vec_id", "planes").limit(clusters).collect()
    ints = np.zeros((len(first), COMPONENTS), np.int64)
    for c, row in enumerate(first):
        planes = np.frombuffer(bytes(row.planes), np.uint64)
        for a, w in enumerate(weights(len(planes))):
            ints[c] += np.unpackbits(planes[a : a + 1].view(np.uint8), bitorder="little").astype(np.int64) * w
    return Centroids(ints)


def cluster_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """One row for each vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kind = df.schema[vec_id].dataType.simpleString()
    plain = df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    packed = written(plain.mapInArrow(_pack, f"vec_id {kind}, planes binary, norm long"), "planes")
    centroids = seeds(packed, clusters, seed)
    k = len(centroids.ints)
    if not k:
        return packed.selectExpr("vec_id", *(f"CAST(NULL AS {x.split()[1]}) AS {x.split()[0]}" for x in _RESULT.split(", "))).limit(0)
    for _ in range(rounds):
        centroids = _moved(packed, centroids)
    each = _inertias(packed, centroids)
    fitting = lambda n: n if n < 1 << 63 else None
    own, everything = pa.array([fitting(n) for n in each], pa.int64()), fitting(sum(each))
    names = pa.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.ints.tolist()])
    blocks = _assigned(packed, centroids)

    def rows(batches):
        for batch, _, cluster, distance in blocks(batches):
            at = pa.array(cluster)
            columns = [batch.column(0), at.cast(pa.int32()), pa.array(distance), own.take(at), pa.array([everything] * len(cluster), pa.int64()), names.take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", *(x.split()[0] for x in _RESULT.split(", "))])

    return packed.mapInArrow(rows, f"vec_id {kind}, {_RESULT}")
