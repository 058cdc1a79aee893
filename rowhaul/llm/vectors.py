"""Near-duplicate vectors by collision-counting projections.

Vectors are brought to length one. On a random line, two vectors whose cosine is
the threshold lie a known spread apart; a window of half-width ``WINDOW`` around
the one then holds the other with a known chance. Over many lines the number of
windows in which a pair collides tells near pairs from others, and the least
number to pass is set from the binomial distribution so that a pair right at the
threshold passes with the chance ``RECALL``. Pairs that pass are verified with
exact cosines in double precision.

A window holds a fixed share of all vectors, so lines over the whole table would
count a square number of collisions. Sides of some further lines cut the vectors
into cells first, in several tables; how many cells and tables follows from the
number of vectors, so that cells keep their size and a pair at the threshold
meets in some table with the chance ``MEET``. Within a cell each line is sorted
and the window around every vector is counted.

Equal vectors are one class that goes on once. Large cells are cut into blocks
and compared block by block, so no task holds a cell and no pair leaves a task:
tiles report sums of links and links that connect. A pair that meets in several
tables counts in the first.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; so do vectors of different lengths with each
other. A null id has null results but counts as a linked vector, and links pass
through it; a component is named by the least id that is not null. Equal rows are
separate vectors. Other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.components import connected_components
from rowhaul.llm.frames import written

LINES = 48
WINDOW = 0.55
RECALL = 0.99
MEET = 0.97
#: Vectors in a cell, about, and most of them in a block.
CELL = 48
BLOCK = 512
#: Pairs on all lines that are listed at once.
PAIRS = 1 << 18


def calibrated(threshold: float, lines: int, window: float, recall: float) -> int:
    """The least number of collisions that a pair at the threshold has with the chance ``recall``."""
    spread = math.sqrt(2 * (1 - threshold))
    hit = math.erf(window / spread / math.sqrt(2))
    below = 0.0
    for k in range(lines + 1):
        below += math.comb(lines, k) * hit**k * (1 - hit) ** (lines - k)
        if below > 1 - recall:
            return k
    return lines


def layout(vectors: int, threshold: float) -> tuple[int, int]:
    """(bits of a cell, tables) for so many vectors."""
    bits = max(1, math.ceil(math.log2(max(2, vectors) / CELL)))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - MEET) / math.log(1 - together))) if together < 1 else 1


@lru_cache(maxsize=16)
def _lines(dim: int, number: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, number))


def unit(vector) -> np.ndarray | None:
    """The vector at length one, or None if it has no direction."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    size = np.abs(v).max()
    if not np.isfinite(size) or size == 0:
        return None
    v = v / size
    return v / math.sqrt(float(v @ v))


def _cells(bits: int, tables: int):
    def run(batches):
        for batch in batches:
            # vectors of a batch by their length
            groups: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, v in enumerate(map(unit, batch.column(1).to_pylist())):
                if v is not None:
                    groups.setdefault(len(v), []).append((i, v))
            for dim, rows in groups.items():
                x = np.stack([v for _, v in rows])
                sides = (x @ _lines(dim, bits * tables, 1) > 0).reshape(len(rows), tables, bits)
                cells = (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2) * 65536 + dim
                take = pa.array([i for i, _ in rows])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(2).take(take), pa.array(list(x.astype(np.float64))), pa.array(list(cells))], names=["node", "number", "unit", "cells"]
                )

    return run


def collisions(values: np.ndarray, window: float) -> np.ndarray:
    """For all pairs of rows, on how many lines (columns) the one lies in the window around the other.

    Most cells are small, so that steps count more than rows: lines are taken
    together, as many as keep the lists of pairs short.
    """
    m, lines = values.shape
    counts = np.zeros(m * m, np.int64)
    together = max(1, PAIRS // max(1, m * m))
    for k in range(0, lines, together):
        some = values[:, k : k + together]
        order = np.argsort(some, axis=0)
        ordered = np.take_along_axis(some, order, axis=0)
        # Values and ends of their windows in one order, values first: an end's place there tells how many values it reaches.
        merged = np.argsort(np.concatenate([ordered, ordered + window]), axis=0, kind="stable")
        places = np.empty_like(merged)
        np.put_along_axis(places, merged, np.arange(2 * m)[:, None], axis=0)
        ends = places[m:] - np.arange(m)[:, None]
        sizes = (ends - np.arange(m)[:, None] - 1).T.ravel()
        at = np.repeat(np.arange(len(sizes)), sizes)
        second = at + 1 + np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = order.T.ravel()
        a, b = rows[at], rows[second]
        counts += np.bincount(np.minimum(a, b) * m + np.maximum(a, b), minlength=m * m)
    return counts.reshape(m, m)


def _least_reached(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of m rows, the first row that the links a-b reach."""
    label = np.arange(m)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _compare(threshold: float, lines: int, window: float, least: int):
    def tile(table: int, nodes, numbers, x, cells, side):
        m = len(nodes)
        passed = collisions(x @ _lines(x.shape[1], lines, 2), window) >= least
        a, b = np.nonzero(passed)
        if len(np.unique(side)) > 1:
            across = side[a] != side[b]
            a, b = a[across], b[across]
        linked = np.concatenate([np.einsum("ij,ij->i", x[a[k : k + 65536]], x[b[k : k + 65536]]) >= threshold for k in range(0, max(1, len(a)), 65536)])
        a, b = a[linked], b[linked]
        label = _least_reached(m, a, b)
        new = ~(cells[a, :table] == cells[b, :table]).any(axis=1)
        links = np.bincount(a[new], numbers[b[new]], m) + np.bincount(b[new], numbers[a[new]], m)
        return nodes, links.astype(np.int64), nodes[label]

    def run(table):
        out = []
        keys = table.column("tile").to_pylist()
        at: dict[str, list[int]] = {}
        for i, key in enumerate(keys):
            at.setdefault(key, []).append(i)
        nodes, numbers = np.asarray(table.column("node").combine_chunks()), np.asarray(table.column("number").combine_chunks())
        side, tables = np.asarray(table.column("side").combine_chunks()), np.asarray(table.column("t").combine_chunks())
        units, cells = table.column("unit").combine_chunks(), table.column("cells").combine_chunks()
        for rows in at.values():
            if len(rows) > 1:
                take = pa.array(rows)
                x = np.asarray(units.take(take).flatten()).reshape(len(rows), -1)
                c = np.asarray(cells.take(take).flatten()).reshape(len(rows), -1)
                out.append(tile(int(tables[rows[0]]), nodes[rows], numbers[rows], x, c, side[rows]))
        join = lambda k: np.concatenate([np.zeros(0, np.int64), *(o[k] for o in out)])
        a, n, b = join(0), join(1), join(2)
        some = (n > 0) | (a != b)
        return pa.table({"node": pa.array(a[some]), "links": pa.array(n[some]), "reached": pa.array(b[some])})

    return run


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # a class without any id goes by a hash of its vector
    node = F.coalesce(F.min("vec_id"), F.xxhash64("vector")).alias("node")
    known = rows.where("vector IS NOT NULL").groupBy("vector").agg(node, F.count("*").alias("number"))
    bits, tables = layout(known.count(), threshold)
    least = calibrated(threshold, LINES, WINDOW, RECALL)
    placed = known.select("node", "vector", "number").mapInArrow(_cells(bits, tables), "node long, number long, unit array<double>, cells array<long>")
    placed = written(placed, "cells")
    each = placed.select("node", F.posexplode("cells").alias("t", "cell"))
    sizes = each.groupBy("t", "cell").count().where("count > 1").select(F.col("t").alias("_t"), F.col("cell").alias("_cell"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    own = each.join(sizes, (F.col("t") == F.col("_t")) & (F.col("cell") == F.col("_cell"))).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = own.select("node", "t", "cell", "own", other)
    tile = F.concat_ws(":", "t", "cell", F.least("own", "other"), F.greatest("own", "other"))
    spread = spread.select(F.col("node").alias("_node"), "t", tile.alias("tile"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    tiles = spread.join(placed, F.col("_node") == F.col("node")).withColumn("bucket", F.xxhash64("tile") % F.lit(max(1, known.count() * tables // 20_000)))
    found = tiles.select("bucket", "tile", "side", "t", "node", "number", "unit", "cells").groupBy("bucket").applyInArrow(_compare(threshold, LINES, WINDOW, least), "node long, links long, reached long")
    found = written(found, "links")
    components = connected_components(found.select(F.col("node").alias("a"), F.col("reached").alias("b")))
    # components whose least node has no id are named again
    hidden = rows.where("vec_id IS NULL AND vector IS NOT NULL").select(F.xxhash64("vector").alias("hidden")).distinct()
    misnamed = components.join(hidden, F.col("component") == F.col("hidden"), "left_semi").join(hidden, F.col("node") == F.col("hidden"), "left_anti")
    names = misnamed.groupBy(F.col("component").alias("_component")).agg(F.min("node").alias("name"))
    components = components.join(names, F.col("component") == F.col("_component"), "left").select("node", F.coalesce("name", "component").alias("component"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    usable = placed.select("node", F.col("number"))
    results = (
        usable.join(links, "node", "left").join(components, "node", "left")
        .select(F.col("node").alias("_node"), (F.coalesce("links", F.lit(0)) + F.col("number") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    of = rows.join(known.select(F.col("vector").alias("_vector"), "node"), F.col("vector") == F.col("_vector"), "left")
    out = of.join(results, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
