"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set is that of its hashed word shingles. Sets of equal content are
one class, told by an order-free 128-bit checksum, and only its smallest id goes
on. Sizes are cut into bands so wide that linked sets lie in one band or in
neighbouring ones.

Which sets may meet. If two sets of a band link, at most d elements are in one
of them only, so of more than d cells that a hash deals elements to, one cell at
least holds the same elements in both. With e more cells than that, e + 1 do, and
the e cells of a set with fewest elements, rare ones first, need no key: the
fullest of the cells that are the same has e below it in either set. So cells
without elements, or with one that unlike texts share, hardly ever have a key. A
key is the content of a cell; it travels with the name of its set, bytes of the
checksum, so that copies of a set are one there, too. This loses no link; equal
keys or names by chance only cost time. Keys that meet make groups; within a
group come the tiles.

Tiles. A group's sets are cut into blocks of one band and bounded total size;
tiles are pairs of blocks of equal or neighbouring bands. In a tile each set has
a bitmap of its hashed elements. Bits of one bitmap that the other lacks bound
the overlap from above; pairs that may still link, and are not yet connected,
get the exact intersection of their sorted arrays. Only links that connect
something are reported, so copies never become all their pairs.

Defined results: without a word (or null) a set is empty and links with nothing;
rows with one id are one document; rows with a null id link with nothing and
have a null component; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.components import connected_components
from rowhaul.llm.frames import parts_for, text_bytes, written
from rowhaul.llm.words import Words, mix, pieces, release, window_hashes

_U = np.uint64
#: Elements in a block of a tile, about.
BLOCK = 1 << 19
#: Keys gathered in a task before they are combined and sent.
GATHERED = 1 << 20
#: Bytes of text for each bucket of keys, about.
BUCKET = 32 << 20
_BITS = 1024
#: Two to this power counters tell elements that very many documents share.
_COUNTERS = 18
_SLICES = 16
#: Cells of a set that need no key, for each hundred of its elements that may differ.
SPARE = 50


class Bands:
    """Bands of set sizes for a threshold of ``num / den``, and how many cells each has."""

    def __init__(self, num: int, den: int, top: int = 1 << 40):
        self.num, self.den = num, den
        lows = [1]
        while lows[-1] < top:
            lows.append(lows[-1] * den // num + 1)
        self.lows = np.array(lows)
        # elements in one set only, at most, when sets up to the band's last size link
        self.differ = [2 * (high - 1) * (den - num) // (den + num) for high in lows[1:]]
        self.spare = [2 + d * SPARE // 100 if d else 0 for d in self.differ]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, side="right") - 1


class Sets:
    """Distinct shingles of a batch of texts, sorted within each text."""

    def __init__(self, column, n: int):
        words = Words(column)
        hashes = words.hashes(lower=True)
        keys = window_hashes(hashes, n)
        sets, first = [], words.first
        for d, count in enumerate(words.counts.tolist()):
            at = first[d]
            if count >= n:
                own = np.sort(keys[at : at + count - n + 1])
                new = np.empty(len(own), bool)
                new[0] = True
                np.not_equal(own[1:], own[:-1], out=new[1:])
                sets.append(own[new])
            elif count:
                sets.append(window_hashes(hashes[at : at + count], count))
            else:
                sets.append(keys[:0])
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.all = np.concatenate([np.zeros(0, np.uint64), *sets])
        self.of = np.repeat(np.arange(len(sets)), self.sizes)

    def _sums(self, salt: int) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(self.sizes)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.all ^ _U(salt)))])
        return (sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)

    def checksums(self) -> tuple[np.ndarray, np.ndarray]:
        """Two order-free 64-bit sums for each set."""
        return self._sums(0x243F6A8885A308D3), self._sums(0x13198A2E03707344)

    def names(self) -> np.ndarray:
        """The low bytes of the first sum: sets of equal content have one name."""
        return self._sums(0x243F6A8885A308D3) & ((1 << 8 * _NAME) - 1)

    def keys(self, bands: Bands, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, set) for the cells of every set, in the tile of its band and in that of the next. ``common``: counters of shared elements."""
        own = ~common[_counter(self.all)]
        mixed, out = mix(self.all ^ _U(0xA4093822299F31D0)), []
        band = bands.of(self.sizes)
        for step in (0, 1):
            tile = band + step
            differ = np.array([bands.differ[t] if s else 0 for t, s in zip(tile, self.sizes)], np.int64)
            spare = np.array([bands.spare[t] if s else 0 for t, s in zip(tile, self.sizes)], np.int64)
            cells = np.where(differ > 0, differ + 1 + spare, 0)
            used = cells[self.of] > 0
            base = np.concatenate([[0], np.cumsum(cells)])
            of, elements = self.of[used], mixed[used]
            at = base[of] + (elements >> _U(20)).astype(np.int64) % cells[of]
            total = int(base[-1])
            if not total:
                continue
            low = np.bincount(at, (elements & _U(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
            high = np.bincount(at, (elements >> _U(32)).astype(np.float64), total).astype(np.uint64)
            owner = np.repeat(np.arange(len(cells)), cells)
            cell = np.arange(total) - base[owner]
            # of each set the cells with most elements, rare ones first; equal cells rank alike
            rank = np.lexsort((cell, -np.bincount(at, minlength=total), -np.bincount(at, own[used], total), owner))
            sent = np.empty(total, bool)
            sent[rank] = cell < (cells - spare)[owner]
            salt = mix(tile[owner].astype(np.uint64) * _U(0x9FB21C651E98DF25) + cell.astype(np.uint64))
            out.append((mix((low + (high << _U(32))) ^ salt ^ (high >> _U(16)))[sent], owner[sent]))
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate([k for k, _ in out]), np.concatenate([o for _, o in out])


def _counter(elements: np.ndarray) -> np.ndarray:
    """The counter an element belongs to."""
    return (elements >> _U(64 - _COUNTERS)).astype(np.int64)


_CLASSES = "doc_id long, n_shingles long, s1 long, s2 long, slice int, counts binary"


def _classes(n: int):
    """Size and checksums of every set; at the end of a task, its counts of elements, cut into slices."""

    def run(batches):
        counts = np.zeros(1 << _COUNTERS, np.int64)
        for batch in pieces(batches):
            sets = Sets(batch.column(1), n)
            s1, s2 = sets.checksums()
            counts += np.bincount(_counter(sets.all), minlength=len(counts))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets.sizes, pa.int64()), pa.array(s1), pa.array(s2), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=["doc_id", "n_shingles", "s1", "s2", "slice", "counts"]
            )
        if counts.any():
            slices = [c.tobytes() for c in np.split(counts, _SLICES)]
            none = pa.nulls(_SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(_SLICES), pa.int32()), pa.array(slices, pa.binary())], names=["doc_id", "n_shingles", "s1", "s2", "slice", "counts"])

    return run


def _sum_slice(table):
    total = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _common(counts: DataFrame) -> np.ndarray:
    """Which counters hold far more than the usual number; ``_SLICES`` rows of fixed size come to the driver."""
    sums = np.zeros(1 << _COUNTERS, np.int64)
    width = len(sums) // _SLICES
    # first what a few tasks have counted, then all
    parts = counts.groupBy("slice", F.pmod(F.monotonically_increasing_id(), F.lit(256)).alias("part"))
    for row in parts.applyInArrow(_sum_slice, "slice int, counts binary").groupBy("slice").applyInArrow(_sum_slice, "slice int, counts binary").collect():
        sums[row.slice * width : (row.slice + 1) * width] = np.frombuffer(row.counts, np.int64)
    usual = np.median(sums)
    return sums > usual + 8 * np.sqrt(usual) + 32


def _combined(keys: np.ndarray, ids: np.ndarray):
    """Distinct keys with their least id; links of the other ids to it."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    least = ids[new]
    head = least[np.cumsum(new) - 1] if len(keys) else ids
    other = ids != head
    links = np.unique(np.stack([ids[other], head[other]], axis=1), axis=0)
    return keys[new], least, links


def _forest(links: np.ndarray) -> np.ndarray:
    """Links of every id to the least that ``links`` reach: they connect the same, with one link for an id at most."""
    nodes, ends = np.unique(links, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    least = np.arange(len(nodes))
    while True:
        new, low = least.copy(), np.minimum(least[a], least[b])
        np.minimum.at(new, least[a], low)
        np.minimum.at(new, least[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, least):
            break
        least = new
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return np.stack([nodes[other], nodes[least[other]]], axis=1)


_KEYS = "bucket int, keys binary, ids binary, links binary"
#: Bytes of a key that travel, besides its bucket, and of the checksum that names a set.
_KEY, _NAME = 5, 6


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of 64-bit values, a row for each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def _unpacked(packed: list[bytes], width: int, kind) -> np.ndarray:
    low = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, width)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :width] = low
    return out.view(kind).reshape(-1)


def _send_keys(n: int, num: int, den: int, buckets: int, common: np.ndarray):
    """Keys of texts, packed by bucket; the id beside a key is the name of its set."""
    bands = Bands(num, den)

    def flush(keys, ids):
        keys, least, links = _combined(np.concatenate(keys), np.concatenate(ids))
        links = _forest(links)
        bucket = ((keys >> _U(8 * _KEY)) % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        first = bucket[order][np.concatenate([[0], cuts])].tolist() if len(keys) else []
        packed = [x.tobytes() for x in np.split(_packed(keys[order], _KEY), cuts)][: len(first)]
        packed_ids = [x.tobytes() for x in np.split(_packed(least[order], _NAME), cuts)][: len(first)]
        if len(links):  # found here; they travel with any bucket
            first, packed, packed_ids = [*first, first[0]], [*packed, b""], [*packed_ids, b""]
        known = [None] * (len(first) - 1) + [links.tobytes() if len(links) else None]
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(packed, pa.binary()), pa.array(packed_ids, pa.binary()), pa.array(known, pa.binary())], names=["bucket", "keys", "ids", "links"])

    def run(batches):
        keys, ids, gathered = [], [], 0
        for batch in pieces(batches):
            sets = Sets(batch.column(0), n)
            own, owner = sets.keys(bands, common)
            keys.append(own)
            ids.append(sets.names()[owner])
            gathered += len(own)
            if gathered >= GATHERED:
                yield from flush(keys, ids)
                keys, ids, gathered = [], [], 0
        if gathered:
            yield from flush(keys, ids)

    return run


def _meet(table):
    """What connects the ids of each key, over all tasks, and those linked before; one link for an id."""
    links = _combined(_unpacked(table.column("keys").to_pylist(), _KEY, np.uint64), _unpacked(table.column("ids").to_pylist(), _NAME, np.int64))[2]
    known = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in table.column("links").to_pylist() if x]
    links = _forest(np.concatenate([links, *known]))
    del known
    release()
    return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})


def _arrays(n: int):
    """The sorted set of each document, once for each of its tiles."""

    def run(batches):
        for batch in pieces(batches):
            sets = Sets(batch.column(1), n).sets
            tiles = batch.column(2).to_pylist()
            rows = [(t["tile"], t["side"], d) for d, ts in enumerate(tiles) for t in ts]
            ids = batch.column(0).to_pylist()
            step = 512
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _, _ in part], pa.string()), pa.array([s for _, s, _ in part], pa.int32()), pa.array([ids[d] for _, _, d in part], pa.int64()), pa.array([sets[d].tobytes() for _, _, d in part], pa.binary())],
                    names=["tile", "side", "node", "elements"],
                )

    return run


def bitmaps(sets: list[np.ndarray], bits: int = _BITS) -> np.ndarray:
    """A bitmap of each set's hashed elements."""
    out = np.zeros((len(sets), bits), bool)
    for i, s in enumerate(sets):
        out[i, ((s >> _U(7)) % _U(bits)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def _verify(num: int, den: int):
    def run(table):
        sets = [np.frombuffer(x, np.uint64) for x in table.column("elements").to_pylist()]
        order = np.argsort([len(s) for s in sets], kind="stable")
        sets = [sets[i] for i in order]
        nodes = np.asarray(table.column("node").combine_chunks()).astype(np.int64)[order]
        side = np.asarray(table.column("side").combine_chunks())[order]
        cross = len(np.unique(side)) > 1
        sizes = np.array([len(s) for s in sets], np.int64)
        maps, group, links = bitmaps(sets), np.arange(len(sets)), []
        for i in range(len(sets)):
            end = np.searchsorted(sizes, sizes[i] * den // num, side="right")
            later = np.arange(i + 1, max(i + 1, end))
            later = later[(group[later] != group[i]) & ((side[later] != side[i]) if cross else True)]
            if not len(later):
                continue
            overlap = np.minimum(
                sizes[i] - np.bitwise_count(maps[i] & ~maps[later]).sum(axis=1, dtype=np.int64), sizes[later] - np.bitwise_count(maps[later] & ~maps[i]).sum(axis=1, dtype=np.int64)
            )
            for j in later[den * overlap >= num * (sizes[i] + sizes[later] - overlap)]:
                if group[j] == group[i]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if den * common >= num * (sizes[i] + sizes[j] - common):
                    links.append((nodes[i], nodes[j]))
                    group[group == group[j]] = group[i]
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return run


def _tiles(members: DataFrame, block: int) -> DataFrame:
    """(node, tiles): the tiles each member of a group lies in. Only sums for each group and band are looked at."""
    sums = members.groupBy("group", "band").agg(F.sum("n_shingles").alias("elements"))
    whole = sums.groupBy("group").agg(F.sum("elements").alias("total"), F.map_from_entries(F.collect_list(F.struct("band", "elements"))).alias("in_band"))
    whole = whole.select(F.col("group").alias("_group"), "total", "in_band")
    blocks = lambda band: F.ceil(F.coalesce(F.element_at("in_band", band), F.lit(0)) / F.lit(block)).cast("int")
    rows = members.join(whole, F.col("group") == F.col("_group")).withColumn("_own", blocks(F.col("band")))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("node"), F.greatest(F.col("_own"), F.lit(1))).cast("int"))
    name = lambda b1, i, b2, j: F.concat_ws(":", "group", b1, i, b2, j)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    band, own = F.col("band"), F.col("_block")
    same = F.transform(upto(F.col("_own")), lambda j: F.struct(name(band, F.least(own, j), band, F.greatest(own, j)).alias("tile"), F.when(j == own, 0).otherwise((own > j).cast("int")).alias("side")))
    above = F.transform(upto(blocks(band + 1)), lambda j: F.struct(name(band, own, band + 1, j).alias("tile"), F.lit(0).alias("side")))
    below = F.transform(upto(blocks(band - 1)), lambda j: F.struct(name(band - 1, j, band, own).alias("tile"), F.lit(1).alias("side")))
    one = F.array(F.struct(F.col("group").cast("string").alias("tile"), F.lit(0).alias("side")))
    return rows.select("node", F.when(F.col("total") <= block, one).otherwise(F.concat(same, above, below)).alias("tiles"))


def near_duplicates(df: DataFrame, n: int = 4, num: int = 85, den: int = 100, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id (the smallest id that links of ``num / den`` or more reach)."""
    bands = Bands(num, den)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = written(docs.mapInArrow(_classes(n), _CLASSES), "sets")
    narrow = sets.where("slice IS NULL").drop("slice", "counts")
    common = _common(sets.where("slice IS NOT NULL").select("slice", "counts"))
    known = narrow.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node"))

    some = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    buckets = parts_for(text_bytes(df, text), BUCKET)
    sent = some.select("text").mapInArrow(_send_keys(n, num, den, buckets, common), _KEYS)
    # a link may come once from each bucket
    pairs = sent.groupBy("bucket").applyInArrow(_meet, "a long, b long").distinct()

    heads = written(known.join(classes, ["s1", "s2", "n_shingles"]).select("doc_id", "node", "n_shingles", F.col("s1").bitwiseAND(F.lit((1 << 8 * _NAME) - 1)).alias("name")), "heads")
    of = heads.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("other"))
    named = heads.where("doc_id = node").select("name", "node").distinct()
    for end in ("a", "b"):
        pairs = pairs.join(named.select(F.col("name").alias(end), F.col("node").alias(f"_{end}")), end).drop(end).withColumnRenamed(f"_{end}", end)
    groups = connected_components(pairs)

    members = heads.where("doc_id = node").dropDuplicates(["node"]).join(groups, "node").select("node", F.col("component").alias("group"), "n_shingles")
    tiles = _tiles(members.withColumn("band", _band(F.col("n_shingles"), bands)), block)
    rows = some.join(tiles, F.col("doc_id") == F.col("node")).select("doc_id", "text", "tiles")
    arrays = rows.mapInArrow(_arrays(n), "tile string, side int, node long, elements binary")
    links = arrays.groupBy("tile").applyInArrow(_verify(num, den), "a long, b long")
    # rows with one id are one document: its sets are linked
    several = of.where("node <> other").select("doc_id", F.col("node").alias("b"))
    links = links.unionByName(heads.join(several, "doc_id").select(F.col("node").alias("a"), "b"))
    found = connected_components(links)
    class_of = of.join(found, "node", "left").select(F.col("doc_id").alias("_id"), F.coalesce("component", "node").alias("component"))
    out = narrow.join(class_of, F.col("doc_id") == F.col("_id"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _band(size, bands: Bands):
    """Band of a size, as ``Bands.of`` has it: the sizes at which bands begin are few."""
    lows = F.array(*(F.lit(int(x)) for x in bands.lows))
    return (F.size(F.filter(lows, lambda low: low <= size)) - 1).cast("int")
