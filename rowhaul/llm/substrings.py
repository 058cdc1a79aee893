"""Substring dedup by difference-cover anchors.

The positions 0, 1 and 3 modulo 7 form a difference cover: whatever the places
of two equal runs of words in their documents, one of the first seven offsets
puts both on a cover position. So only runs of seven words that begin at cover
positions are hashed (three of seven); two equal windows of 13 words share such
an anchor, aligned within them. Anchors found in one document only are settled.
The others extend: the windows around them are hashed whole, by two hashes of
all their words (anchors, which only choose, have one), and the least document
id of each window is found. A word goes if a window over it also starts in a
document with a smaller id.

How it is spread. Documents are cut into chunks of some megabytes by a hash;
their number grows with the input. A chunk sends each distinct hash once, so a
passage in a third of all documents is one entry for each chunk, never a group
of its documents. Entries travel packed, to buckets by hash; buckets answer the
chunks, where the texts are. All three visits to the texts use one shuffle.

Defined results: a null text has no words; a null id neither removes nor loses
words; equal ids do not remove each other's words; documents shorter than a
window lose nothing; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.frames import parts_for, text_bytes
from rowhaul.llm.words import Words, covered, window_hashes, windows_within

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text in a chunk, about.
CHUNK = 8 << 20

_U = np.uint64
_SENT = "bucket int, chunk int, hashes binary, ids binary, checks binary"
_BACK = "chunk int, hashes binary, checks binary"
_NONE = np.zeros(0, np.uint64)
_NO_CHECKS = np.zeros(0, np.uint32)


class _Chunk:
    """The documents of a chunk with an id, as words."""

    def __init__(self, table: pa.Table):
        self.texts = table.column("text").combine_chunks()
        self.ids = np.asarray(table.column("doc_id").combine_chunks().fill_null(0)).astype(np.int64)
        self.known = np.asarray(table.column("doc_id").combine_chunks().is_valid())
        self.words = Words(self.texts)
        self.hashes = self.words.hashes()

    def place(self) -> np.ndarray:
        """Of each word in its text."""
        return np.arange(len(self.words)) - np.repeat(self.words.first[:-1], self.words.counts)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Words at which an anchor begins, and its hash."""
        keys = window_hashes(self.hashes, ANCHOR)
        at = np.flatnonzero(windows_within(self.words.first, ANCHOR, len(keys)) & np.isin(self.place()[: len(keys)] % PERIOD, COVER) & self.known[self.words.text_of()[: len(keys)]])
        return at, keys[at] & ~_U(1)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words begin a window, and two hashes of the 13 words from each word, of 64 and of 32 bits."""
        keys, checks = window_hashes(self.hashes, WINDOW), (window_hashes(self.words.hashes(lane=1), WINDOW) >> _U(32)).astype(np.uint32)
        return windows_within(self.words.first, WINDOW, len(keys)) & self.known[self.words.text_of()[: len(keys)]], keys, checks


def _starts(keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Where another window begins among ordered ones."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    return new


def _sent(chunk: int, buckets: int, keys: np.ndarray, ids: np.ndarray | None = None, checks: np.ndarray | None = None) -> pa.Table:
    """Ascending keys (and an id and another hash each), packed for every bucket."""
    bucket = (_spread(keys) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    packed = lambda x: [y.tobytes() for y in np.split(x[order], cuts)] if len(keys) and x is not None else [None] * (len(cuts) + 1 if len(keys) else 0)
    first = bucket[order][np.concatenate([[0], cuts])] if len(keys) else []
    columns = {"bucket": pa.array(first, pa.int32()), "chunk": pa.array([chunk] * len(first), pa.int32())}
    return pa.table(columns | {name: pa.array(packed(x), pa.binary()) for name, x in (("hashes", keys), ("ids", ids), ("checks", checks))})


def _spread(keys: np.ndarray) -> np.ndarray:
    """Bits for choosing a bucket; without the lowest bit, which anchors use for a note."""
    return (keys >> _U(1)) * _U(0x9E3779B97F4A7C15) >> _U(20)


def _unpacked(column: pa.ChunkedArray, kind=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _send_anchors(buckets: int):
    def run(key, table):
        chunk = _Chunk(table)
        at, keys = chunk.anchors()
        ids = chunk.ids[chunk.words.text_of()[at]]
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        ends = np.concatenate([starts[1:], [len(keys)]])
        several = ids[starts] != ids[ends - 1] if len(starts) else np.zeros(0, bool)
        return _sent(key[0].as_py(), buckets, keys[starts] | several.astype(np.uint64))

    return run


def _shared(key, table):
    """Anchors in more than one document, for every chunk that has them."""
    parts = _unpacked(table.column("hashes"))
    chunks = np.repeat(np.asarray(table.column("chunk").combine_chunks()), [len(p) for p in parts])
    keys = np.concatenate(parts) if parts else _NONE
    order = np.argsort(keys)
    keys, chunks = keys[order], chunks[order]
    noted, plain = (keys & _U(1)).astype(bool), keys & ~_U(1)
    same = plain[1:] == plain[:-1]
    shared = noted.copy()
    shared[1:] |= same
    shared[:-1] |= same
    return _back(plain[shared], chunks[shared])


def _back(keys: np.ndarray, chunks: np.ndarray, checks: np.ndarray | None = None) -> pa.Table:
    """Keys (and another hash each) packed for each chunk."""
    order = np.argsort(chunks, kind="stable")
    chunks = chunks[order]
    cuts = np.flatnonzero(np.diff(chunks)) + 1
    packed = lambda x: [y.tobytes() for y in np.split(x[order], cuts)] if len(chunks) and x is not None else [None] * (len(cuts) + 1 if len(chunks) else 0)
    first = chunks[np.concatenate([[0], cuts])] if len(chunks) else []
    return pa.table({"chunk": pa.array(first, pa.int32()), "hashes": pa.array(packed(keys), pa.binary()), "checks": pa.array(packed(checks), pa.binary())})


def _held(keys: np.ndarray, checks: np.ndarray, table: pa.Table) -> np.ndarray:
    """Which windows, by both hashes, the packed ones of a table hold."""
    known = np.concatenate([_NONE, *_unpacked(table.column("hashes"))])
    both, second = np.concatenate([keys, known]), np.concatenate([checks, *_unpacked(table.column("checks"), np.uint32)])
    order = np.lexsort((second, both))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(_starts(both[order], second[order]))
    return np.isin(group[: len(keys)], group[len(keys) :])


def _among(keys: np.ndarray, table: pa.Table) -> np.ndarray:
    """Which keys the packed ones of a table hold."""
    known = np.sort(np.concatenate([_NONE, *_unpacked(table.column("hashes"))]))
    if not len(known) or not len(keys):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _send_windows(buckets: int):
    def run(key, table, shared):
        if table.num_rows == 0 or shared.num_rows == 0:
            return _sent(0, buckets, _NONE)
        chunk = _Chunk(table)
        at, anchors = chunk.anchors()
        at = at[_among(anchors, shared)]
        inside, keys, checks = chunk.windows()
        # windows that hold the anchor whole
        starts = np.unique(np.concatenate([at - d for d in range(PERIOD)])) if len(at) else at
        starts = starts[(starts >= 0) & (starts < len(keys))]
        starts = starts[inside[starts]]
        keys, checks, ids = keys[starts], checks[starts], chunk.ids[chunk.words.text_of()[starts]]
        order = np.lexsort((ids, checks, keys))
        keys, checks, ids = keys[order], checks[order], ids[order]
        first = _starts(keys, checks)
        return _sent(key[0].as_py(), buckets, keys[first], ids[first], checks[first])

    return run


def _elsewhere(key, table):
    """Windows whose least id lies outside the chunk, for every such chunk."""
    parts = _unpacked(table.column("hashes"))
    chunks = np.repeat(np.asarray(table.column("chunk").combine_chunks()), [len(p) for p in parts])
    keys, checks = np.concatenate(parts or [_NONE]), np.concatenate(_unpacked(table.column("checks"), np.uint32) or [_NO_CHECKS])
    ids = np.concatenate(_unpacked(table.column("ids"), np.int64) or [np.zeros(0, np.int64)])
    order = np.lexsort((ids, checks, keys))
    keys, checks, ids, chunks = keys[order], checks[order], ids[order], chunks[order]
    new = _starts(keys, checks)
    later = ids > ids[new][np.cumsum(new) - 1]
    return _back(keys[later], chunks[later], checks[later])


def _cut(key, table, elsewhere):
    chunk = _Chunk(table)
    words = chunk.words
    inside, keys, checks = chunk.windows()
    at = np.flatnonzero(inside)
    keys, checks, ids = keys[at], checks[at], chunk.ids[words.text_of()[at]]
    order = np.lexsort((ids, checks, keys))
    owners = ids[order]
    new = _starts(keys[order], checks[order])
    later = np.zeros(len(keys), bool)
    later[order] = owners > owners[new][np.cumsum(new) - 1]
    gone = covered(at[later | _held(keys, checks, elsewhere)], WINDOW, len(words)) if len(words) else np.zeros(0, bool)
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
    data, kept = words.data.tobytes(), []
    for d, n in enumerate(removed.tolist()):
        own = data[words.offsets[d] : words.offsets[d + 1]].split()
        kept.append(b" ".join(own if n == 0 else compress(own, ~gone[words.first[d] : words.first[d + 1]])))
    return pa.table({"doc_id": table.column("doc_id"), "n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def drop_repeated_windows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, kept_text (the words that stay, joined by spaces)."""
    chunks = parts_for(text_bytes(df, text), chunk_bytes)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    texts = docs.groupBy("chunk")
    shared = texts.applyInArrow(_send_anchors(chunks), _SENT).groupBy("bucket").applyInArrow(_shared, _BACK)
    windows = texts.cogroup(shared.groupBy("chunk")).applyInArrow(_send_windows(chunks), _SENT)
    elsewhere = windows.groupBy("bucket").applyInArrow(_elsewhere, _BACK)
    return texts.cogroup(elsewhere.groupBy("chunk")).applyInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_text string")
