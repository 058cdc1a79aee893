"""Byte-level BPE by a tree reduction.

Token sequences of adjacent byte strings form a monoid: ``join`` turns the
encodings of two neighbours into the encoding of their concatenation. A piece
is encoded by encoding its halves recursively and joining them.

Why a join may stop. A sequence of tokens is the encoding of its bytes exactly
if every two neighbouring tokens are: merges act on neighbours, by rank, so a
merge that crosses a token's end would show in the encoding of that token and
its neighbour alone. So a join re-encodes a window of k tokens on either side
of the seam, and is done when the window's first and last tokens are stable
beside the tokens outside; otherwise k doubles. The rule holds for
vocabularies in which the last merge of every token joins two tokens of lower
rank; that is checked on loading, and pieces are merged whole where it fails.

Decoding concatenates the bytes of the two halves up the same tree.

Defined results: null counts as empty and gives no token; a text of any length
is encoded whole; equal rows give equal results; input columns named like a
result column are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowhaul.llm.frames import map_batches

#: White space as the pattern's \\s has it. No match of the pattern goes from other characters into white space,
#: so a text may be cut there before the pattern is applied.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Most entries of each memory in a Python worker; a full one is emptied.
_CACHE = 500_000
#: Longest chunk whose encoding is remembered, in characters.
_SHORT = 64
#: Longest part of a piece whose encoding is remembered, in bytes.
_HALF = 8
#: Ids in a leaf of the decoding tree.
_LEAF = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class BytePairEncoder:
    """Encoder and decoder for one vocabulary of ranks and one splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        last = max(self.bytes_of, default=0)
        tokens = [self.bytes_of.get(i, b"") for i in range(last + 1)]
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.vocabulary = np.frombuffer(b"".join(tokens), np.uint8)
        self.never = last + 1
        self.pattern = regex.compile(pattern)
        self.cuts = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.seams: dict[tuple[int, int], tuple[int, ...]] = {}
        self.ends: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        # the last merge of each token has two parts of lower rank, else neighbours do not tell all
        self.sound = all(len(p := self.merged(t, r)) == 2 and max(p) < r for t, r in ranks.items() if len(t) > 1)
        self.chunks = _Chunks(self)

    def merged(self, piece: bytes, below: float = float("inf")) -> tuple[int, ...]:
        """The encoding by its definition: merge the neighbours of least rank, leftmost first, until none can be (below a rank)."""
        ranks, n = self.ranks, len(piece)
        if n < 2:
            return tuple(ranks[piece[i : i + 1]] for i in range(n))
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (rank := ranks.get(piece[i : end[j]])) is not None and rank < below:
                heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def edges(self, token: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """What lies at a token's left and at its right end while it is built: a byte first, the token itself last."""
        found = self.ends.get(token)
        if found is None:
            whole = self.bytes_of[token]
            if len(whole) == 1:
                found = ((token,), (token,))
            else:
                a, b = self.merged(whole, token)
                found = ((*self.edges(a)[0], token), (*self.edges(b)[1], token))
            self.ends[token] = found
        return found

    def seam(self, a: int, b: int) -> tuple[int, ...]:
        """The encoding of two neighbouring tokens: themselves if they are stable."""
        found = self.seams.get((a, b))
        if found is None:
            if len(self.seams) >= _CACHE:
                self.seams.clear()
            stable = self.stable(self.edges(a)[1], self.edges(b)[0])
            found = self.seams[a, b] = (a, b) if stable else self.merged(self.bytes_of[a] + self.bytes_of[b])
        return found

    def beside(self, a: int, b: int) -> bool:
        return self.seam(a, b) == (a, b)

    def stable(self, left: tuple[int, ...], right: tuple[int, ...]) -> bool:
        """Whether two neighbouring tokens stay as they are; given is what lies on either side of the seam while they are built.

        Merges happen in order of rank. The tokens stay unless, at some moment,
        both sides of the seam merge with each other before either merges away
        from it. At equal ranks the merge further left comes first.
        """
        ranks, bytes_of = self.ranks, self.bytes_of
        never = self.never
        i = j = 0
        while True:
            p = left[i + 1] if i + 1 < len(left) else never
            q = right[j + 1] if j + 1 < len(right) else never
            rank = ranks.get(bytes_of[left[i]] + bytes_of[right[j]])
            if rank is not None and rank < p and rank <= q:
                return False
            if p == q == never:
                return True
            if p <= q:
                i += 1
            else:
                j += 1

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours from their encodings."""
        if not left or not right:
            return left or right
        window = self.seam(left[-1], right[0])
        if len(window) == 2 and window[0] == left[-1]:
            return left + right
        k = 1
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            if k > 1:
                window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))
            if (i == 0 or self.beside(left[i - 1], window[0])) and (j == len(right) or self.beside(window[-1], right[j])):
                return left[:i] + window + right[j:]
            k *= 2

    def tree(self, piece: bytes) -> tuple[int, ...]:
        """Encode the halves, join them; a token's bytes encode to the token."""
        found = self.ranks.get(piece)
        if found is not None:
            return (found,)
        known = self.halves.get(piece)
        if known is not None:
            return known
        half = len(piece) // 2
        out = self.join(self.tree(piece[:half]), self.tree(piece[half:]))
        if len(piece) <= _HALF:
            if len(self.halves) >= _CACHE:
                self.halves.clear()
            self.halves[piece] = out
        return out

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        return self.tree(piece) if self.sound else self.merged(piece)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, self.cuts.findall(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids: halves are decoded and concatenated, up the tree; a leaf of ids is looked up at once."""
        if len(ids) > _LEAF:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.places[ids] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.vocabulary[at].tobytes()


class _Chunks(dict):
    """Ids of the chunks between white space, found when first asked for."""

    def __init__(self, encoder: BytePairEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        encoder = self.encoder
        ids = array("I")
        for match in encoder.pattern.findall(chunk):
            ids.extend(encoder.piece(match.encode()))
        if sys.byteorder == "big":
            ids.byteswap()
        out = ids.tobytes()
        if len(chunk) <= _SHORT:
            if len(self) >= _CACHE:
                self.clear()
            self[chunk] = out
        return out


_ENCODERS: dict[tuple[str, str], BytePairEncoder] = {}


def encoder_for(path: str, pattern: str) -> BytePairEncoder:
    """One encoder for each vocabulary in a Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = BytePairEncoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


RESULT = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``, the bytes of the ids.

    ``path`` is a file of ranks that every executor has, as it has the Python packages.
    """

    def measure(column):
        encoder = encoder_for(path, pattern)
        ids = [encoder.encode(x) if x else b"" for x in column.to_pylist()]
        decoded = [encoder.decode(np.frombuffer(x, "<u4")) for x in ids]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([counts, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=[f.name for f in RESULT])

    return map_batches(df, text, RESULT, measure)


def token_digests(encoded: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row for each document with the digests of its ids and of its decoded bytes."""
    return encoded.select(F.col(doc_id).alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
