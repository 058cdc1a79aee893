"""Line dedup by levelled sorted runs of line hashes.

A run is a table of line hashes, each once, with the number of documents that
hold it, in hash order. Documents come in batches. A batch anti-joins its hashes
with the settled run, that of lines known to be in enough documents, and adds
the others as a run of its own at level 0. When a level has ``FANOUT`` runs they
are merged into one run of the next level; hashes that reach the limit move to
the settled run, so frequent lines are stored once, not in every later run. A
hash is rewritten once a level, and the number of levels grows with the logarithm
of the number of batches. After the last batch all runs are merged.

Lines of settled hashes then go from every document, those of the first batches
included.

How it is spread. A task sends each distinct line of a document once; counts are
combined before the shuffle. Runs are merged by Spark's shuffle on the hash, and
what a document loses comes from a join on it, a hash being dealt over ``SALTS``
places, so that a line in a third of all documents is no one task's load. Hashes
are half of a SHA-256; rows are known by a hash of id and text, and equal rows
lose the same lines. No list of lines, hashes or documents comes to the driver.

Defined results: a null or empty text is one empty line; empty lines (those of
spaces alone included) are no keys and stay; every row counts as one document,
whatever its id; a document whose lines all go has the empty text; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.frames import written
from rowhaul.llm.words import pieces

SPACES = b" \t\n\x0b\x0c\r"
#: Documents that make a line frequent.
LEAST = 10
BATCHES = 6
FANOUT = 3
#: Places over which the rows of one hash are dealt.
SALTS = 32


def line_key(line: bytes) -> bytes:
    """A line without spaces at its ends, A to Z in lower case."""
    return line.strip(SPACES).lower()


def key_hash(key: bytes) -> bytes:
    return sha256(key).digest()[:16]


def _hashes(batches):
    """(line, row, batch) for each distinct key of each row; a batch has the hashes of its rows."""
    for batch in pieces(batches):
        lines, rows = [], []
        for row, text in zip(batch.column(1).to_pylist(), batch.column(0).cast(pa.large_binary()).to_pylist()):
            own = {line_key(x) for x in text.split(b"\n")} - {b""} if text else ()
            lines.extend(map(key_hash, own))
            rows.extend([row] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), pa.array(rows, pa.int64())], names=["line", "row"])


class LineRuns:
    """Levelled runs of (line, n), and the settled run of lines that ``least`` documents hold."""

    def __init__(self, least: int = LEAST, fanout: int = FANOUT):
        self.least, self.fanout = least, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: DataFrame | None = None

    def add(self, lines: DataFrame) -> None:
        """A batch of lines, one row for each document that holds one."""
        if self.settled is not None:
            lines = lines.join(self.settled, "line", "left_anti")
        self._store(lines.groupBy("line").agg(F.count("*").alias("n")), 0)

    def frequent(self) -> DataFrame:
        """Merge what is left; the lines that enough documents hold."""
        runs = [run for level in self.levels for run in level]
        self.levels = []
        if runs:
            self._settle(self._merged(runs))
        return self.settled

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for run in runs[1:]:
            both = both.unionByName(run)
        return both.groupBy("line").agg(F.sum("n").alias("n"))

    def _settle(self, counts: DataFrame) -> None:
        new = counts.where(F.col("n") >= self.least).select("line")
        known = new if self.settled is None else self.settled.unionByName(new)
        self.settled = written(known.sortWithinPartitions("line"), "settled")

    def _store(self, counts: DataFrame, level: int) -> None:
        """A run in hash order; a level that is full is merged into the next."""
        run = written(counts.sortWithinPartitions("line"), f"run{level}")
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = written(self._merged(self.levels[level]), "merged")
            self.levels[level] = []
            self._settle(merged)
            self._store(merged.where(F.col("n") < self.least), level + 1)


def _cut(batches):
    for batch in pieces(batches):
        numbers, dropped, kept = [], [], []
        for text, gone in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
            text = text or b""
            n = text.count(b"\n") + 1
            if gone:
                lines, gone = text.split(b"\n"), set(gone)
                stay = [x for x in lines if not (key := line_key(x)) or key_hash(key) not in gone]
                text, lost = b"\n".join(stay), n - len(stay)
            else:
                lost = 0
            numbers.append(n)
            dropped.append(lost)
            kept.append(text)
        columns = [batch.column(0), pa.array(numbers, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_lines", "n_dropped", "kept_text"])


def drop_frequent_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """One row for each document: doc_id, n_lines (before), n_dropped, kept_text."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row"))
    hashed = docs.select("text", "row").mapInArrow(_hashes, "line binary, row long")
    entries = written(hashed.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int")), "lines", "batch")
    runs = LineRuns(least, fanout)
    for number in range(batches):
        runs.add(entries.where(F.col("batch") == number).select("line"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    frequent = runs.frequent().select("line", salts)
    # a merge join: Spark's estimate of the salted run would have it broadcast, though it grows with the lines
    held = entries.select("line", "row", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt")).join(frequent.hint("merge"), ["line", "salt"])
    gone = held.groupBy(F.col("row").alias("_row")).agg(F.collect_set("line").alias("gone"))
    kind = df.schema[doc_id].dataType.simpleString()
    return docs.join(gone, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "gone").mapInArrow(_cut, f"doc_id {kind}, n_lines long, n_dropped long, kept_text string")
