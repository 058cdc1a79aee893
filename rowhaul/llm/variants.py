"""Spelling variants by a variable-length gram index.

Words are counted with Spark, then indexed by grams of two to four letters. The
dictionary is pruned by frequency: a gram that more than one in ``SHARE`` of all
places hold is not kept, its extensions by one letter are. A word is decomposed
into the shortest gram of the dictionary from each place.

An edit touches few grams: those before it that end by then are the same in both
words, and so are those behind it that reach so far that no gram begun earlier
can contain them. These bounds, ``Index.left`` and ``Index.right``, hold for each
word and place of an edit. Two near words stand together in the lists of all
other grams, so these lists are merged at once: a word has one key for each
range of edits that leave the same grams alone, made of these grams, and words
with equal keys differ at most in the window between, of seven letters at most.

Candidates of a key are verified exactly on their windows: the letters left of
the window when one is taken out are compared, in sorted order. A set of words
that agree so holds one word for each letter at most, so no pairs are listed: a
word gets its number of near words and the best of them from the set. A pair is
counted for its leftmost edit only, so numbers add up.

How it is spread. Counts are combined before the shuffle; entries of the index
go to buckets of bounded size, whose number grows with the vocabulary. Only the
frequent grams, at most ``2 * SHARE``, come to the driver. A frequent word is one
row. Words are numbered in code-point order by a range-partitioned sort. Keys are
hashed modulo a prime, twice (122 bits); windows are compared letter by letter.

Defined results: a null text has no words; a row with a null id deletes no
letter; equal rows count again; of equal counts the least word is the form; very
long words are indexed like others; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowhaul.llm.frames import parts_for, written
from rowhaul.llm.rolling import Spans
from rowhaul.llm.words import mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One in so many checksums takes a letter out.
EVERY = 31
#: A form occurs so many times as often as its word.
TIMES = 10
#: Grams in more than one of ``SHARE`` places are extended.
SHARE = 8192
#: Entries of the index in one bucket, about.
BUCKET = 400_000

_BITS = 7
_U = np.uint64
_ENTRY = "bucket int, k1 long, k2 long, id long, n long, window long, edits int"
_NEAR = "id long, near long, best_n long, best_id long"


def word_counts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of every word that occurs often enough, after letters are taken out by the checksum of id and word."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(f"([a-zÀ-ÿ]{{{LEAST_LENGTH},}})"), F.lit(1))
    runs = df.select(F.col(doc_id).cast("string").alias("doc"), F.explode(found).alias("run"))
    checked = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    word = F.expr(f"CASE WHEN h % {EVERY} = 0 THEN concat(substring(run, 1, cast(h % length(run) AS int)), substring(run, cast(h % length(run) AS int) + 2)) ELSE run END")
    counted = checked.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH))


class Letters(NamedTuple):
    """Words of a batch as one array of letter codes 1 to 90; word w is ``codes[starts[w] : starts[w] + lengths[w]]``."""

    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, column) -> Letters:
        words = column.to_pylist()
        points = np.frombuffer("".join(words).encode("utf-16-le"), "<u2").astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return cls(np.where(points < 0xC0, points - 96, points - 0xC0 + 27), np.cumsum(lengths) - lengths, lengths)


def _gram_counts(batches):
    two, three = np.zeros(1 << 2 * _BITS, np.int64), np.zeros(1 << 3 * _BITS, np.int64)
    for batch in batches:
        codes, starts, lengths = Letters.of(batch.column(0))
        word = np.repeat(np.arange(len(lengths)), lengths)
        for counts, n in ((two, 2), (three, 3)):
            size = max(0, len(codes) - n + 1)
            inside = word[:size] == word[n - 1 :]
            gram = sum(codes[j : j + size] << _BITS * (n - 1 - j) for j in range(n))
            counts += np.bincount(gram[inside], minlength=len(counts))
    for counts, n in ((two, 2), (three, 3)):
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), n, np.int32)), pa.array(held), pa.array(counts[held])], names=["size", "gram", "places"])


def frequent_grams(words: DataFrame, places: int, share: int = SHARE) -> dict[int, np.ndarray]:
    """Grams of two and of three letters that the dictionary replaces by longer ones, of ``places`` in all; fewer than ``share`` of each size."""
    counts = words.select("word").mapInArrow(_gram_counts, "size int, gram long, places long").groupBy("size", "gram").agg(F.sum("places").alias("places"))
    rows = counts.where(F.col("places") * share > places).select("size", "gram").collect()
    return {n: np.array(sorted(r.gram for r in rows if r.size == n), np.int64) for n in (2, 3)}


class Index:
    """Grams of a batch of words, and the keys of every word's edits.

    Edits are numbered along the word: 2 i puts a letter in before letter i, 2 i + 1
    replaces letter i or takes it out. Arrays hold one place more than letters for each word.
    """

    def __init__(self, letters: Letters, frequent: dict[int, np.ndarray]):
        codes, lengths = letters.codes, letters.lengths
        self.word = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.base = np.cumsum(lengths + 1) - (lengths + 1)
        self.place = np.arange(len(self.word)) - self.base[self.word]
        self.rest = lengths[self.word] - self.place
        padded = np.zeros(len(self.word) + 8, np.int64)
        padded[np.flatnonzero(self.rest > 0)] = codes
        self.codes, size = padded, len(self.word)
        pair = padded[:size] << _BITS | padded[1 : size + 1]
        triple = pair << _BITS | padded[2 : size + 2]
        longer = np.isin(pair, frequent[2]) & (self.rest >= 2)
        longest = longer & np.isin(triple, frequent[3]) & (self.rest >= 3)
        #: Letters of the gram from each place, more than there are where the word's end stops it.
        self.gram = 2 + longer + longest
        self.left, self.right = self._left(), self._right()

    def _left(self) -> np.ndarray:
        """For an edit at each place: up to which place the grams before it are surely the same."""
        at, offset = np.arange(len(self.word)), self.base[self.word]
        ends = np.where(self.rest >= self.gram, self.place + self.gram, -1)
        # grams that the word's end stops might go on in a longer word: nothing from there on is sure
        stopped = np.flatnonzero(ends < 0)[::-1]
        sure = np.empty(len(self.base), np.int64)
        sure[self.word[stopped]] = self.place[stopped]
        settled = np.flatnonzero(self.place < sure[self.word])
        furthest = np.maximum.accumulate(np.where(ends < 0, offset, offset + ends))[settled]
        known = np.full(len(at), -1)
        known[self.base] = self.base
        known[furthest] = furthest
        return np.maximum.accumulate(known) - offset

    def _right(self) -> np.ndarray:
        """For each place: from which place on the grams are surely the same whatever stands before it."""
        after = np.concatenate([self.gram[1:], [0]])
        step = np.where(self.gram == 4, 0, np.where(after >= 3, 1, 2))
        return np.where(self.rest >= 4, self.place + step, self.place + self.rest)

    def entries(self, ids: np.ndarray, ns: np.ndarray, buckets: int):
        """Record batches of the index: one row for each word and range of edits that leave the same grams alone."""
        size = len(self.word)
        # edits in order: 2 p and 2 p + 1 at each place, the last place of a word has the first only
        place = np.repeat(np.arange(size), 2)
        odd = np.tile(np.array([0, 1]), size)
        real = (odd == 0) | (self.rest[place] > 0)
        place, odd = place[real], odd[real]
        word = self.word[place]
        x, y = self.left[place], self.right[place + odd]
        new = np.ones(len(place), bool)
        new[1:] = (word[1:] != word[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(place)]]) - 1
        edit = 2 * self.place[place] + odd
        word, x, y, lo, hi = word[first], x[first], y[first], edit[first], edit[last]
        base, end = self.base[word], self.base[word] + self.rest[self.base[word]]
        window = np.zeros(len(word), np.int64)
        for j in range(7):
            window |= np.where(x + j < y, self.codes[base + x + j], 0) << _BITS * j
        before = np.where(x > 0, self.codes[np.maximum(base + x - 1, 0)], 0)
        window |= before << 7 * _BITS
        keys = []
        for lane in (0, 1):
            spans = Spans(self.codes, lane)
            outer = mix(spans(base, base + x) + x.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
            keys.append(mix(outer * _U(0xD1342543DE82EF95) + spans(base + y, end) + (end - base - y).astype(np.uint64) * _U(0xA0761D6478BD642F)))
        bucket = (keys[0] >> _U(20)) % _U(buckets)
        columns = [
            pa.array(bucket.astype(np.int32)), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(ids[word]), pa.array(ns[word]),
            pa.array(window), pa.array(((lo - 2 * x) << 8 | (hi - 2 * x)).astype(np.int32)),
        ]
        whole = pa.RecordBatch.from_arrays(columns, names=["bucket", "k1", "k2", "id", "n", "window", "edits"])
        for at in range(0, whole.num_rows, 1 << 17):
            yield whole.slice(at, 1 << 17)


def _merged(table: pa.Table) -> pa.Table:
    """Near words of the entries of one bucket: (id, near, best_n, best_id), a row for each word that has some."""
    k1, k2, ids, ns, window, edits = (table.column(c).to_numpy() for c in ("k1", "k2", "id", "n", "window", "edits"))
    lo, hi = edits >> 8, edits & 255
    many = hi - lo + 1
    row = np.repeat(np.arange(len(ids)), many)
    edit = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    at, odd = edit >> 1, (edit & 1).astype(bool)
    letters, before = window & (1 << 7 * _BITS) - 1, window >> 7 * _BITS
    below = letters[row] & (np.int64(1) << _BITS * at) - 1
    here, above = letters[row] >> _BITS * at & 127, letters[row] >> _BITS * (at + 1)
    kept = np.where(odd, below | above << _BITS * at, letters[row])
    previous = np.where(at > 0, letters[row] >> _BITS * np.maximum(at - 1, 0) & 127, before[row])
    leftmost = odd & (here != previous)
    agree = kept << 3 | at
    order = np.lexsort((ids[row], -ns[row], agree, k2[row], k1[row]))
    row, odd, leftmost, agree = row[order], odd[order], leftmost[order], agree[order]
    new = np.ones(len(row), bool)
    new[1:] = (agree[1:] != agree[:-1]) | (k1[row[1:]] != k1[row[:-1]]) | (k2[row[1:]] != k2[row[:-1]])
    group = np.cumsum(new) - 1
    groups = int(group[-1]) + 1 if len(group) else 0
    number = np.bincount(group[odd], minlength=groups)
    place = np.arange(len(row))

    def of_group(which: np.ndarray, skip: int = 0) -> np.ndarray:
        """Place of the first (or a later) chosen member of each group, else -1."""
        chosen, out = place[which], np.full(groups, -1)
        own = group[chosen]
        rank = np.arange(len(chosen)) - np.searchsorted(own, own)
        out[own[rank == skip]] = chosen[rank == skip]
        return out

    first, second, shorter, first_left = of_group(odd), of_group(odd, 1), of_group(~odd), of_group(leftmost)
    # words with another letter at this place
    c = place[odd & (number[group] > 1)]
    other = np.where(first[group[c]] == c, second[group[c]], first[group[c]])
    # the word without this letter
    d = place[leftmost & (shorter[group] >= 0)]
    # and back: words with one letter more
    lefts = np.bincount(group[leftmost], minlength=groups)
    e = place[~odd & (lefts[group] > 0)]
    who = np.concatenate([c, d, e])
    near = np.concatenate([number[group[c]] - 1, np.ones(len(d), np.int64), lefts[group[e]]])
    best = np.concatenate([other, shorter[group[d]], first_left[group[e]]])
    own, best_n, best_id = ids[row[who]], ns[row[best]], ids[row[best]]
    order = np.lexsort((best_id, -best_n, own))
    own, near, best_n, best_id = own[order], near[order], best_n[order], best_id[order]
    heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    total = np.add.reduceat(near, heads) if len(own) else near
    return pa.table({"id": own[heads], "near": total.astype(np.int64), "best_n": best_n[heads], "best_id": best_id[heads]})


def near_words(words: DataFrame, share: int = SHARE, bucket: int = BUCKET) -> DataFrame:
    """For words (id, word, n): (id, n_near, best_n, best_id) of those with near words; the best is the most frequent, the least id on ties."""
    letters, number = words.agg(F.coalesce(F.sum(F.length("word")), F.lit(0)), F.count("*")).first()
    frequent = frequent_grams(words, letters - number, share)
    buckets = parts_for(letters, bucket)

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                yield from Index(Letters.of(batch.column(1)), frequent).entries(batch.column(0).to_numpy(), batch.column(2).to_numpy(), buckets)

    entries = words.select("id", "word", "n").mapInArrow(index, _ENTRY)
    found = entries.groupBy("bucket").applyInArrow(_merged, _NEAR)
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("last"))).alias("best")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), best).select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.last")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for (id, form): where forms lead to in the end. A form occurs ten times as often, so chains are short and have no circle."""
    heads = forms.select(F.col("id").alias("_id"), F.col("form").alias("_form"))
    found = written(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = found.join(heads, F.col("root") == F.col("_id"))
        if further.isEmpty():
            return found
        found = written(found.join(heads, F.col("root") == F.col("_id"), "left").select("id", F.coalesce("_form", "root").alias("root")), "roots")


def spelling_variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, bucket: int = BUCKET) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n."""
    counted = word_counts(df, doc_id, text).orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n")
    words = written(counted, "vocabulary")
    near = near_words(words, share, bucket)
    joined = words.join(near.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    chosen = F.when(F.col("best_n") >= TIMES * F.col("n"), F.col("best_id"))
    table = written(joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), chosen.alias("form"), F.when(chosen.isNotNull(), F.col("best_n")).alias("form_n")), "near")
    ends = roots(table.where("form IS NOT NULL").select("id", "form"))
    names = words.select(F.col("id").alias("name_id"), F.col("word").alias("name"))
    named = ends.join(names, F.col("root") == F.col("name_id")).select(F.col("id").alias("end_id"), F.col("name").alias("root_word"))
    formed = table.where("form IS NOT NULL").join(names, F.col("form") == F.col("name_id")).join(named, F.col("id") == F.col("end_id"))
    columns = ["word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"]
    return formed.select("word", F.col("name").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").unionByName(table.where("form IS NULL").select(*columns))
