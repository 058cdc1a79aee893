"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find the n-grams that a text repeats;
the measure is how many characters of the text lie inside them, and inside
lines that were seen before. Of two to four words, which any text repeats, only
the one n-gram that covers most counts. One pass over each text, no shuffle.

Symbols are counted and reported, but are no part of the verdict.

Defined results: a null or empty text has no words, so it fails the word
minimum; equal rows give equal results; an input column named like a result
column is replaced by the result; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowhaul.llm.frames import map_batches
from rowhaul.llm.words import Words, covered, window_hashes, windows_within

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Largest share of a text's word characters inside its repeated n-grams, by words in the n-gram;
#: the base rule leaves up to a fifth of the words, of which longer n-grams hold no more.
COVERAGE = {6: 0.16, 8: 0.14, 10: 0.12, 13: 0.10}
#: Largest share of a text's word characters inside any one n-gram that it holds ``FREQUENT`` times or more.
SINGLE = {2: 0.20, 3: 0.18, 4: 0.16}
FREQUENT = 3
#: Largest share of characters in lines seen before.
LINE_COVERAGE = 0.30

RESULT = [
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("repeat_share", T.DoubleType()), T.StructField("dup_line_share", T.DoubleType()),
]


def repeated_words(words: Words, hashes: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in an n-gram that their text holds twice or more, the first included."""
    keys = window_hashes(hashes, n)
    if not len(keys):
        return np.zeros(len(words), bool)
    keys = (keys ^ (text_of[: len(keys)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))) | np.uint64(1)
    inside = windows_within(words.first, n, len(keys))
    ordered = np.sort(keys[inside])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return covered(np.flatnonzero((twice[at] == keys) & inside), n, len(words))


def single_chars(words: Words, hashes: np.ndarray, text_of: np.ndarray, chars: np.ndarray, n: int) -> np.ndarray:
    """For each text the most characters that lie in one n-gram, of those it holds ``FREQUENT`` times or more."""
    most = np.zeros(len(words.counts), np.int64)
    keys = window_hashes(hashes, n)
    if not len(keys):
        return most
    keys = keys ^ (text_of[: len(keys)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    inside = windows_within(words.first, n, len(keys))
    ordered = np.sort(keys[inside])
    often = ordered[FREQUENT - 1 :][ordered[FREQUENT - 1 :] == ordered[: 1 - FREQUENT]]
    if not len(often):
        return most
    near = np.minimum(np.searchsorted(often, keys), len(often) - 1)
    at = np.flatnonzero((often[near] == keys) & inside)
    at = at[np.argsort(keys[at], kind="stable")]
    again = np.concatenate([[False], keys[at[1:]] == keys[at[:-1]]])
    # overlapping occurrences share their words
    new = at.copy()
    new[again] = np.maximum(at[again], at[np.flatnonzero(again) - 1] + n)
    sums = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    groups = np.flatnonzero(~again)
    np.maximum.at(most, text_of[at[groups]], np.add.reduceat(sums[at + n] - sums[new], groups))
    return most


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line: their number and their characters."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0, 0
    seen, number, chars = set(), 0, 0
    for line in lines:
        if line in seen:
            if line.strip(" \t\n\x0b\x0c\r"):
                number += 1
                chars += len(line)
        else:
            seen.add(line)
    return number, chars


def measure(column) -> pa.RecordBatch:
    """The result columns for a column of texts."""
    words = Words(column)
    first, size = words.first, len(words)
    per_text = lambda values: np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[first])
    hashes, chars, text_of = words.hashes(), words.chars(), words.text_of()
    n_words, word_chars = words.counts.astype(np.int64), per_text(chars)
    at = np.concatenate([[0], np.cumsum(SYMBOLS[words.data], dtype=np.int64)])
    n_symbols = np.diff(at[words.offsets])
    n_repeat = per_text(repeated_words(words, hashes, text_of, 5)) if size else np.zeros(len(n_words), np.int64)
    shares, failed = np.zeros(len(n_words)), np.zeros(len(n_words), bool)
    for n, most in COVERAGE.items():
        share = per_text(np.where(repeated_words(words, hashes, text_of, n), chars, 0)) / np.maximum(word_chars, 1)
        shares, failed = np.maximum(shares, share), failed | (share > most)
    for n, most in SINGLE.items():
        share = single_chars(words, hashes, text_of, chars, n) / np.maximum(word_chars, 1)
        shares, failed = np.maximum(shares, share), failed | (share > most)
    lines = np.array([repeated_lines(x) if x else (0, 0) for x in column.to_pylist()], np.int64).reshape(-1, 2)
    code_points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80, dtype=np.int64)])
    line_share = lines[:, 1] / np.maximum(np.diff(code_points[words.offsets]), 1)
    base_failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
    kept = ~(base_failed | failed | (line_share > LINE_COVERAGE))
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (n_words, word_chars, n_symbols, lines[:, 0], n_repeat, base_failed, kept, shares, line_share)], names=[f.name for f in RESULT]
    )


def repetition_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measures, ``base_failed`` and the verdict ``kept`` for each row."""
    return map_batches(df, text, RESULT, measure)
