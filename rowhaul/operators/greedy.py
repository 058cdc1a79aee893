"""Greedy batch cutting that can start anywhere in the row sequence.

A batch closes before the row that would make it exceed ``rows`` records or
``cap`` bytes. The whole sequence is cut as one serial pass would cut it, yet
in parallel: a segment of rows is summarised as a function from "what the open
batch holds on entry" to "what it holds on exit". The function is small,
because an entry state only decides where the segment's first new batch
starts, and that is never further than one batch from the segment's head.
Summaries compose, so a few of them stand for any number of rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Summary(NamedTuple):
    count: int
    total: int
    prefix: np.ndarray  # bytes before each row of the head
    exit_rows: np.ndarray  # for a first new batch at row j: rows of the batch open on exit,
    exit_bytes: np.ndarray  # its bytes,
    starts: np.ndarray  # and how many batches started in the segment


def _following(prefix: np.ndarray, rows: int, cap: int) -> np.ndarray:
    """For a batch starting at each row, the row that starts the next one (row count: none)."""
    count = len(prefix) - 1
    at = np.arange(count)
    by_bytes = np.searchsorted(prefix, prefix[:-1] + cap, side="right") - 1
    return np.minimum(np.maximum(np.minimum(by_bytes, at + rows), at + 1), count)


def _first_start(prefix: np.ndarray, held_rows, held_bytes, rows: int, cap: int):
    """Row that starts the first new batch, given what the open batch already holds (no rows: none is open)."""
    by_bytes = np.searchsorted(prefix, cap - held_bytes, side="right") - 1
    return np.where(held_rows == 0, 0, np.minimum(by_bytes, np.maximum(rows - held_rows, 0)))


def _head(prefix: np.ndarray, count: int, rows: int, cap: int) -> int:
    """Furthest row at which an open batch of at least one row can end."""
    return int(min(count, rows - 1, np.searchsorted(prefix, cap, side="right") - 1))


def summarise(sizes: np.ndarray, rows: int, cap: int) -> Summary:
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    count, total = len(sizes), int(prefix[-1])
    following = _following(prefix, rows, cap)
    head = _head(prefix, count, rows, cap)
    at = np.arange(min(head, count - 1) + 1)
    starts = np.ones(len(at), np.int64)
    while True:
        then = following[at]
        inside = then < count
        if not inside.any():
            break
        at = np.where(inside, then, at)
        starts += inside
    return Summary(count, total, prefix[: head + 2], count - at, total - prefix[at], starts)


def advance(summary: Summary, held_rows, held_bytes, rows: int, cap: int):
    """Open batch after the segment, and batches started in it; works on arrays of entry states."""
    first = _first_start(summary.prefix, held_rows, held_bytes, rows, cap)
    none = first >= summary.count
    at = np.minimum(first, len(summary.exit_rows) - 1)
    return (
        np.where(none, held_rows + summary.count, summary.exit_rows[at]),
        np.where(none, held_bytes + summary.total, summary.exit_bytes[at]),
        np.where(none, 0, summary.starts[at]),
    )


def compose(first: Summary, second: Summary, rows: int, cap: int) -> Summary:
    """Summary of two adjacent segments."""
    exit_rows, exit_bytes, more = advance(second, first.exit_rows, first.exit_bytes, rows, cap)
    starts = first.starts + more
    prefix, count = first.prefix, first.count + second.count
    if len(prefix) == first.count + 1:
        # The open batch may outlast the first segment: its end can lie in the second.
        prefix = np.concatenate([prefix, first.total + second.prefix[1:]])
        head = _head(prefix, count, rows, cap)
        keep = min(head, count - 1) + 1
        prefix = prefix[: head + 2]
        exit_rows = np.concatenate([exit_rows, second.exit_rows])[:keep]
        exit_bytes = np.concatenate([exit_bytes, second.exit_bytes])[:keep]
        starts = np.concatenate([starts, second.starts])[:keep]
    return Summary(count, first.total + second.total, prefix, exit_rows, exit_bytes, starts)


def cut(sizes: np.ndarray, held_rows: int, held_bytes: int, rows: int, cap: int):
    """Batches started up to and including each row, and the open batch after the last row."""
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    count = len(sizes)
    started = np.zeros(count, np.int64)
    start = int(_first_start(prefix, np.int64(held_rows), np.int64(held_bytes), rows, cap))
    if start >= count:
        return started, held_rows + count, held_bytes + int(prefix[-1])
    while True:
        started[start] = 1
        by_bytes = int(np.searchsorted(prefix, prefix[start] + cap, side="right")) - 1
        then = max(min(by_bytes, start + rows), start + 1)
        if then >= count:
            return np.cumsum(started), count - start, int(prefix[-1] - prefix[start])
        start = then
