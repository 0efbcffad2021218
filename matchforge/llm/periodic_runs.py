"""Periodic runs of words in whole texts, found by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least ``LEAST_LENGTH`` words and two periods, that no neighbouring word
extends. Texts are worked on whole, many short ones at a time:

1. The dictionary: every stretch of 2^k words gets a number, equal stretches of one
   text the same; the numbers of level k + 1 come from sorting pairs of numbers of level
   k. Only stretches that occur again in their text go on to the next level, so the
   levels end when nothing repeats.
2. Proposals: at level k the occurrences of a stretch of L = 2^k words, in text order,
   fall into arithmetic progressions (gaps up to L/2 all equal the stretch's period).
   From each progression its next three are as far as 2L reaches, and every difference
   from L to below 2L between their members is proposed as a period. Of two
   neighbouring progressions only the (n + m - 1) distinct differences are taken, so a
   level proposes a number of periods that is linear in the words.
3. Each proposal is extended to both sides by descending through the levels. What is
   long enough is a run; proposals of the same stretch meet in one row with its smallest
   period.

That this finds every run: a run of period q holds two copies of each stretch of L words
that starts in its first q - L + 1 words, L being the power of two with L <= q < 2L. The
stretch at its start either stands alone within L/2, so that a difference of its
progressions is q, or has a period of at most L/2; then the two progressions that hold
both copies have q among their differences.

Cases: a null text and one without words have no runs and an empty rest; rows that
repeat an id, or have none, are worked on each by itself; an empty table gives no
rows; extra columns, of any name, are left out. A text longer than the batch size is a
batch of its own, its arrays grow with its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import byte_values, column, in_tasks, mix, pick, slices, text_bytes, unit_hashes

LEAST_LENGTH = 12
RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, rest string"
# Bytes of text whose arrays are held at a time; a longer text is held whole.
HELD_BYTES = 1 << 19
_VALUES = byte_values(False, b" \t\n\r\x0b\x0c")
# Progressions behind one that can begin within twice the length of the stretch.
_REACH = 3


class _Level:
    """Stretches of ``size`` words that occur again: a number per start (-1: no other like it), and
    their starts ordered by number and place."""

    def __init__(self, size: int, at: np.ndarray, keys: np.ndarray, n: int):
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        head = np.ones(len(keys), bool)
        head[1:] = keys[1:] != keys[:-1]
        again = ~head
        again[:-1] |= ~head[1:]
        self.size = size
        self.starts = at[order[again]]
        self.numbers = (np.cumsum(head) - 1)[again].astype(np.int32)
        self.names = np.full(n, -1, np.int32)
        self.names[self.starts] = self.numbers

    def next(self) -> "_Level":
        n = len(self.names)
        at = np.flatnonzero(self.names[:max(0, n - self.size)] >= 0)
        at = at[self.names[at + self.size] >= 0]
        keys = self.names[at].astype(np.int64) << 32 | self.names[at + self.size]
        return _Level(2 * self.size, at, keys, n)

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of a stretch and the distance to another place of it, from the size to below its double."""
        starts, numbers, size = self.starts.astype(np.int64), self.numbers, self.size
        gap = np.diff(starts)
        near = (numbers[1:] == numbers[:-1]) & (2 * gap <= size)
        head = np.flatnonzero(np.concatenate([[True], ~near]))
        tail = np.append(head[1:], len(starts)) - 1
        first, last, number, count = starts[head], starts[tail], numbers[head], tail - head + 1
        found_at, found_far = [], []
        for step in range(1, _REACH + 1):
            a = np.arange(len(head) - step)
            b = a + step
            close = (number[a] == number[b]) & (first[b] - last[a] < 2 * size)
            a, b = a[close], b[close]
            # the later start moves back through one progression, then the far one forward through the other
            moves = count[a] + count[b] - 1
            pair = np.repeat(np.arange(len(a)), moves)
            t = np.arange(len(pair)) - np.repeat(np.cumsum(moves) - moves, moves)
            back = np.minimum(t, (count[a] - 1)[pair])
            at, to = starts[tail[a][pair] - back], starts[head[b][pair] + t - back]
            far = to - at
            fits = (far >= size) & (far < 2 * size)
            found_at.append(at[fits])
            found_far.append(far[fits])
        return np.concatenate(found_at), np.concatenate(found_far)


def _levels(words: np.ndarray, text_of: np.ndarray) -> list[_Level]:
    owners = mix(np.arange(1, int(text_of[-1]) + 2, dtype=np.uint64))
    level = _Level(1, np.arange(len(words)), words ^ owners[text_of], len(words))
    found = []
    while len(level.starts):
        found.append(level)
        level = level.next()
    return found


def _common(levels: list[_Level], a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
    """How many words agree from places ``a`` and ``b`` on, or up to just before them."""
    n, length = len(levels[0].names), np.zeros(len(a), np.int64)
    for level in reversed(levels):
        x, y = (p + length if ahead else p - length - level.size for p in (a, b))
        inside = (x >= 0) & (y < n)
        left, right = (level.names[np.where(inside, p, 0)] for p in (x, y))
        length += level.size * (inside & (left == right) & (left >= 0))
    return length


def find_runs(words: np.ndarray, text_of: np.ndarray, least: int = LEAST_LENGTH) -> np.ndarray:
    """Runs in texts laid one after another: rows of first word, end and period, in that order.

    ``words`` are 64-bit values of the words, ``text_of`` the ascending number of each one's text.
    """
    if not len(words):
        return np.zeros((0, 3), np.int64)
    levels, found = _levels(words, text_of), []
    for level in levels:
        at, far = level.proposals()
        order = np.lexsort((at, far))
        at, far = at[order], far[order]
        # neighbouring starts of one distance are one proposal
        new = np.ones(len(at), bool)
        new[1:] = (far[1:] != far[:-1]) | (at[1:] > at[:-1] + 1)
        at, far = at[new], far[new]
        start = at - _common(levels, at, at + far, False)
        end = at + far + _common(levels, at, at + far, True)
        long = end - start >= np.maximum(least, 2 * far)
        found.append(np.stack([start, end, far], axis=1)[long])
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[keep]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(column(batch, "text"))
        for a, b in slices(at, HELD_BYTES):
            part, local = raw[at[a]:at[b]], at[a:b + 1] - at[a]
            hashes, places = unit_hashes(part, local, _VALUES)
            first = np.searchsorted(places, local)  # first word of each text
            text_of = np.repeat(np.arange(b - a), np.diff(first))
            runs = find_runs(hashes, text_of)
            # words of a run behind its first period are repetitions
            cover = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 1], -1)
            kept = np.cumsum(cover[:-1]) == 0
            owner = text_of[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
            per_text = np.searchsorted(owner, np.arange(b - a + 1))
            rest = []
            for i in range(b - a):
                said = part[local[i]:local[i + 1]].tobytes().split()
                keep = kept[first[i]:first[i + 1]]
                rest.append(b" ".join(said if keep.all() else [said[j] for j in np.flatnonzero(keep)]).decode())
            lists = pa.StructArray.from_arrays(
                [pa.array(v) for v in (runs[:, 0] - first[:-1][owner], runs[:, 1] - runs[:, 0], runs[:, 2])],
                names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").slice(a, b - a), pa.array(np.diff(first)),
                 pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), lists), pa.array(rest, pa.string())],
                names=["doc_id", "n_words", "runs", "rest"])


def detect_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_words``, all ``runs`` by start, then period, and the
    ``rest``: the words that no run repeats, joined by single spaces."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return in_tasks(rows, _detect, RUNS_SCHEMA)
