"""License detection by ordered signature rules.

A text becomes its words in lower case with single spaces between. One pass of an
Aho-Corasick automaton over it finds which keywords occur; only rules whose keyword
does are matched, over the whole text. Detections that overlap are resolved by rank:

* a detection is dropped if its words contain, or are contained in, those of a kept one
  of a kind with higher priority (tag, license words, address, name, hint);
* inside a kind a detection that lies inside a longer one is dropped, and of equal
  stretches the one whose rule comes first stays;
* detections that only cross each other both stay.

Base phrases are outside this contest: every place of theirs is reported.
The score of a text is the chance that at least one of its labels is right, each label
counted once with the weight of the best kind that it was found by.

Cases: a null text is empty and has no words, no detections and score 0; a text
without license words has score 0; rows that repeat an id, or have none, are
judged each by itself; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, pick, slices, text_bytes
from matchforge.llm.license_rules import KINDS, Rule, load_rules

SCAN_SCHEMA = (
    "doc_id long, n_words long, score double, "
    "detections array<struct<label:string,kind:string,start:long,end:long,base:boolean>>")
# Bytes that are no part of a word, and A-Z.
_SPACED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Scanner:
    """All rules, and the automaton of their keywords."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = load_rules() if rules is None else rules
        by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            by_keyword.setdefault(rule.keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self.automaton.add_word(keyword, tuple(numbers))
        self.automaton.make_automaton()
        self.priority = np.array([KINDS[r.kind][0] for r in self.rules])

    def gated(self, spaced: str) -> list[int]:
        """Rules whose keyword occurs."""
        met = {numbers for _, numbers in self.automaton.iter(spaced)}
        return sorted(i for numbers in met for i in numbers)

    def matches(self, spaced: str, rules: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rule, first word and word behind the last one of every match, by rule and place."""
        found = [(i, *m.span()) for i in rules for m in self.rules[i].pattern.finditer(spaced)]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        number, first, last = np.array(found, np.int64).T
        spaces = np.flatnonzero(np.frombuffer(spaced.encode("latin-1"), np.uint8) == 32)
        return number, np.searchsorted(spaces, first - 1), np.searchsorted(spaces, last)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words, and the detections (rule, start, end) that stay, by place."""
        said = text.translate(_SPACED).split()
        # one letter a byte, so that places in the string are places in the bytes
        spaced = f" {b' '.join(said).decode('latin-1')} "
        rules = self.gated(spaced)
        if not rules:
            return len(said), []
        number, start, end = self.matches(spaced, rules)
        base = np.array([self.rules[i].base for i in number], bool)
        contest = np.flatnonzero(~base)
        stays = contest[resolve(self.priority[number[contest]], number[contest], start[contest], end[contest])]
        kept = np.concatenate([np.flatnonzero(base), stays])
        return len(said), sorted(zip(number[kept].tolist(), start[kept].tolist(), end[kept].tolist()), key=lambda d: (d[1], d[2], d[0]))

    def score(self, numbers: set[int]) -> float:
        best: dict[str, float] = {}
        for i in numbers:
            rule = self.rules[i]
            best[rule.label] = max(best.get(rule.label, 0.0), KINDS[rule.kind][1])
        wrong = 1.0
        for label in sorted(best):
            wrong *= 1 - best[label]
        return round(1 - wrong, 6)


def resolve(priority: np.ndarray, rule: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places of the detections that stay: by priority, containment either way, then by length and rule."""
    kept = np.zeros(0, np.int64)
    for level in np.unique(priority):
        own = np.flatnonzero(priority == level)
        if len(kept):
            by_start = kept[np.argsort(start[kept], kind="stable")]
            starts, ends = start[by_start], end[by_start]
            reach = np.maximum.accumulate(ends)  # of those that begin so far
            least = np.minimum.accumulate(ends[::-1])[::-1]  # of those that begin from here on
            upto, since = np.searchsorted(starts, start[own], "right"), np.searchsorted(starts, start[own], "left")
            inside = (upto > 0) & (reach[np.maximum(upto, 1) - 1] >= end[own])
            around = (since < len(starts)) & (least[np.minimum(since, len(starts) - 1)] <= end[own])
            own = own[~inside & ~around]
        own = own[np.lexsort((rule[own], -end[own], start[own]))]
        if len(own):
            before = np.concatenate([[-1], np.maximum.accumulate(end[own])[:-1]])
            kept = np.concatenate([kept, own[end[own] > before]])
    return kept


_SCANNERS: list[Scanner] = []


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _SCANNERS:
        _SCANNERS.append(Scanner())
    scanner = _SCANNERS[0]
    for batch in batches:
        raw, at = text_bytes(column(batch, "text"))
        for a, b in slices(at):
            counts, scores, found, sizes = [], [], [], [0]
            for i in range(a, b):
                n, kept = scanner.scan(raw[at[i]:at[i + 1]].tobytes())
                counts.append(n)
                scores.append(scanner.score({number for number, _, _ in kept}))
                found += kept
                sizes.append(len(found))
            rules = [scanner.rules[number] for number, _, _ in found]
            detections = pa.StructArray.from_arrays([
                pa.array([r.label for r in rules], pa.string()), pa.array([r.kind for r in rules], pa.string()),
                pa.array([s for _, s, _ in found], pa.int64()), pa.array([e for _, _, e in found], pa.int64()),
                pa.array([r.base for r in rules], pa.bool_()),
            ], names=["label", "kind", "start", "end", "base"])
            yield pa.RecordBatch.from_arrays([
                column(batch, "doc_id").slice(a, b - a), pa.array(counts, pa.int64()), pa.array(scores, pa.float64()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), detections),
            ], names=["doc_id", "n_words", "score", "detections"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_words``, ``score`` and the ``detections`` by place,
    each with its label, kind, first word, word behind its last one, and whether it is a base phrase."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return in_tasks(rows, _scan, SCAN_SCHEMA)
