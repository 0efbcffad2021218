"""Alignment of two tokenizers over whole texts, with corpus-wide counts of linked ids.

Both tokenizers encode a space and the text: A is byte-level BPE, B a piece model that adds the
space itself. The bytes of their tokens are laid side by side; where tokens of both end at the
same byte, a group ends, and the two tokens that end there are linked. No token is empty,
so a group has exactly one link.

1. First pass: every task aligns its texts and counts links by pair of ids.
2. ``pair_counts`` gives each distinct pair a slot by minimal perfect hashing and sums the
   partial counts in dense vectors indexed by slot.
3. Second pass: texts are aligned again and the counts of their links looked up.

Texts are aligned unit by unit: they are cut before a space, line feed or tab that follows
something else, and between an ASCII letter and a mark. Neither tokenizer has a token across
such a cut (marks and white space are looked for in B's tokens when it is loaded; A's own
splitting ends there), so a text's alignment is that of its units, and those a worker
remembers are not worked out again. A text with other white
space, or whose units do not give back its bytes, is one unit.

Cases: a text that is null or empty, or whose tokens of A or B do not spell out a space and the
text, has no tokens: all numbers are 0 and its groups are empty. Rows that repeat an id, or have
none, are rows of their own; an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import itertools
import os
import re
import string
import uuid
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import byte_values, column, in_tasks, pick, slices, span_hashes, stage, text_bytes
from matchforge.llm.pair_counts import PARTIAL_SCHEMA, ROUND_KEYS, SHARD_KEYS, PairCounts, cells
from matchforge.llm.tokens import byte_letters, public_path

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
ROW_SCHEMA = f"doc_id long, {ALIGNED}, groups string"
# Units, and links in them, that a worker remembers; a full memory is emptied.
MEMORY_UNITS, MEMORY_LINKS = 400_000, 4_000_000
# Bytes of text aligned at a time.
ALIGN_BYTES = 1 << 20
# Different pairs a task holds before it gives them out.
HELD_PAIRS = 1 << 20
_VALUES = byte_values(False, b"")
# White space beyond ASCII, its rarer control characters, and the mark that B writes for a space.
_OTHER_SPACE = re.compile(
    rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xe2\x96\x81|\xef\xbb\xbf")
_SPACE = "▁"


class Tokenizers:
    """Both tokenizers with the bytes of each of their tokens."""

    def __init__(self, a_name: str, b_name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_path(a_name))
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.a.model
        self.letters = byte_letters()
        # B adds a space to what it encodes; units bring theirs along
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(Path(public_path(b_name)).read_bytes())
        if not proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError(f"{b_name} does not put one space before a text")
        proto.normalizer_spec.add_dummy_prefix = False
        self.b = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        byte_of = {letter: byte for byte, letter in self.letters.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in known]) for known in (self.a_bytes, self.b_bytes))
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        if any(_SPACE in p.lstrip(_SPACE) or "\n" in p or "\t" in p for p in plain):
            raise ValueError(f"tokens of {b_name} may cross white space")
        # ASCII marks that no token of B has behind an ASCII letter
        joined = {y for p in plain for x, y in zip(p, p[1:]) if x.isascii() and x.isalpha()}
        self.marks = [ord(c) for c in string.punctuation if c not in joined]

    def _a_ids(self, text: str) -> list[int]:
        word = text[1:] if text[0] == " " else text
        if word.isalpha() and max(word) < "\u0180":  # one word of A's splitting
            return [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        texts = [u.decode() for u in units]
        return list(map(self._a_ids, texts)), self.b.encode(texts, num_threads=1)


_STRINGS: dict[tuple[int, str], np.ndarray] = {}


def _written(n: int, behind: str) -> np.ndarray:
    """The numbers below ``n`` as text, each followed by ``behind``."""
    if (n, behind) not in _STRINGS:
        _STRINGS[n, behind] = np.array([f"{i}{behind}" for i in range(n)], object)
    return _STRINGS[n, behind]


class _Side:
    """Ids of one tokenizer for many units: their unit, and the byte each ends before."""

    def __init__(self, ids: list[list[int]], sizes: np.ndarray):
        self.ids = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.unit = np.repeat(np.arange(len(ids)), counts)
        self.ends = np.cumsum(sizes[self.ids])
        self.counts = counts


class Aligner:
    """Aligns texts through a memory of the units met so far; ``lookup`` and ``most`` add counts.

    Groups are written out only with a ``lookup``: the first pass does without them.
    """

    def __init__(self, names: tuple[str, str], lookup=None, most: np.ndarray | None = None, spelled: bool = False):
        self.tokenizers = Tokenizers(*names)
        self.second_ids = len(self.tokenizers.b_bytes)
        self.lookup, self.most, self.spelled = lookup, most, spelled or lookup is not None
        self.mark = np.zeros(256, bool)
        self.mark[self.tokenizers.marks] = True
        self.letter = np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.known = 0
        self.groups: list[str] = []
        self.odd = np.zeros(1 << 12, bool)  # the tokens do not spell out the unit
        # per unit: ids of A and B, groups, links, links that are their B id's best, sum of counts
        self.sums = np.zeros((1 << 12, 6), np.int64)
        self.keys = np.zeros(1 << 14, np.int64)
        self.first = np.zeros((1 << 12) + 1, np.int64)

    def _learn(self, hashes: list[int], units: list[bytes]) -> None:
        t, n, known = self.tokenizers, len(units), self.known
        all_a, all_b = t.encode(units)
        spelt = lambda ids, table: b"".join([table[i] for x in ids for i in x])
        whole = b"".join(units)
        odd = np.zeros(n, bool)
        if spelt(all_a, t.a_bytes) != whole or spelt(all_b, t.b_bytes) != whole:
            for i, unit in enumerate(units):
                if spelt(all_a[i:i + 1], t.a_bytes) != unit or spelt(all_b[i:i + 1], t.b_bytes) != unit:
                    odd[i], all_a[i], all_b[i] = True, [], []
        a, b = _Side(all_a, t.a_sizes), _Side(all_b, t.b_sizes)
        cuts = np.intersect1d(a.ends, b.ends, assume_unique=True)
        last_a, last_b = np.searchsorted(a.ends, cuts), np.searchsorted(b.ends, cuts)
        owner = a.unit[last_a]
        flat = a.ids[last_a] * self.second_ids + b.ids[last_b]
        sizes = np.bincount(owner, minlength=n)
        sums = np.zeros((n, 6), np.int64)
        sums[:, 0], sums[:, 1], sums[:, 2], sums[:, 3] = a.counts, b.counts, sizes, sizes
        if self.lookup is not None and len(flat):
            counts = self.lookup.counts(flat)
            best = (counts > 0) & (counts == self.most[flat % self.second_ids])
            sums[:, 4] = np.bincount(owner, best, n).astype(np.int64)
            np.add.at(sums[:, 5], owner, counts)
        if self.spelled:
            self.groups += self._spell(a, b, cuts, n)
        end = int(self.first[known]) + len(flat)
        while known + n > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            self.odd = np.concatenate([self.odd, np.zeros_like(self.odd)])
            self.first = np.concatenate([self.first, np.zeros(len(self.first) - 1, np.int64)])
        while end > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)])
        self.sums[known:known + n], self.odd[known:known + n] = sums, odd
        self.keys[self.first[known]:end] = flat
        self.first[known + 1:known + n + 1] = self.first[known] + np.cumsum(sizes)
        self.number.update(zip(hashes, range(known, known + n)))
        self.known += n

    @staticmethod
    def _spell(a: _Side, b: _Side, cuts: np.ndarray, n: int) -> list[str]:
        """The groups of each unit as text: ids in order of group, then side, each with what follows it."""
        group = np.concatenate([2 * np.searchsorted(cuts, a.ends), 2 * np.searchsorted(cuts, b.ends) + 1])
        order = np.argsort(group, kind="stable")
        group, unit = group[order], np.concatenate([a.unit, b.unit])[order]
        ids, of_b = np.concatenate([a.ids, b.ids])[order], order >= len(a.ids)
        behind = np.full(len(ids), 3)
        behind[:-1] = np.where(unit[1:] != unit[:-1], 3, np.where(group[1:] == group[:-1], 0, np.where(of_b[1:], 1, 2)))
        most, said = int(ids.max(initial=0)) + 1, np.empty(len(ids), object)
        for kind, mark in enumerate((",", "|", ";", "\n")):
            here = behind == kind
            said[here] = _written(1 << (most - 1).bit_length(), mark)[ids[here]]
        lines = iter("".join(said.tolist()).split("\n"))
        return [next(lines) if c else "" for c in a.counts.tolist()]

    def units(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units of all texts, and where those of each text begin (one more at the end).

        Every text begins with the space that was put before it; one of that space alone has no units.
        """
        if self.known > MEMORY_UNITS or self.first[self.known] > MEMORY_LINKS:
            self._forget()
        blank = (raw == 32) | (raw == 10) | (raw == 9)
        begin = np.zeros(len(raw), bool)
        begin[1:] = (blank[1:] & ~blank[:-1] & (raw[:-1] != 13)) | (self.letter[raw[:-1]] & self.mark[raw[1:]])
        data = raw.tobytes()
        sizes = np.diff(at)
        for m in _OTHER_SPACE.finditer(data):
            i = int(np.searchsorted(at, m.start(), "right")) - 1
            begin[at[i]:at[i + 1]] = False
        begin[at[:-1]] = True
        while True:
            starts = np.flatnonzero(begin)
            hashes = span_hashes(raw, starts, _VALUES)
            distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            keys = distinct.tolist()
            ends = np.append(starts[1:], len(raw))
            if new := [i for i, h in enumerate(keys) if h not in self.number]:
                self._learn([keys[i] for i in new], [data[starts[j]:ends[j]] for j in first[new]])
            numbers = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
            odd = self.odd[numbers][back]
            text_of = np.searchsorted(at, starts, "right") - 1
            split = np.bincount(text_of, minlength=len(sizes)) > 1
            whole = np.unique(text_of[odd & split[text_of]])
            if not len(whole):
                break
            for i in whole.tolist():  # judged again as one unit
                begin[at[i] + 1:at[i + 1]] = False
        said = sizes[text_of] > 1
        return numbers[back][said], np.searchsorted(text_of[said], np.arange(len(at)))

    def align(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Unit numbers of runs of texts, and where those of each text begin."""
        raw, at = text_bytes(texts)
        for a, b in slices(at, ALIGN_BYTES):
            local = at[a:b + 1] - at[a]
            yield self.units(np.insert(raw[at[a]:at[b]], local[:-1], 32), local + np.arange(len(local)))


_ALIGNERS: dict = {}


def aligner(names: tuple[str, str], held=None) -> Aligner:
    """One aligner per Python worker, and per table of counts."""
    key = (names, held and held[0])
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(names, *(held[1:] if held else ()))
    return _ALIGNERS[key]


def _count(batches: Iterator[pa.RecordBatch], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    """Links of a task's texts by pair of ids."""
    work, held_keys, held_n = aligner(names), [], []

    def gathered():
        keys, back = np.unique(np.concatenate(held_keys), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, back, np.concatenate(held_n))
        held_keys[:], held_n[:] = [keys], [n]
        return len(keys)

    def given_out():
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells(held_keys[0])), pa.array(held_keys[0]), pa.array(held_n[0])], names=["cell", "key", "n"])
        held_keys.clear(), held_n.clear()

    for batch in batches:
        for numbers, _ in work.align(column(batch, "text")):
            often = np.bincount(numbers, minlength=0)
            met = np.flatnonzero(often)
            sizes = work.first[met + 1] - work.first[met]
            spot = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            held_keys.append(work.keys[np.repeat(work.first[met], sizes) + spot])
            held_n.append(np.repeat(often[met], sizes))
            if sum(map(len, held_keys)) > HELD_PAIRS and gathered() > HELD_PAIRS // 2:
                yield from given_out()
    if held_keys and gathered():
        yield from given_out()


def _look_up(batches: Iterator[pa.RecordBatch], names: tuple[str, str], shared, run: str) -> Iterator[pa.RecordBatch]:
    work = aligner(names, (run, *shared.value))
    for batch in batches:
        ids, done = column(batch, "doc_id"), 0
        for numbers, first in work.align(column(batch, "text")):
            upto = np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(work.sums[numbers], axis=0)])
            sums, n = upto[first[1:]] - upto[first[:-1]], len(first) - 1
            said = [work.groups[i] for i in numbers.tolist()]
            groups = [";".join(said[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(done, n), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(6)), pa.array(groups, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])
            done += n


def align_tokenizers(
    docs: DataFrame, a_name: str, b_name: str, shard_keys: int = SHARD_KEYS, round_keys: int = ROUND_KEYS,
) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): numbers of ids, groups and links, links whose count is the
    highest of their B id, the sum of all links' counts, and ``groups`` as ``a1,a2|b1;a3|b2,b3``.

    Up to ``round_keys`` different pairs the second pass gives the result in one go. Beyond that it is taken
    once per round of shards, over rows that are written with a number of their own, and the rounds are summed.
    """
    names = (a_name, b_name)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    partials = stage(in_tasks(rows.select("text"), partial(_count, names=names), PARTIAL_SCHEMA), "pair_partials")
    counted = PairCounts(partials, shard_keys, round_keys)
    most = counted.most(len(Tokenizers(*names).b_bytes))
    context = docs.sparkSession.sparkContext

    def second_pass(some: DataFrame, shards: list[int]) -> DataFrame:
        shared = context.broadcast((counted.lookup(shards), most))
        return in_tasks(some, partial(_look_up, names=names, shared=shared, run=uuid.uuid4().hex), ROW_SCHEMA)

    if not counted.rounds:
        zeros = [F.lit(0).cast("long").alias(c.split()[0]) for c in ALIGNED.split(", ")]
        return rows.select("doc_id", *zeros, F.lit("").alias("groups"))
    if len(counted.rounds) == 1:
        return second_pass(rows, counted.rounds[0])
    numbered = stage(rows.withColumn("row", F.monotonically_increasing_id()), "numbered_rows")
    parts = [second_pass(numbered.select(F.col("row").alias("doc_id"), "text"), shards) for shards in counted.rounds]
    first = stage(parts[0], "aligned_rows")
    sums = first.select("doc_id", "n_best", "count_sum")
    for part in parts[1:]:
        sums = sums.unionByName(part.select("doc_id", "n_best", "count_sum"))
    summed = sums.groupBy("doc_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = first.drop("n_best", "count_sum").join(summed, "doc_id").withColumnRenamed("doc_id", "row")
    return numbered.select("row", "doc_id").join(whole, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
