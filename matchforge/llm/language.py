"""Language of whole texts: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every run of other characters than letters becomes one space,
and runs of two and three characters are hashed into a fixed number of buckets.
Counts per language and bucket are taken over all labelled rows by tasks and summed
by Spark. The smoothed log-probabilities, one row per bucket and one column per
language, are broadcast: their size is buckets x languages whatever the corpus.
A batch is scored by one gather of rows and one sum per text.

Cases: a null text, or one without a letter, is ``und`` with score 0; a null label
teaches nothing; if nothing was learned, all texts are ``und``; equal posteriors go
to the first language by name; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, mix, slices, text_bytes

UNDETERMINED = "und"
ORDERS = (2, 3)
BUCKET_BITS = 16
SMOOTHING = 0.5
# The broadcast matrix has this many columns at most: 256 MB at 16 bits.
MAX_LANGUAGES = 1024
# Matrix cells gathered at a time.
GATHERED = 4 << 20
_SEPARATOR = 0
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, itself if a letter, else a space; made once per worker."""
    if not _LETTERS:
        codes = np.arange(0x110000, dtype=np.uint32)
        codes[np.fromiter((not chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)] = 32
        _LETTERS.append(codes)
    return _LETTERS[0]


def grams(raw: np.ndarray, at: np.ndarray, bits: int = BUCKET_BITS):
    """For each order the buckets of all n-grams and their texts; and which texts have letters."""
    data = raw.tobytes()
    texts = [data[a:b].decode() for a, b in zip(at[:-1], at[1:])]
    joined = "\0".join(t.replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = codes == _SEPARATOR
    chars = _letters()[codes]
    chars[ends] = _SEPARATOR
    space = chars == 32
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    chars, space, ends = chars[keep], space[keep], ends[keep]
    text_of = np.cumsum(ends)
    has_letter = np.zeros(len(texts), bool)
    has_letter[text_of[~space & ~ends]] = True
    wide, found = chars.astype(np.uint64), []
    for n in ORDERS:
        last = max(0, len(chars) - n + 1)
        h = np.full(last, n, np.uint64)
        inside = np.ones(last, bool)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + wide[i:i + last]
            inside &= ~ends[i:i + last]
        found.append(((mix(h) >> np.uint64(64 - bits)).astype(np.int32)[inside], text_of[:last][inside]))
    return found, has_letter


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    def score(self, raw: np.ndarray, at: np.ndarray) -> tuple[list[str], np.ndarray]:
        size, languages = self.log_prob.shape
        found, has_letter = grams(raw, at, size.bit_length() - 1)
        total = np.tile(self.log_prior, (len(at) - 1, 1))
        step = max(1024, GATHERED // languages)
        for buckets, owners in found:
            for i in range(0, len(buckets), step):
                own = owners[i:i + step]
                first = np.flatnonzero(np.concatenate([[True], np.diff(own) > 0]))
                rows = self.log_prob[buckets[i:i + step]]
                total[own[first]] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
        best = total.argmax(1)
        shares = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter)]
        return names, np.where(has_letter, shares, 0.0)


def fit(rows: DataFrame, bits: int = BUCKET_BITS) -> Model | None:
    """Learn from all rows of ``text`` and ``lang``; None if there is nothing to learn from."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            langs = np.array(column(batch, "lang").to_pylist(), object)
            raw, at = text_bytes(column(batch, "text"))
            for a, b in slices(at):
                found, _ = grams(raw[at[a]:at[b]], at[a:b + 1] - at[a], bits)
                own = langs[a:b]
                for lang in set(own.tolist()):
                    texts[lang] = texts.get(lang, 0) + int((own == lang).sum())
                    for buckets, owners in found:
                        new = np.bincount(buckets[(own == lang)[owners]], minlength=1 << bits)
                        sums[lang] = sums[lang] + new if lang in sums else new
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            # bucket -1 carries the number of texts
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(at) + 1), pa.string()),
                pa.array(np.concatenate([at, [-1]]).astype(np.int64)),
                pa.array(np.concatenate([found[at], [texts[lang]]]).astype(np.int64)),
            ], names=["lang", "bucket", "n"])

    labelled = rows.where("lang is not null and text is not null").select("text", "lang")
    partial = in_tasks(labelled, count, "lang string, bucket long, n long")
    counted = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # buckets x languages numbers, not more however large the corpus
    table = counted.toArrow()
    langs = np.array(table.column("lang").to_pylist(), object)
    languages = sorted(set(langs.tolist()))
    if not languages:
        return None
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    buckets, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts, texts = np.zeros((1 << bits, len(languages))), np.zeros(len(languages))
    for j, lang in enumerate(languages):
        own, cell = langs == lang, buckets >= 0
        counts[buckets[own & cell], j] = n[own & cell]
        texts[j] = n[own & ~cell][0]
    smooth = counts + SMOOTHING
    log_prob = np.log(smooth / smooth.sum(0)).astype(np.float32)
    return Model(languages, np.log(texts / texts.sum()), log_prob)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` (which has ``text``) with ``lang_pred`` and ``score``."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.drop("lang_pred", "score")
    fields = [f for f in out.schema.fields]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(column(batch, "text"))
            names, shares = [], [np.zeros(0)]
            for a, b in slices(at):
                some, share = shared.value.score(raw[at[a]:at[b]], at[a:b + 1] - at[a])
                names += some
                shares.append(share)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(np.concatenate(shares))],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = out.schema.__class__([*fields]).add("lang_pred", "string").add("score", "double")
    return in_tasks(out, score, schema)
