"""Helpers shared by the operators: column picking, staging, text buffers, prefix sums."""

from __future__ import annotations

import ctypes
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchforge.session import shared_folder, stage  # noqa: F401

# Words are runs of anything but these ASCII separators; case is folded for A-Z only.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that one vectorised step works on at a time.
SLICE_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Exactly the named columns; others, also ones differing only in case, are left out.

    A column that is named like another but for its case would make a plain
    ``select`` ambiguous, so columns are taken by position.
    """
    wanted = {**{n: n for n in names}, **renamed}
    at = {new: df.columns.index(old) for new, old in wanted.items()}
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{i}").alias(new) for new, i in at.items()))


def _give_back() -> None:
    """Return freed memory to the system: workers wait for their next task with what the last one left them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def _frugal(function: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _give_back()

    return run


def in_tasks(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, wherever the driver found it."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_matchforge_shipped", False):
        root, packed = Path(__file__).resolve().parents[2], io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(root.glob("matchforge/**/*.py")):
                archive.write(file, file.relative_to(root))
        # Spark's file server hands this code file, never data, to the executors
        folder = Path(tempfile.mkdtemp(prefix="matchforge-code-"))
        (folder / "matchforge.zip").write_bytes(packed.getvalue())
        context.addPyFile(str(folder / "matchforge.zip"))
        context._matchforge_shipped = True
    return df.mapInArrow(_frugal(function), schema)


def words(text):
    """Array of whole words of a text column; null gives an empty array."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each starts (one more at the end).

    Nulls count as empty. Arrow's own buffers are used, nothing is copied.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    start, n = 0, len(at) - 1
    while start < n:
        end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield start, min(end, n)
        start = min(end, n)


def with_offsets(rows: DataFrame, totals: DataFrame, part: str, size: str, into: str, local: str) -> DataFrame:
    """Turn positions inside ordered parts into positions in the whole.

    ``totals`` has one row per part (as many as there were tasks); the running
    sum over them is the second level of a prefix scan and is joined back.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias("_before"))
    return rows.join(F.broadcast(offsets), part).withColumn(into, F.col(local) + F.col("_before")).drop("_before")


# --- hashing of words straight from the bytes of a text buffer -----------------------

_STEP = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class _Powers:
    """Powers of an odd number modulo 2**64 and their inverses, as long as needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
                for base in (_STEP, pow(_STEP, -1, 1 << 64))
            )


_POWERS = _Powers()


def byte_values(fold_case: bool, gaps: bytes) -> np.ndarray:
    """A fixed random 64-bit number for each byte; none for gaps, A-Z as a-z if folded."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
    if fold_case:
        values[65:91] = values[97:123]
    values[list(gaps)] = 0
    return values


def unit_hashes(raw: np.ndarray, at: np.ndarray, values: np.ndarray, kinds: np.ndarray | None = None):
    """Hash and start of every unit (run of bytes with a value) in texts that start at ``at``.

    ``kinds`` also cuts a unit between bytes of kind 1 and kind 2. The hash is a
    polynomial in the bytes, taken at positions in the buffer and divided by the
    power at the unit's start, so all units of a buffer take a few array steps.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    _POWERS.reach(n)
    term = values[raw]
    inside = term != 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    if kinds is not None:
        k = kinds[raw]
        begin[1:] |= k[1:] * k[:-1] == 2
    heads = at[:-1][at[:-1] < n]
    begin[heads] = inside[heads]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    term *= _POWERS.up[:n]
    return mix(np.add.reduceat(term, starts) * _POWERS.down[starts]), starts


def span_hashes(raw: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes from one start to the next, the last one to the end."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _POWERS.reach(len(raw))
    return mix(np.add.reduceat(values[raw] * _POWERS.up[:len(raw)], starts) * _POWERS.down[starts])
