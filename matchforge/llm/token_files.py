"""Token ids as Parquet list columns that can be read selectively.

Every document is one row: its id, its place in the corpus and its ids as a list.
Rows are in ascending document order inside and across files, row groups and pages
have a stated size, and the writer keeps page indexes, so a reader of some documents
or of the metadata columns alone touches only their pages.

Nulls, ties and other cases: a null text is empty and holds the end id only; rows
without ``doc_id`` come first; rows that repeat a ``doc_id`` are kept, in order of a
hash of their text; an empty table writes no rows; columns beyond the two named are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, pick, with_offsets
from matchforge.llm.tokens import encoder
from matchforge.session import shared_folder, work_folder

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
DIGEST_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long"
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20)},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Documents in ascending ``doc_id`` order with their ids, ``end_id`` last.

    ``part`` and ``local_start`` say which task encoded a row and how many ids that
    task had put out before it; the sizes of the parts make them global.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids, texts, row = column(batch, "doc_id"), column(batch, "text"), 0
            for ids, sizes in words.encode(texts, end_id):
                n, upto = len(sizes), np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    doc_ids.slice(row, n),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(before + upto - sizes),
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], upto]).astype(np.int32)), pa.array(ids.view(np.int32))),
                ], names=["doc_id", "part", "local_start", "n_tokens", "ids"])
                row, before = row + n, before + int(upto[-1])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    # the hash parts the rows of one id, or without one, if they are many
    order = ("doc_id", "_hash")
    ordered = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return in_tasks(ordered.drop("_hash"), encode, FILE_SCHEMA)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000,
) -> None:
    """Encode ``docs`` and write them; ``encoding`` is ``dictionary`` or ``delta``."""
    writer = encode_documents(docs, tokenizer, end_id).write.options(**ENCODINGS[encoding])
    writer.options(**{
        "compression": "zstd",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def document_starts(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` and ``n_tokens`` from the metadata columns; no ids are read."""
    meta = read_token_files(spark, path).drop("ids")
    totals = meta.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    return with_offsets(meta, totals, "part", "_size", "start", "local_start").select("doc_id", "start", "n_tokens")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = column(batch, "ids")
        ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1]
        ids = np.asarray(lists.values).astype("<u4")
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([
            column(batch, "doc_id"), column(batch, "part"), column(batch, "local_start"),
            pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64()),
        ], names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])


def file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``start``, ``n_tokens`` and the checksum of its ids."""
    lists = read_token_files(spark, path).select("doc_id", "part", "local_start", "ids")
    rows = in_tasks(lists, _digest, DIGEST_SCHEMA)
    meta = read_token_files(spark, path).select("part", "n_tokens")
    totals = meta.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    placed = with_offsets(rows, totals, "part", "_size", "start", "local_start")
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")


def new_folder(spark: SparkSession, name: str, kept: bool = False) -> str:
    """A fresh path in the shared folder, deleted with the staged tables of a run or ``kept`` behind it."""
    return f"{shared_folder(spark).rstrip('/')}/kept/{name}-{uuid.uuid4().hex}" if kept else work_folder(spark, name)
