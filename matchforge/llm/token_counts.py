"""Token counts of flat, unindexed token files by a scan for separators.

A flat file is nothing but ids of fixed width, documents one after another, each
closed by an end-of-document id. Files are cut into blocks of equal bytes; tasks
look for the end id in whole blocks at once. A document may begin many blocks before
the one it ends in: block summaries (last separator, number of separators) go
through a two-level prefix scan, which gives each block the last separator before
it and the number of documents before it.

Cases: adjacent separators are documents of no tokens; ids behind the last separator
of a file are a document with ``closed`` false; an empty file has no documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, pick, stage
from matchforge.llm.token_files import new_folder
from matchforge.llm.tokens import encoder

# Files written here hold id + 1 in two bytes; 0 closes a document.
END_ID = 0
ID_BYTES = 2
BLOCK_BYTES = 4 << 20
# Blocks whose summaries one task scans.
SPAN_BLOCKS = 1024
_SCAN = "path string, block long, n_seps long, last_sep long, size long, ends array<long>, befores array<long>"


def write_flat_files(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Tokens of each text, then the end id, in the order of the rows; one file per task.

    Spark's text writer puts the bytes of a row and then its line separator, which
    here is the end id, so files are committed like any other Spark output.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer, plain_specials=True)
        for batch in batches:
            for ids, sizes in words.encode(column(batch, "text"), 0):
                data, ends = (ids + 1).astype("<u2").tobytes(), np.cumsum(sizes) * ID_BYTES
                starts = np.concatenate([[0], ends[:-1]])
                # the writer adds the end id itself
                yield pa.RecordBatch.from_arrays(
                    [pa.array([data[a:b - ID_BYTES] for a, b in zip(starts, ends)], pa.binary())], names=["ids"])

    rows = in_tasks(pick(docs, "text"), encode, "ids binary")
    rows.select(F.col("ids").cast("string")).write.option("lineSep", "\0" * ID_BYTES).text(path)


def _open(uri: str):
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
    return filesystem.open_input_file(path)


def count_tokens(
    spark: SparkSession, path: str, end_id: int = END_ID, id_bytes: int = ID_BYTES, block_bytes: int = BLOCK_BYTES,
    span_blocks: int = SPAN_BLOCKS,
) -> DataFrame:
    """One row per document: ``path``, ``ordinal`` in its file, ``start``, ``n_tokens``, ``closed``.

    ``start`` is the place of its first id in the file; the end id is not counted.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    block_bytes -= block_bytes % id_bytes
    blocks = files.select("path", "length", F.explode(F.expr(f"sequence(0L, (length - 1) div {block_bytes})")).alias("block"))
    tasks = max(1, files.select(F.sum(F.ceil(F.col("length") / block_bytes))).first()[0] or 0)
    kind = np.dtype(f"<u{id_bytes}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = row["block"] * block_bytes
                with _open(row["path"]) as file:
                    ids = np.frombuffer(file.read_at(min(block_bytes, row["length"] - at), at), kind)
                ends = np.flatnonzero(ids == end_id) + at // id_bytes
                last = int(ends[-1]) if len(ends) else None
                befores = [None, *ends[:-1].tolist()] if len(ends) else []
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["path"]]), pa.array([row["block"]], pa.int64()), pa.array([len(ends)], pa.int64()),
                    pa.array([last], pa.int64()), pa.array([row["length"] // id_bytes], pa.int64()),
                    pa.array([ends], pa.list_(pa.int64())), pa.array([befores], pa.list_(pa.int64())),
                ], names=["path", "block", "n_seps", "last_sep", "size", "ends", "befores"])

    # a block per task up to a few thousand tasks; the shuffled rows are block numbers only
    spread = blocks.repartition(int(min(tasks, 4096)), "path", "block")
    scanned = stage(in_tasks(spread, scan, _SCAN), "separators")

    sums = scanned.drop("ends", "befores").withColumn("span", F.expr(f"block div {span_blocks}"))
    spans = sums.groupBy("path", "span").agg(F.sum("n_seps").alias("n"), F.max("last_sep").alias("last"))
    over = Window.partitionBy("path").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("path", "span", F.sum("n").over(over).alias("n_span"), F.max("last").over(over).alias("last_span"))
    inner = Window.partitionBy("path", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "path", "span", "block", F.sum("n_seps").over(inner).alias("n_in"), F.max("last_sep").over(inner).alias("last_in"),
    ).join(spans, ["path", "span"]).select(
        "path", "block",
        (F.coalesce("n_in", F.lit(0)) + F.coalesce("n_span", F.lit(0))).alias("docs_before"),
        F.coalesce(F.greatest("last_in", "last_span"), F.lit(-1)).cast("long").alias("sep_before"),
    )
    placed = scanned.join(carried, ["path", "block"])
    # the separator before each end is the one before it in its block, or the one carried in
    closed = placed.select(
        "path", "docs_before", "sep_before", F.posexplode(F.arrays_zip("ends", "befores")).alias("k", "sep"),
    ).select(
        "path", (F.col("docs_before") + F.col("k")).alias("ordinal"), F.col("sep.ends").alias("end"),
        F.coalesce("sep.befores", "sep_before").alias("before"), F.lit(True).alias("closed"),
    )
    tails = scanned.groupBy("path").agg(
        F.sum("n_seps").alias("ordinal"), F.first("size").alias("end"),
        F.coalesce(F.max("last_sep"), F.lit(-1)).cast("long").alias("before"),
    ).where("end > before + 1").withColumn("closed", F.lit(False))
    return closed.unionByName(tails).select(
        "path", "ordinal", (F.col("before") + 1).alias("start"),
        (F.col("end") - F.col("before") - 1).alias("n_tokens"), "closed")


def document_places(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the file number and ordinal at which ``write_flat_files`` puts it.

    The writer keeps the order of the rows and makes one file per task, so the
    places follow from a scan of the ids alone. ``docs`` must be a plain table scan.
    """
    places = docs.select(
        "doc_id", F.spark_partition_id().alias("file_no"), F.monotonically_increasing_id().alias("_at"))
    return places.select("doc_id", "file_no", F.col("_at").bitwiseAND((1 << 33) - 1).alias("ordinal"))


def count_document_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as flat files, scan them, and give every document its count.

    Rows: ``doc_id``, ``file_no``, ``ordinal``, ``start``, ``n_tokens``. A null or empty
    text counts 0; repeated rows are counted each; other columns are ignored.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "flat")
    rows = pick(docs, "doc_id", "text")
    write_flat_files(rows, path, tokenizer)
    counted = count_tokens(spark, path).withColumn(
        "file_no", F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("int"))
    places = document_places(rows.select(F.col("doc_id").cast("long").alias("doc_id")))
    # an outer join: a place or a document without its partner must not vanish
    joined = places.join(counted.drop("path", "closed"), ["file_no", "ordinal"], "full")
    return joined.select(
        "doc_id", "file_no", "ordinal",
        F.coalesce("start", F.raise_error(F.lit("documents and files differ"))).cast("long").alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"))
