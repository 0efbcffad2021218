"""Raw match chunks: reading with a stable order, and appending new ones."""

from __future__ import annotations

import logging
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.operators.incremental import landed_keys
from matchforge.session import COMPACT, hadoop_path, sought_by

log = logging.getLogger(__name__)

# Columns that put raw records in file and row order.
FILE_ORDER = ("source_file", "source_row")
_CHUNKS = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true"}
_LAYOUT = {**COMPACT, **sought_by("match_id", rows=40_000, block=2 << 20)}


def read_parquet_if_present(
    spark: SparkSession, path: str, ddl: str | None = None, **options: str
) -> DataFrame | None:
    """The dataset at ``path``, or None with a warning when nothing is there."""
    reader = spark.read.options(**options)
    if ddl:
        reader = reader.schema(ddl)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("nothing to read at %s", path)
        return None


def read_raw_matches(spark: SparkSession, raw_dir: str, appended: str | None = None) -> DataFrame | None:
    """All landed chunks, or those of one append, with the file and row each record came from."""
    raw = read_parquet_if_present(
        spark, appended or f"{raw_dir}/matches", schema.RAW_MATCH_SCHEMA, **_CHUNKS)
    return None if raw is None else with_file_order(raw)


def with_file_order(raw: DataFrame) -> DataFrame:
    """Raw records with the file and row each came from."""
    return raw.select(
        "match_id", "_raw_json", "_region",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
    )


def _readable(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    return read_parquet_if_present(
        spark, f"{raw_dir}/matches", schema.RAW_MATCH_SCHEMA, ignoreCorruptFiles="true", **_CHUNKS)


def silent_chunks(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``source_file`` of the chunks that give no record: unreadable, or written empty.

    The files are listed without their contents, and the records counted per file from
    the footers alone; a chunk that breaks off behind its first records is not among them.
    """
    readable = _readable(spark, raw_dir)
    if readable is None:
        return spark.createDataFrame([], "source_file STRING")
    path = F.col("_metadata.file_path").alias("source_file")
    listed = spark.read.format("binaryFile").options(**_CHUNKS).load(f"{raw_dir}/matches").select(path)
    return listed.join(readable.select(path).distinct(), "source_file", "left_anti")


def landed_match_ids(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Distinct landed ids; chunks without a readable record are skipped, and their number logged."""
    raw = _readable(spark, raw_dir)
    if raw is None:
        return spark.createDataFrame([], "match_id STRING")
    skipped = silent_chunks(spark, raw_dir).count()
    if skipped:
        log.warning("%d chunks under %s give no record; silent_chunks lists them", skipped, raw_dir)
    return landed_keys(raw)


def append_raw_matches(new: DataFrame, raw_dir: str) -> str | None:
    """Append new records as a further folder of chunks and return its path; nothing new writes nothing.

    The folder's name holds the time of the append, behind all ``chunk_`` names, so the
    order of paths is the order of arrival. The records are computed once, by the job that
    writes them under a hidden name; what was written decides whether there was anything.
    """
    spark, name = new.sparkSession, f"landed_{time.time_ns():020d}"
    folder = f"{raw_dir}/matches"
    files, hidden = hadoop_path(spark, f"{folder}/.{name}")
    _, landed = hadoop_path(spark, f"{folder}/{name}")
    _, parent = hadoop_path(spark, folder)
    before = files.exists(parent)
    new.select("match_id", "_raw_json", "_region").write.options(**_LAYOUT).parquet(hidden.toString())
    if spark.read.schema(schema.RAW_MATCH_SCHEMA).parquet(hidden.toString()).isEmpty():
        files.delete(hidden if before else parent, True)
        return None
    if not files.rename(hidden, landed):
        raise OSError(f"cannot put the new chunks at {folder}/{name}")
    return f"{folder}/{name}"
