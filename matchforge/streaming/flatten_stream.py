"""Flatten raw chunks as they land.

Each micro-batch holds the chunks that arrived since the last run. Its rows are
deduplicated among themselves, in the order in which the records landed, and against the
keys that other batches have written, so no key state grows in the stream. A batch writes
a folder of its own, named by the stream and the number of the batch, and replaces it when
it is run again: rows are written exactly once, also after an attempt that broke off.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchforge import schema
from matchforge.operators.flatten import flatten_first, flatten_matches
from matchforge.session import COMPACT, staged_run
from matchforge.sources.raw import FILE_ORDER, read_parquet_if_present, with_file_order

# Partition column of the fact: the stream and the number of the batch that wrote a row.
BATCH = "batch"


def append_new_participants(
    batch: DataFrame, fact_dir: str, field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    *, types: Mapping[str, str] = MappingProxyType({}), name: str = "0",
) -> None:
    """Flatten one batch of raw records and write the rows that no other batch has, as batch ``name``.

    Of copies the record that landed first counts; without file and row columns, the smallest text.
    """
    if batch.isEmpty():
        return
    paths = {path: column for column, path in field_map.items()}
    keys = [paths["__match_id__"], paths["puuid"]]
    with staged_run(batch.sparkSession):
        landed, known = read_parquet_if_present(batch.sparkSession, fact_dir), None
        if landed is not None:
            # each pair is in one batch only
            known = landed.filter(F.col(BATCH).cast("string") != name).select(*[F.col(k).cast("string").alias(k) for k in keys])
        if all(c in batch.columns for c in FILE_ORDER):
            rows = flatten_first(batch, field_map, types=types, first_by=FILE_ORDER, known=known)
        else:
            rows = flatten_matches(batch, field_map, types=types, first_by=["_raw_json"])
            if known is not None:
                same = [rows[k].eqNullSafe(known[k]) for k in keys]
                rows = rows.join(known, same, "left_anti")
        rows.write.mode("overwrite").options(**COMPACT).parquet(f"{fact_dir}/{BATCH}={name}")


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The id Spark gave the stream of a checkpoint; a new checkpoint is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint_dir}/metadata").first()[0])["id"]


def flatten_landed_chunks(
    spark: SparkSession,
    raw_dir: str,
    fact_dir: str,
    checkpoint_dir: str,
    field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    *,
    types: Mapping[str, str] = MappingProxyType({}),
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process everything landed so far and stop; the next call goes on from there."""
    chunks = (
        spark.readStream.schema(schema.RAW_MATCH_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{raw_dir}/matches")
    )

    def write(batch: DataFrame, number: int) -> None:
        name = f"{stream_id(batch.sparkSession, checkpoint_dir)}-{number:08d}"
        append_new_participants(batch, fact_dir, field_map, types=types, name=name)

    return (
        with_file_order(chunks).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
