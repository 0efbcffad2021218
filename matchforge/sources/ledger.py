"""The ledger of landed matches: which records hold a match, found without scanning the chunks.

A row is a landed record: its key, its file and its row there. Every append adds a run that is
sorted by key over small row groups with Bloom filters on the key. A lookup of a few
keys is pushed to the Parquet reader as equalities, so row groups whose range or Bloom filter
excludes all of them are never read, and of the chunks only the files that hold a hit are
opened and in those the row groups whose Bloom filter allows one. Many keys are joined instead.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators.flatten import keep_first
from matchforge.operators.incremental import landed_keys
from matchforge.session import sought_by, stage
from matchforge.sources.raw import FILE_ORDER, read_parquet_if_present
from matchforge.sources.tables import replace_dataset

KEY = "match_id"
LEDGER_SCHEMA = f"{KEY} STRING, source_file STRING, source_row BIGINT"
# Keys up to this number are sought by equalities, more of them by a join.
LISTED_KEYS = 256
_LAYOUT = {**sought_by(KEY, rows=50_000, block=1 << 20), "parquet.page.row.count.limit": "2000"}


def equals_any(column: Column, values: list) -> Column:
    """``column`` equals one of the values, as a balanced tree of equalities behind an ``IN``.

    A long ``IN`` reaches the Parquet reader as its least and largest value only, so the
    reader gets the equalities; the rows it lets through are tried by the ``IN``, one lookup each.
    """
    if not values:
        return F.lit(False)
    terms = [column == value for value in values]
    while len(terms) > 1:
        terms = [reduce(Column.__or__, terms[i:i + 2]) for i in range(0, len(terms), 2)]
    return column.isin(values) & terms[0]


class Ledger:
    """The key table in a folder of its own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame | None:
        return read_parquet_if_present(self.spark, self.path, LEDGER_SCHEMA, recursiveFileLookup="true")

    def grow(self, raw: DataFrame) -> None:
        """Add the records of an append (``match_id`` and where they lie) as a further run."""
        self._sorted(raw).write.options(**_LAYOUT).parquet(f"{self.path}/run_{time.time_ns():020d}")

    @staticmethod
    def _sorted(raw: DataFrame) -> DataFrame:
        keyed = raw.filter(F.col(KEY).isNotNull()).select(KEY, *FILE_ORDER)
        return keyed.repartitionByRange(KEY).sortWithinPartitions(KEY, *FILE_ORDER)

    def compact(self) -> None:
        """Merge all runs into one, which leaves a key in one range of rows."""
        merged = stage(self._sorted(self.rows()), "ledger")
        replace_dataset(merged.sortWithinPartitions(KEY, *FILE_ORDER), self.path, _LAYOUT)

    def locate(self, wanted: DataFrame) -> DataFrame:
        """The landed records of the wanted keys."""
        rows = self.rows()
        if rows is None:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        keys = landed_keys(wanted, KEY)
        few = [r[0] for r in keys.limit(LISTED_KEYS + 1).collect()]
        return rows.filter(equals_any(F.col(KEY), few)) if len(few) <= LISTED_KEYS else rows.join(keys, KEY, "left_semi")

    def new_matches(self, fetched: DataFrame, first_by: tuple[str, ...] = ()) -> DataFrame:
        """Fetched rows whose key has not landed, one per key; rows without a key are never new."""
        fetched = fetched.filter(F.col(KEY).isNotNull())
        single = keep_first(fetched, [KEY], first_by) if first_by else fetched.dropDuplicates([KEY])
        return single.join(self.locate(single).select(KEY), KEY, "left_anti")

    def first_records(self, raw: DataFrame, wanted: DataFrame) -> DataFrame:
        """The raw record that landed first for each wanted key; ``raw`` is the landed chunks.

        Only files with such a record are read: their paths, one per key at most, are a filter
        that Spark applies when it lists the files. The keys that were found are sought in them as in the ledger.
        """
        first = stage(keep_first(self.locate(wanted), [KEY], FILE_ORDER), "located")
        held = first.select("source_file").distinct()
        files = [r[0] for r in held.limit(LISTED_KEYS + 1).collect()]
        if len(files) <= LISTED_KEYS:
            raw = raw.filter(F.col("source_file").isin(files)) if files else raw.limit(0)
        found = [r[0] for r in first.select(KEY).limit(LISTED_KEYS + 1).collect()]
        if len(found) <= LISTED_KEYS:
            raw = raw.filter(equals_any(F.col(KEY), found))
        return raw.join(first.select(*FILE_ORDER), list(FILE_ORDER), "left_semi")
