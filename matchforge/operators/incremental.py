"""Keeping only what is new, and finding what has landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.operators.flatten import keep_first


def landed_keys(raw: DataFrame, key: str = "match_id") -> DataFrame:
    """Distinct non-null keys already landed."""
    return raw.select(key).filter(F.col(key).isNotNull()).distinct()


def new_matches(
    fetched: DataFrame, landed: DataFrame, key: str = "match_id", first_by: Sequence[str] = ()
) -> DataFrame:
    """Fetched rows whose key has not landed, one per key; a row without a key is never new.

    Copies are removed before the join: what is shuffled is one row per key and
    input partition, and the join reuses that partitioning.
    """
    fetched = fetched.filter(F.col(key).isNotNull())
    single = keep_first(fetched, [key], first_by) if first_by else fetched.dropDuplicates([key])
    return single.join(landed_keys(landed, key), key, "left_anti")


def landed_matches(
    raw: DataFrame, wanted: DataFrame, key: str = "match_id", first_by: Sequence[str] = ()
) -> DataFrame:
    """Landed rows for the wanted keys, the first one per key."""
    hits = raw.join(landed_keys(wanted, key), key, "left_semi")
    return keep_first(hits, [key], first_by) if first_by else hits.dropDuplicates([key])
