"""Most recent matches of each player."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_queue(participants: DataFrame, queue_id: int | None) -> DataFrame:
    """Participants of matches of a queue; a match that names none counts as asked for by queue."""
    if queue_id is None:
        return participants
    return participants.filter(F.col("queue_id").isNull() | (F.col("queue_id") == queue_id))


def recent_matches(participants: DataFrame, count: int, queue_id: int | None = None) -> DataFrame:
    """The ``count`` latest matches per player, newest first as ``recency`` 1, of one queue if named.

    Players without an id have no match list. The row-number filter is applied
    per input partition before the shuffle by player, so a player with a large
    share of all rows sends at most ``count`` rows per partition.
    """
    newest = Window.partitionBy("puuid").orderBy(F.col("game_date").desc_nulls_last(), "match_id")
    return (
        in_queue(participants, queue_id)
        .filter(F.col("puuid").isNotNull())
        .groupBy("puuid", "match_id")
        .agg(F.max("game_date").alias("game_date"))
        .withColumn("recency", F.row_number().over(newest))
        .filter(F.col("recency") <= count)
    )
