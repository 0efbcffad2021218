"""Growing a set of players along shared matches, level by level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.operators.recent import in_queue, recent_matches
from matchforge.session import bucketed, stage


def recent_edges(edges: DataFrame, count: int) -> DataFrame:
    """Player to match, the ``count`` latest known matches of each."""
    return recent_matches(edges, count).select("puuid", "match_id").filter(F.col("match_id").isNotNull())


def match_edges(edges: DataFrame) -> DataFrame:
    """Match to player, once each, where both are known."""
    known = F.col("match_id").isNotNull() & F.col("puuid").isNotNull() & (F.col("puuid") != "")
    return edges.filter(known).select("match_id", "puuid").distinct()


def next_level(frontier: DataFrame, recent: DataFrame, met: DataFrame) -> DataFrame:
    """Everyone in a recent match of a player of the frontier."""
    visited = recent.join(frontier, "puuid", "left_semi").select("match_id").distinct()
    return met.join(visited, "match_id", "left_semi").select("puuid").distinct()


def expand_players(
    seed: DataFrame,
    participants: DataFrame,
    profiles: DataFrame,
    *,
    depth: int,
    matches_per_player: int,
    queue: str,
    region: str,
    queue_id: int | None = None,
) -> DataFrame:
    """Seed players plus everyone met within ``depth - 1`` steps.

    A step goes from a player to the other participants of that player's most
    recent matches, those of ``queue_id`` if one is given. ``participants`` holds
    (match_id, puuid, game_date), and queue_id where a queue is asked for;
    ``profiles`` holds (puuid, gameName, tagLine). A player without a profile
    is left out of the result but counts as met. The search stops early when a
    step meets nobody new.

    The fact is read once, into two tables bucketed by what they are joined on: the recent
    matches by player, and the players by match. A level joins the frontier with
    the first and the matches found with the second, so only frontiers are ever
    shuffled or broadcast, never the edges. Each level is written as well: its lineage is
    a set of files, and the sizes let Spark choose between the two.
    """
    if depth <= 1:
        return seed

    edges = stage(in_queue(participants, queue_id).select("match_id", "puuid", "game_date"), "edges")
    known = stage(seed.select("puuid").filter(F.col("puuid").isNotNull()).distinct(), "known")
    levels = []
    with (
        bucketed(recent_edges(edges, matches_per_player), "recent", "puuid") as recent,
        bucketed(match_edges(edges), "met", "match_id") as met,
    ):
        frontier = known
        for level in range(2, depth + 1):
            frontier = stage(next_level(frontier, recent, met).join(known, "puuid", "left_anti"), f"level{level}")
            if frontier.isEmpty():
                break
            levels.append(frontier)
            known = known.unionByName(frontier)

    seed = seed.dropDuplicates(["puuid"])
    if not levels:
        return seed
    reached = reduce(DataFrame.unionByName, levels)
    rows = (
        profiles.join(reached, "puuid", "left_semi")
        .dropDuplicates(["puuid"])
        .select(
            "puuid",
            F.coalesce("gameName", F.lit("")).alias("riotIdGameName"),
            F.coalesce("tagLine", F.lit("")).alias("riotIdTagline"),
            F.coalesce("gameName", F.lit("")).alias("summonerName"),
            F.lit("GRAPH").alias("_tier"),
            F.lit(queue).alias("_queue"),
            F.lit(region).alias("_region"),
            F.lit("expanded").alias("_graph_level"),
        )
    )
    return seed.unionByName(rows, allowMissingColumns=True)
