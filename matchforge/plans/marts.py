"""The six summary marts.

Each function accepts the participant fact and, optionally, ``cells``: totals by
player, champion and position taken once with ``mart_cells``. The four marts that
group by those columns can all be merged from the cells, which are far smaller
than the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.plans.measures import (
    average, kda, mean, merge, merged_totals, totals, winrate_pct,
)
from matchforge.functions.numeric import round_to

PLAYER = ("puuid", "summoner_name")
CELL = (*PLAYER, "champion_name", "team_position")

PLAYER_QUANTITIES = ("win", "kills", "deaths", "assists", "takedowns", "gold", "damage", "vision", "cs")
PLAYER_CHAMPION_QUANTITIES = ("win", "kills", "deaths", "assists", "takedowns", "damage", "vision")
CHAMPION_QUANTITIES = ("win", "kills", "deaths", "assists", "takedowns", "damage", "gold", "vision")
POSITION_QUANTITIES = ("win", "kills", "deaths", "assists", "damage", "gold", "vision", "cs")
DAY_QUANTITIES = ("win", "kills", "deaths", "damage", "duration")


def mart_cells(fact: DataFrame) -> DataFrame:
    """Totals by player, champion and position, the shared grain of four marts."""
    return totals(fact, CELL, PLAYER_QUANTITIES)


def _grouped(
    fact: DataFrame | None, cells: DataFrame | None, keep: Column, keys: Sequence[str], quantities: Sequence[str]
) -> DataFrame:
    if cells is not None:
        return merge(cells.filter(keep), keys, quantities)
    return totals(fact.filter(keep), keys, quantities)


def player_stats(
    fact: DataFrame | None, cells: DataFrame | None = None, games: DataFrame | None = None, *, min_games: int = 3
) -> DataFrame:
    """Per player: distinct matches, averages, win rate, favourite champion and position.

    With ``cells`` and ``games`` (``games_played`` by player) the fact is not read at all.

    Three row sets, each with one row per player, are stacked and merged by one last
    grouping: totals, distinct matches, and the favourites from one vote count per
    champion and position. A player with a large share of all rows is thus split by
    match and by champion first, and grouping keeps null names together without joins.
    Favourites are text, which Spark groups by sorting, so only the narrow votes are.
    The favourite is the most frequent value, the smallest one on a tie.
    """
    known = F.col("puuid").isNotNull()
    matches = games if games is not None else (
        fact.filter(known & F.col("match_id").isNotNull())
        .select(*PLAYER, "match_id")
        .distinct()
        .groupBy(*PLAYER)
        .agg(F.count(F.lit(1)).alias("games_played"))
    )
    ballots = F.array(
        F.struct(F.lit("champion").alias("kind"), F.col("champion_name").alias("choice")),
        F.struct(F.lit("position").alias("kind"), F.col("team_position").alias("choice")),
    )
    if cells is not None:
        votes = cells.filter(known).select(*CELL, F.col("rows").alias("votes"))
        profile = merge(cells.filter(known), PLAYER, PLAYER_QUANTITIES)
    else:
        votes = fact.filter(known).groupBy(*CELL).agg(F.count(F.lit(1)).alias("votes"))
        profile = totals(fact.filter(known), PLAYER, PLAYER_QUANTITIES)
    votes = (
        votes.select(*PLAYER, "votes", F.explode(ballots).alias("ballot"))
        .select(*PLAYER, "votes", "ballot.kind", "ballot.choice")
        .filter(F.col("choice").isNotNull())
        .groupBy(*PLAYER, "kind", "choice")
        .agg(F.sum("votes").alias("votes"))
    )

    def favourite(kind: str) -> Column:
        ours = F.col("kind") == kind
        return F.min_by(F.when(ours, F.col("choice")), F.when(ours, F.struct(-F.col("votes"), F.col("choice"))))

    favourites = votes.groupBy(*PLAYER).agg(
        favourite("champion").alias("most_played_champion"), favourite("position").alias("main_position"))
    return (
        profile.unionByName(matches, allowMissingColumns=True)
        .unionByName(favourites, allowMissingColumns=True)
        .groupBy(*PLAYER)
        .agg(
            F.coalesce(F.sum("games_played"), F.lit(0)).alias("games_played"),
            F.max("most_played_champion").alias("most_played_champion"),
            F.max("main_position").alias("main_position"),
            *merged_totals(PLAYER_QUANTITIES),
        )
        .filter(F.col("games_played") >= min_games)
        .select(
            *PLAYER, "games_played",
            average("kills", 2).alias("avg_kills"),
            average("deaths", 2).alias("avg_deaths"),
            average("assists", 2).alias("avg_assists"),
            kda().alias("avg_kda"),
            winrate_pct().alias("winrate_pct"),
            average("gold", 0).alias("avg_gold"),
            average("damage", 0).alias("avg_damage"),
            average("vision", 1).alias("avg_vision"),
            average("cs", 1).alias("avg_cs"),
            "most_played_champion", "main_position",
        )
    )


def player_champion_stats(fact: DataFrame | None, cells: DataFrame | None = None, *, min_games: int = 2) -> DataFrame:
    """Per player, champion and position."""
    keep = F.col("puuid").isNotNull() & F.col("champion_name").isNotNull()
    return (
        _grouped(fact, cells, keep, CELL, PLAYER_CHAMPION_QUANTITIES)
        .filter(F.col("rows") >= min_games)
        .select(
            *CELL, F.col("rows").alias("games_played"),
            winrate_pct().alias("winrate_pct"),
            average("kills", 2).alias("avg_kills"),
            average("deaths", 2).alias("avg_deaths"),
            average("assists", 2).alias("avg_assists"),
            kda().alias("avg_kda"),
            average("damage", 0).alias("avg_damage"),
            average("vision", 1).alias("avg_vision"),
        )
    )


def champion_stats(fact: DataFrame | None, cells: DataFrame | None = None, *, min_picks: int = 5) -> DataFrame:
    """Per champion and position."""
    keys = ("champion_name", "team_position")
    return (
        _grouped(fact, cells, F.col("champion_name").isNotNull(), keys, CHAMPION_QUANTITIES)
        .filter(F.col("rows") >= min_picks)
        .select(
            *keys, F.col("rows").alias("picks"),
            winrate_pct().alias("winrate_pct"),
            average("kills", 2).alias("avg_kills"),
            average("deaths", 2).alias("avg_deaths"),
            average("assists", 2).alias("avg_assists"),
            kda().alias("avg_kda"),
            average("damage", 0).alias("avg_damage"),
            average("gold", 0).alias("avg_gold"),
            average("vision", 1).alias("avg_vision"),
        )
    )


def position_stats(fact: DataFrame | None, cells: DataFrame | None = None) -> DataFrame:
    """Per position; unknown and empty positions are left out."""
    keep = F.col("team_position").isNotNull() & (F.col("team_position") != "")
    return _grouped(fact, cells, keep, ["team_position"], POSITION_QUANTITIES).select(
        "team_position", F.col("rows").alias("total_games"),
        winrate_pct().alias("winrate_pct"),
        average("kills", 2).alias("avg_kills"),
        average("deaths", 2).alias("avg_deaths"),
        average("assists", 2).alias("avg_assists"),
        average("damage", 0).alias("avg_damage"),
        average("gold", 0).alias("avg_gold"),
        average("vision", 1).alias("avg_vision"),
        average("cs", 1).alias("avg_cs"),
    )


def match_timeline(fact: DataFrame) -> DataFrame:
    """Per calendar day: distinct matches and averages.

    The matches are told apart by a grouping of their own: beside the totals, each pair of day
    and match would carry all of these through the shuffle and the memory of its task.
    """
    dated = fact.filter(F.col("game_date").isNotNull()).withColumn("game_day", F.col("game_date").cast("date"))
    matches = (
        dated.filter(F.col("match_id").isNotNull()).select("game_day", "match_id").distinct()
        .groupBy("game_day").agg(F.count(F.lit(1)).alias("total_matches"))
    )
    return timeline_of(totals(dated, ["game_day"], DAY_QUANTITIES).join(matches, "game_day", "left"))


def timeline_of(days: DataFrame) -> DataFrame:
    """The timeline from totals by day; a day without a known match has 0 of them."""
    return days.select(
        "game_day", F.coalesce("total_matches", F.lit(0)).alias("total_matches"),
        winrate_pct().alias("overall_winrate"),
        average("kills", 2).alias("avg_kills"),
        average("deaths", 2).alias("avg_deaths"),
        average("damage", 0).alias("avg_damage"),
        round_to(mean("duration") / F.lit(60.0), 1).alias("avg_duration_min"),
    )


def purchases(fact: DataFrame, *keep: str) -> DataFrame:
    """One row per filled item slot that counts, with the buyer's result."""
    slots = F.array(*[F.col(slot).cast("bigint") for slot in schema.PURCHASE_SLOTS])
    return (
        fact.select("win", *keep, F.explode(slots).alias("slot_item"))
        .filter(F.col("slot_item").isNotNull() & (F.col("slot_item") != 0))
    )


def item_popularity(fact: DataFrame, items: DataFrame, *, min_purchases: int = 10) -> DataFrame:
    """Per item: purchases over the counted slots and the win rate of the buyers.

    Purchases are counted per item id before the dimension is joined, so the
    join sees one row per id. Ids the dimension lacks end up in one group with
    a null item.
    """
    return popularity_of(totals(purchases(fact), ["slot_item"], ["win"]), items, min_purchases=min_purchases)


def popularity_of(per_id: DataFrame, items: DataFrame, *, min_purchases: int = 10) -> DataFrame:
    """The item mart from purchases counted by item id."""
    item = ("item_id", "item_name", "gold_total", "tags")
    joined = per_id.join(
        items.select(*item), per_id["slot_item"].cast("string") == F.col("item_id"), "left"
    )
    return (
        merge(joined, item, ["win"])
        .filter(F.col("rows") >= min_purchases)
        .select(
            "item_id", "item_name", F.col("item_id").alias("item_id_num"),
            F.col("rows").alias("total_purchases"),
            winrate_pct().alias("winrate_pct"),
            "gold_total", "tags",
        )
    )
