"""Ranked and smoothed views over the marts.

Ranks over players and items use the distributed rank; the remaining windows run
over marts whose size is bounded by the calendar or the champion roster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchforge.functions.numeric import ratio, round_to
from matchforge.functions.ranking import By, Rank, magnitude, with_ranks


def top_players(players: DataFrame, *, min_games: int = 5) -> DataFrame:
    """Players ranked by win rate and by KDA; a player without deaths ranks first by KDA."""
    regular = players.filter(F.col("games_played") >= min_games).select(
        "summoner_name", "main_position", "most_played_champion", "games_played", "winrate_pct",
        "avg_kda", "avg_damage", "avg_gold", "avg_cs", "avg_vision",
    )
    return with_ranks(regular, {
        "rank_wr": Rank([By("winrate_pct", nulls_first=True), By("games_played")]),
        "rank_kda": Rank([By("avg_kda", nulls_first=True)]),
    })


def meta_champions(champions: DataFrame) -> DataFrame:
    """Champions with a tier by fixed thresholds and their pick rank in the position."""
    wr, picks = F.col("winrate_pct"), F.col("picks")
    tier = (
        F.when((wr >= 55) & (picks >= 20), "S")
        .when((wr >= 52) | (picks >= 50), "A")
        .when(wr >= 48, "B")
        .otherwise("C")
    )
    by_picks = Window.partitionBy("team_position").orderBy(picks.desc())
    return champions.select(
        "champion_name", "team_position", "picks", "winrate_pct", "avg_kda", "avg_damage",
        tier.alias("tier"),
        F.rank().over(by_picks).cast("bigint").alias("position_rank"),
    )


def item_efficiency(items: DataFrame, *, min_purchases: int = 10) -> DataFrame:
    """Items with win-rate points above 50 per 10,000 gold, ranked two ways."""
    score = ratio(F.col("winrate_pct") - F.lit(50.0), F.col("gold_total")) * F.lit(10000)
    frequent = items.filter(F.col("total_purchases") >= min_purchases).select(
        "item_name", "total_purchases", "winrate_pct", "gold_total", "tags",
        round_to(score, 4).alias("gold_efficiency_score"),
    )
    return with_ranks(frequent, {
        "rank_wr": Rank([By("winrate_pct", nulls_first=True)]),
        "rank_pop": Rank([By("total_purchases")], bucket=magnitude),
    })


def position_overview(positions: DataFrame) -> DataFrame:
    """Positions with a KDA from the already rounded averages."""
    kda = ratio(F.col("avg_kills") + F.col("avg_assists"), F.col("avg_deaths"))
    return positions.select(
        "team_position", "total_games", "winrate_pct", "avg_kills", "avg_deaths", "avg_assists",
        round_to(kda, 2).alias("avg_kda"),
        "avg_damage", "avg_gold", "avg_vision", "avg_cs",
    )


def timeline_trends(timeline: DataFrame) -> DataFrame:
    """Days with trailing seven-row averages and the change in matches."""
    by_day = Window.orderBy("game_day")
    week = by_day.rowsBetween(-6, Window.currentRow)
    return timeline.select(
        "game_day", "total_matches", "overall_winrate", "avg_kills", "avg_damage", "avg_duration_min",
        F.avg("avg_damage").over(week).alias("damage_ma7"),
        F.avg("avg_duration_min").over(week).alias("duration_ma7"),
        (F.col("total_matches") - F.lag("total_matches").over(by_day)).alias("matches_delta"),
    )


VIEWS = {
    "vw_top_players": ("mart_player_stats", top_players),
    "vw_meta_champions": ("mart_champion_stats", meta_champions),
    "vw_item_efficiency": ("mart_item_popularity", item_efficiency),
    "vw_position_overview": ("mart_position_stats", position_overview),
    "vw_timeline_trends": ("mart_match_timeline", timeline_trends),
}
