"""Reports over the player marts, for every player at once.

Population values (means, deviations, maxima) enter as scalar subqueries, top
lists as ordered limits, and per-player work as grouping by player, so nothing
sorts or gathers all players in one task. Pass stored marts: most reports read
their input more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge.functions.numeric import is_true, order_free_sum, ratio, round_to, z_score
from matchforge.functions.ranking import By, Rank, percent_rank_of_mean, with_ranks
from matchforge.plans.champions import CLOSE_CALL, favour


# --- outliers -----------------------------------------------------------------

def outlier_scores(players: DataFrame) -> DataFrame:
    """Z-scores of KDA and win rate and their gap; fewer than four players give none."""
    stats = players.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("avg_kda").alias("kda_mean"),
            F.stddev_samp("avg_kda").alias("kda_std"),
            F.avg("winrate_pct").alias("wr_mean"),
            F.stddev_samp("winrate_pct").alias("wr_std"),
        )
    ).scalar()
    return (
        players.filter(stats["n"] >= 4)
        .withColumn("kda_z", z_score(F.col("avg_kda"), stats["kda_mean"], stats["kda_std"]))
        .withColumn("wr_z", z_score(F.col("winrate_pct"), stats["wr_mean"], stats["wr_std"]))
        .withColumn("gap", F.col("kda_z") - F.col("wr_z"))
    )


def _top(scored: DataFrame, group: str, order: Column, size: int) -> DataFrame:
    """The first ``size`` rows under ``order`` as a numbered group."""
    ordering = [order, F.col("summoner_name"), F.col("puuid")]
    return (
        scored.orderBy(*ordering)
        .limit(size)
        .withColumn("place", F.row_number().over(Window.orderBy(*ordering)))
        .select(
            F.lit(group).alias("outlier_group"), "place", "puuid", "summoner_name",
            "winrate_pct", "avg_kda", "kda_z", "wr_z", "gap",
        )
    )


def player_outliers(players: DataFrame) -> DataFrame:
    """Three groups: strong in both scores, KDA far ahead of wins, wins far ahead of KDA."""
    scored = outlier_scores(players)
    strong = is_true((F.col("kda_z") > 0.5) & (F.col("wr_z") > 0.5))
    return (
        _top(scored.filter(strong), "carries", F.col("wr_z").desc_nulls_last(), 5)
        .unionByName(_top(scored, "padders", F.col("gap").desc_nulls_last(), 3))
        .unionByName(_top(scored, "underrated", F.col("gap").asc_nulls_last(), 3))
    )


def outlier_cards(outliers: DataFrame) -> DataFrame:
    """The outliers worth showing: the first three per group, gaps large enough."""
    group, gap = F.col("outlier_group"), F.col("gap")
    shown = (
        (group == "carries")
        | ((group == "padders") & (gap > 0.3))
        | ((group == "underrated") & (gap < -0.3))
    )
    return outliers.filter((F.col("place") <= 3) & shown)


def rank_gap(players: DataFrame) -> DataFrame:
    """Average ranks by KDA and win rate, and how far wins trail behind KDA."""
    ranked = with_ranks(players, {
        "kda_rank": Rank([By("avg_kda")], average=True),
        "wr_rank": Rank([By("winrate_pct")], average=True),
    })
    for value, rank in (("avg_kda", "kda_rank"), ("winrate_pct", "wr_rank")):
        ranked = ranked.withColumn(rank, F.when(F.col(value).isNotNull(), F.col(rank)))
    return ranked.withColumn("gap", F.col("wr_rank") - F.col("kda_rank"))


# --- champion pools -------------------------------------------------------------

def top_champions(player_champions: DataFrame, *, top_n: int = 5) -> DataFrame:
    """Each player's most played champions, numbered, with their share of those games."""
    key = "puuid" if "puuid" in player_champions.columns else "summoner_name"
    most_played = Window.partitionBy(key).orderBy(
        F.col("games_played").desc(), "champion_name", F.col("team_position").asc_nulls_first()
    )
    mine = Window.partitionBy(key)
    return (
        player_champions.filter(F.col(key).isNotNull())
        .withColumn("place", F.row_number().over(most_played))
        .filter(F.col("place") <= top_n)
        .withColumn(
            "share_pct",
            ratio(F.col("games_played"), F.sum("games_played").over(mine)) * F.lit(100),
        )
    )


def champion_pools(player_champions: DataFrame, *, top_n: int = 5) -> DataFrame:
    """``top_champions`` as listed per player, with the class of each champion's win rate."""
    top = top_champions(player_champions, top_n=top_n)
    return top.withColumn("favour", favour(F.col("winrate_pct"), *CLOSE_CALL))


def player_styles(top: DataFrame) -> DataFrame:
    """Play style and pool breadth of each player from ``top_champions``.

    Averages are weighted by games; decimals keep them independent of row order.
    """
    key = "puuid" if "puuid" in top.columns else "summoner_name"
    games = F.col("games_played")

    def weighted(column: str) -> Column:
        return ratio(order_free_sum(F.col(column) * games), F.sum(games))

    damage, vision, kda = F.col("damage"), F.col("vision"), F.col("kda")
    share = F.col("top1")
    return (
        top.groupBy(key)
        .agg(
            weighted("avg_damage").alias("damage"),
            weighted("avg_vision").alias("vision"),
            weighted("avg_kda").alias("kda"),
            ratio(F.max(games), F.sum(games)).alias("top1"),
            F.sum(games).alias("games"),
        )
        .select(
            key,
            F.when(F.col("games") == 0, "unknown")
            .when((damage > 20000) & (kda < 3.2), "aggressive")
            .when(vision > 45, "support")
            .when(kda > 4.0, "careful")
            .otherwise("universal").alias("style"),
            F.when(share > 0.6, "one_trick").when(share > 0.4, "narrow").otherwise("flexible").alias("pool_type"),
            round_to(share * F.lit(100), 0).alias("top1_share"),
            round_to(damage, 0).alias("avg_damage"),
            round_to(vision, 1).alias("avg_vision"),
            round_to(kda, 2).alias("avg_kda"),
        )
    )


# --- recommendations --------------------------------------------------------------

def _shortlists(champions: DataFrame, size: int, min_picks: int) -> DataFrame:
    """Best candidates per position and style, in order.

    A style is a triple of flags; a candidate's score depends on nothing else of
    the player, so eight lists per position serve all players.
    """
    share = {
        c: percent_rank_of_mean(F.col(c), ["team_position"])
        for c in ("avg_damage", "avg_vision", "avg_kda", "picks")
    }
    flags = (F.lit(False), F.lit(True))
    styles = F.array(*[
        F.struct(a.alias("aggressive"), s.alias("supportive"), c.alias("safe"))
        for a in flags for s in flags for c in flags
    ])
    ranked = (
        champions.filter(F.col("team_position").isNotNull())
        .withColumns({f"{c}_share": value for c, value in share.items()})
        .withColumn("style", F.explode(styles))
    )

    def bonus(flag: str, column: str) -> Column:
        return F.when(F.col(f"style.{flag}"), F.col(f"{column}_share") * F.lit(40)).otherwise(F.lit(0.0))

    styled = F.col("style.aggressive") | F.col("style.supportive") | F.col("style.safe")
    score = (
        bonus("aggressive", "avg_damage")
        + bonus("supportive", "avg_vision")
        + bonus("safe", "avg_kda")
        + F.when(styled, F.lit(0.0)).otherwise(F.lit(20.0))
        + (F.col("winrate_pct") - F.lit(50)) * F.lit(1.5)
        + F.col("picks_share") * F.lit(10)
    )
    best = Window.partitionBy("team_position", "style").orderBy(
        F.col("fit_score").desc_nulls_last(), "champion_name"
    )
    return (
        ranked.withColumn("fit_score", score)
        .filter(F.col("picks") >= min_picks)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= size)
        .groupBy(F.col("team_position").alias("position"), "style")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("place", "champion_name", "winrate_pct", "picks", "avg_kda", "fit_score")
                )
            ).alias("shortlist")
        )
    )


def recommend_champions(
    players: DataFrame, champions: DataFrame, *, top_n: int = 5, min_picks: int = 10
) -> DataFrame:
    """``top_n`` champions per player that fit the position and style, bar the favourite one.

    Only a player's own favourite is excluded, so the best ``top_n + 1`` of a
    shortlist always hold the answer. Medians and shortlists are one value per
    position (and style): they enter as maps, and players are joined with nothing.
    """
    shortlists = _shortlists(champions, top_n + 1, min_picks).agg(
        F.map_from_entries(F.collect_list(F.struct(F.struct("position", "style"), "shortlist")))
    ).scalar()
    middles = (
        champions.filter(F.col("team_position").isNotNull())
        .groupBy("team_position")
        .agg(F.struct(F.median("avg_damage").alias("damage"), F.median("avg_vision").alias("vision")).alias("middle"))
        .agg(F.map_from_entries(F.collect_list(F.struct("team_position", "middle"))))
        .scalar()
    )
    kda, middle = F.col("avg_kda"), F.col("middle")
    style = F.struct(
        is_true((kda < 2.5) & (F.col("avg_damage") > middle["damage"])).alias("aggressive"),
        is_true(F.col("avg_vision") > middle["vision"] * F.lit(1.3)).alias("supportive"),
        is_true(kda > 4.0).alias("safe"),
    )
    styled = (
        players.select(
            "puuid", "summoner_name", "main_position", "most_played_champion",
            "avg_kda", "avg_vision", "avg_damage",
        )
        .withColumn("middle", F.try_element_at(middles, F.col("main_position")))
        .withColumn("player_style", style)
        .withColumn(
            "shortlist",
            F.try_element_at(
                shortlists, F.struct(F.col("main_position").alias("position"), F.col("player_style").alias("style"))
            ),
        )
        .filter(F.col("shortlist").isNotNull())
    )
    played = F.coalesce(F.col("most_played_champion"), F.lit(""))
    others = F.filter("shortlist", lambda c: c["champion_name"] != played)
    label = (
        F.when(F.col("player_style.aggressive"), "aggressive")
        .when(F.col("player_style.supportive"), "supportive")
        .when(F.col("player_style.safe"), "safe")
        .otherwise("balanced")
    )
    return (
        styled.select(
            "puuid", "summoner_name", "main_position", label.alias("style_label"),
            F.posexplode(F.slice(others, 1, top_n)).alias("at", "pick"),
        )
        .select(
            "puuid", "summoner_name", "main_position", "style_label",
            (F.col("at") + 1).alias("place"),
            "pick.champion_name", "pick.winrate_pct", "pick.picks", "pick.avg_kda", "pick.fit_score",
        )
    )


# --- listings -----------------------------------------------------------------------

def player_flags(players: DataFrame) -> DataFrame:
    """Good-or-not flags of a player's four headline measures, and the win-rate class."""
    # Measure -> value from which it counts as good.
    good_from = {"avg_kda": 3.0, "winrate_pct": 50.0, "avg_vision": 40.0, "avg_cs": 160.0}
    return players.select(
        "puuid", "summoner_name", *good_from,
        *[
            is_true(F.col(c) >= limit).alias(f"{c}_good") for c, limit in good_from.items()
        ],
        favour(F.col("winrate_pct")).alias("favour"),
    )


def marker_sizes(players: DataFrame) -> DataFrame:
    """Players placed by KDA and win rate, sized by their games relative to the most."""
    most = players.agg(F.max("games_played")).scalar()
    return players.select(
        "puuid", "summoner_name", "avg_kda", "winrate_pct", "games_played",
        favour(F.col("winrate_pct")).alias("favour"),
        round_to(F.col("games_played") / most * F.lit(30) + F.lit(8), 1).alias("marker_size"),
    )


def player_table(players: DataFrame) -> DataFrame:
    """The player columns of the full listing, best win rate first."""
    return players.select(
        "summoner_name", "main_position", "most_played_champion", "games_played",
        "winrate_pct", "avg_kda", "avg_damage", "avg_cs",
    ).orderBy(F.col("winrate_pct").desc(), "summoner_name")


def one_player(rows: DataFrame, *, puuid: str | None = None, summoner_name: str | None = None) -> DataFrame:
    """Rows of one player, by id if the table has ids and one is given, else by name."""
    if puuid is not None and "puuid" in rows.columns:
        return rows.filter(F.col("puuid") == puuid)
    return rows.filter(F.col("summoner_name") == summoner_name)
