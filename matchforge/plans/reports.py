"""Short reports that draw on several marts: a few rows each, stacked by priority."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.functions.numeric import min_max, z_score
from matchforge.plans.champions import meta_tiers, winrate_anomalies
from matchforge.plans.players import outlier_scores, rank_gap
from matchforge.plans.timeline import period_delta

# The metrics drawn on the radar.
RADAR_METRICS = ("winrate_pct", "avg_kills", "avg_damage", "avg_gold", "avg_vision")


def _first(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(1)


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _action(row: DataFrame, priority: int, kind: str, **values: Column) -> DataFrame:
    """One action row; measures that do not apply are null."""
    types = {
        "subject": "string", "position": "string", "winrate_pct": "double", "picks": "bigint",
        "gap": "double", "contrast": "string", "contrast_winrate_pct": "double",
    }
    columns = [values.get(name, F.lit(None)).cast(t).alias(name) for name, t in types.items()]
    return row.select(F.lit(priority).alias("priority"), F.lit(kind).alias("kind"), *columns)


def action_plan(champions: DataFrame, players: DataFrame, positions: DataFrame) -> DataFrame:
    """Up to five ranked findings to act on."""
    wr = F.col("winrate_pct")
    name = (F.col("champion_name"), F.col("team_position"))

    ban = _first(meta_tiers(champions).filter(F.col("tier") == "S"), F.col("picks").desc(), *name)
    weak = winrate_anomalies(champions).filter(F.col("direction") == "underperforming")
    avoid = _first(weak, F.col("z_score").asc(), *name)

    rated = positions.filter(wr.isNotNull())
    worst = _first(rated, wr.asc(), F.col("team_position").desc()).select(
        F.struct("team_position", "winrate_pct")
    ).scalar()
    best = _first(rated, wr.desc(), F.col("team_position")).select(
        "team_position", "winrate_pct",
        worst["team_position"].alias("worst_position"), worst["winrate_pct"].alias("worst_wr"),
    ).filter(wr - F.col("worst_wr") > 3)

    scored = outlier_scores(players).filter(F.col("gap").isNotNull())
    who = (F.col("summoner_name"), F.col("puuid"))
    padder = _first(scored, F.col("gap").desc(), *who).filter(F.col("gap") > 0.8)
    hidden = _first(scored, F.col("gap").asc(), *who).filter(F.col("gap") < -0.8)

    champion = {"subject": name[0], "position": name[1], "winrate_pct": wr, "picks": F.col("picks")}
    player = {"subject": F.col("summoner_name"), "winrate_pct": wr, "gap": F.col("gap")}
    return _stack([
        _action(ban, 1, "strongest_champion", **champion),
        _action(avoid, 2, "champion_to_avoid", **champion),
        _action(
            best, 3, "position_edge", subject=F.col("team_position"), position=F.col("team_position"),
            winrate_pct=wr, contrast=F.col("worst_position"), contrast_winrate_pct=F.col("worst_wr"),
        ),
        _action(padder, 4, "stats_without_wins", **player),
        _action(hidden, 5, "wins_without_stats", **player),
    ])


def _insight(row: DataFrame, place: int, tag: str, subject: Column, detail: Column, value: Column, extra: Column) -> DataFrame:
    return row.select(
        F.lit(place).alias("place"), F.lit(tag).alias("tag"),
        subject.cast("string").alias("subject"), detail.cast("string").alias("detail"),
        value.cast("double").alias("value"), extra.cast("double").alias("extra"),
    )


def insights(champions: DataFrame, players: DataFrame, positions: DataFrame, timeline: DataFrame) -> DataFrame:
    """Up to six observations on the state of the game."""
    wr, none = F.col("winrate_pct"), F.lit(None)
    name = (F.col("champion_name"), F.col("team_position"))

    overall = players.agg(F.avg("winrate_pct").alias("mean_wr")).filter(F.col("mean_wr") > 52)
    popular = _first(champions, F.col("picks").desc(), *name)
    broken = _first(champions.filter(F.col("picks") >= 30), wr.desc_nulls_last(), *name).filter(wr >= 55)
    days = timeline.agg(F.count(F.lit(1))).scalar()
    trend = period_delta(timeline, "avg_damage").filter((days >= 14) & (F.abs("delta_pct") > 5))
    best = _first(positions, wr.desc_nulls_last(), F.col("team_position"))
    gap = rank_gap(players).filter(F.col("gap").isNotNull())
    trailing = _first(gap, F.col("gap").desc(), F.col("summoner_name"), F.col("puuid")).filter(F.col("gap") > 5)
    return _stack([
        _insight(overall, 1, "META", none, none, F.col("mean_wr"), none),
        _insight(popular, 2, "PICK TREND", *name, wr, F.col("picks")),
        _insight(broken, 3, "BROKEN", *name, wr, F.col("picks")),
        _insight(trend, 4, "DAMAGE TREND", none, F.when(F.col("delta_pct") > 0, "up").otherwise("down"),
                 F.abs("delta_pct"), none),
        _insight(best, 5, "POSITION EDGE", F.col("team_position"), none, wr, F.col("avg_damage")),
        _insight(trailing, 6, "STAT PADDING", F.col("summoner_name"), none, F.col("kda_rank"), F.col("wr_rank")),
    ])


def balance_label(overperforming: Column) -> Column:
    """How balanced a set of champions looks by the number that win strangely often."""
    return F.when(overperforming <= 1, "balanced").when(overperforming <= 3, "attention").otherwise("unbalanced")


def balance_by_position(champions: DataFrame, *, min_picks: int = 15, threshold: float = 1.5) -> DataFrame:
    """The balance label of each position, its champions compared among themselves.

    Mean and deviation come per position from a grouping of the roster and are joined back;
    fewer than three champions are not compared.
    """
    picked = champions.filter(F.col("picks") >= min_picks)
    spread = picked.groupBy("team_position").agg(
        F.count(F.lit(1)).alias("champions"), F.avg("winrate_pct").alias("mean"), F.stddev_samp("winrate_pct").alias("std"))
    both = picked.select("team_position", "winrate_pct").join(
        spread.withColumnRenamed("team_position", "position"), F.col("team_position").eqNullSafe(F.col("position")))
    strange = (F.col("champions") >= 3) & (z_score(F.col("winrate_pct"), F.col("mean"), F.col("std")) >= threshold)
    counted = both.groupBy("position").agg(F.count(F.lit(1)).alias("champions"), F.count_if(strange).alias("overperforming"))
    return counted.select(
        F.col("position").alias("team_position"), "champions", "overperforming",
        balance_label(F.col("overperforming")).alias("balance"))


def balance_health(champions: DataFrame, players: DataFrame, positions: DataFrame) -> DataFrame:
    """One row: how balanced the game looks and the headline counts."""
    tops = meta_tiers(champions).agg(F.count(F.when(F.col("tier") == "S", F.lit(1)))).scalar()
    strange = F.col("overperforming")
    actions = action_plan(champions, players, positions).agg(F.count(F.lit(1))).scalar()
    return (
        winrate_anomalies(champions)
        .agg(F.count(F.when(F.col("direction") == "overperforming", F.lit(1))).alias("overperforming"))
        .select(
            balance_label(strange).alias("balance"),
            "overperforming",
            tops.alias("s_tier_champions"),
            actions.alias("actions"),
            players.agg(F.count(F.lit(1))).scalar().alias("players"),
            champions.agg(F.count(F.lit(1))).scalar().alias("champion_rows"),
            players.agg(F.avg("winrate_pct")).scalar().alias("mean_winrate_pct"),
        )
    )


def position_radar(positions: DataFrame) -> DataFrame:
    """Each position's metrics scaled to the span over all positions."""
    span = positions.agg(
        F.struct(*[f(m).alias(f"{n}_{m}") for m in RADAR_METRICS for n, f in (("low", F.min), ("high", F.max))])
    ).scalar()
    return positions.select(
        "team_position",
        *[min_max(F.col(m), span[f"low_{m}"], span[f"high_{m}"]).alias(m) for m in RADAR_METRICS],
    )
