"""Reports over the champion mart, whose size is bounded by the roster and the positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.functions.numeric import z_score

# Tiers from strongest to weakest.
TIERS = ("S", "A", "B", "C", "D")
# Bounds of the win-rate class in champion pools and line-up estimates.
CLOSE_CALL = (52, 48)


def favour(winrate: Column, high: float = 55, low: float = 45) -> Column:
    """Threshold class of a win rate; the high bound counts as favourable, the low one not."""
    return (
        F.when(winrate >= high, "favourable").when(winrate <= low, "unfavourable").otherwise("neutral")
    )


def meta_tiers(champions: DataFrame) -> DataFrame:
    """Champions with a tier from win rate and from where their picks lie in the set."""
    cut = champions.agg(
        F.struct(
            F.percentile("picks", F.lit(0.50)).alias("half"),
            F.percentile("picks", F.lit(0.75)).alias("quarter"),
        )
    ).scalar()
    wr, picks = F.col("winrate_pct"), F.col("picks")
    tier = (
        F.when((wr >= 54) & (picks >= cut["quarter"]), "S")
        .when((wr >= 52) & (picks >= cut["half"]), "A")
        .when(wr >= 48, "B")
        .when(wr >= 45, "C")
        .otherwise("D")
    )
    return champions.withColumn("tier", tier)


def tier_counts(tiered: DataFrame) -> DataFrame:
    """Champions per tier, tiers without any counted as 0; one pass, one row out."""
    per_tier = [
        F.struct(
            F.lit(t).alias("tier"),
            F.count(F.when(F.col("tier") == t, F.lit(1))).alias("champions"),
        )
        for t in TIERS
    ]
    return tiered.agg(F.array(*per_tier).alias("t")).select(F.explode("t").alias("t")).select("t.*")


def tier_list(tiered: DataFrame, *, position: str | None = None, min_picks: int = 10) -> DataFrame:
    """Champions picked often enough, of one position or all."""
    listed = tiered.filter(F.col("picks") >= min_picks)
    return listed.filter(F.col("team_position") == position) if position else listed


def strongest(tiered: DataFrame, *, position: str | None = None, min_picks: int = 10) -> DataFrame:
    """The two top tiers, best tier and win rate first."""
    return (
        tier_list(tiered, position=position, min_picks=min_picks)
        .filter(F.col("tier").isin("S", "A"))
        .select("champion_name", "team_position", "tier", "winrate_pct", "picks")
        .orderBy(
            F.when(F.col("tier") == "S", 0).otherwise(1),
            F.col("winrate_pct").desc(), "champion_name", "team_position",
        )
    )


def winrate_anomalies(champions: DataFrame, *, min_picks: int = 15, threshold: float = 1.5) -> DataFrame:
    """Champions whose win rate lies ``threshold`` deviations off; fewer than three give none."""
    usual = champions.filter(F.col("picks") >= min_picks)
    stats = usual.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("winrate_pct").alias("mean"),
            F.stddev_samp("winrate_pct").alias("std"),
        )
    ).scalar()
    z = F.col("z_score")
    return (
        usual.withColumn("z_score", z_score(F.col("winrate_pct"), stats["mean"], stats["std"]))
        .filter((stats["n"] >= 3) & (F.abs(z) >= threshold))
        .withColumn("direction", F.when(z > 0, "overperforming").otherwise("underperforming"))
    )


def pick_quadrants(tiered: DataFrame, *, min_picks: int = 8) -> DataFrame:
    """Champions split at the median of picks and at a 50 % win rate."""
    shown = tiered.filter(F.col("picks") >= min_picks)
    median = shown.agg(F.median("picks")).scalar()
    often = F.when(F.col("picks") >= median, "often").otherwise("seldom")
    wins = F.when(F.col("winrate_pct") >= 50, "winning").otherwise("losing")
    return shown.select(
        "champion_name", "team_position", "picks", "winrate_pct", "tier",
        median.alias("median_picks"), F.concat_ws("_", often, wins).alias("quadrant"),
    )


def champion_bars(
    champions: DataFrame, *, position: str | None = None, top_n: int = 15, min_picks: int = 10
) -> DataFrame:
    """The most picked champions, shown from the lowest win rate up."""
    pool = champions.filter(F.col("picks") >= min_picks)
    if position:
        pool = pool.filter(F.col("team_position") == position)
    return (
        pool.orderBy(F.col("picks").desc(), "champion_name", "team_position")
        .limit(top_n)
        .select(
            "champion_name", "team_position", "picks", "winrate_pct", "avg_kda", "avg_damage",
            favour(F.col("winrate_pct")).alias("favour"),
        )
        .orderBy("winrate_pct", "champion_name", "team_position")
    )


def lineup_candidates(champions: DataFrame) -> DataFrame:
    """Champions to choose from per known position, positions in their fixed order."""
    order = F.array_position(F.array(*[F.lit(p) for p in schema.POSITION_ORDER]), F.col("team_position"))
    return (
        champions.select(order.cast("int").alias("position_order"), "team_position", "champion_name")
        .filter(F.col("position_order") > 0)
        .distinct()
        .orderBy("position_order", "champion_name")
    )


def champion_table(champions: DataFrame) -> DataFrame:
    """The champion columns of the full listing, most picked first."""
    return champions.select(
        "champion_name", "team_position", "picks", "winrate_pct", "avg_kda", "avg_damage"
    ).orderBy(F.col("picks").desc(), "champion_name", "team_position")
