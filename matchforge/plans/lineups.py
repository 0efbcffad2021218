"""Win-rate estimates for line-ups (lineup_id, position, champion_name)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge.functions.numeric import order_free_sum, round_to
from matchforge.plans.champions import CLOSE_CALL, favour

# Roles that make a balanced line-up, and the estimate's limits.
FRONT_LINE = ("TOP", "JUNGLE")
DAMAGE = ("MID", "BOTTOM")
SUPPORT = "SUPPORT"
DEFAULT_BASELINE = 50.0
TRUSTED_PICKS = 50
LOWEST, HIGHEST = 20.0, 80.0


def lineup_picks(lineups: DataFrame, champions: DataFrame, positions: DataFrame) -> DataFrame:
    """Each pick with its champion's record, the position's baseline and their blend.

    The more often a champion was picked, the more its own win rate counts. A
    pick without a record falls back to the baseline. The baselines, one per
    position, enter as one map, so no join has only the positions as keys.
    """
    record = champions.select(
        F.col("champion_name").alias("known_champion"),
        F.col("team_position").alias("known_position"),
        F.col("winrate_pct").alias("champion_wr"),
        F.col("picks").alias("known_picks"),
    )
    baselines = positions.agg(
        F.map_from_entries(F.collect_list(F.struct("team_position", "winrate_pct")))
    ).scalar()
    confidence = F.coalesce(F.least(F.lit(1.0), F.col("known_picks") / F.lit(TRUSTED_PICKS)), F.lit(0.0))
    base = F.coalesce(F.try_element_at(baselines, F.col("position")), F.lit(DEFAULT_BASELINE))
    blended = F.coalesce(
        F.col("champion_wr") * confidence + base * (F.lit(1) - confidence), base
    )
    return (
        lineups.join(
            record,
            (F.col("champion_name") == F.col("known_champion"))
            & (F.col("position") == F.col("known_position")),
            "left",
        )
        .select(
            "lineup_id", "position", "champion_name", "champion_wr",
            F.coalesce("known_picks", F.lit(0)).alias("picks"),
            base.alias("position_baseline"),
            blended.alias("effective_wr"),
            confidence.alias("confidence"),
        )
    )


def lineup_breakdown(picks: DataFrame) -> DataFrame:
    """``lineup_picks`` as shown: estimate to one digit, confidence in percent."""
    return picks.withColumns({
        "effective_wr": round_to(F.col("effective_wr"), 1),
        "confidence": round_to(F.col("confidence") * F.lit(100), 0),
    })


def predict_lineups(picks: DataFrame) -> DataFrame:
    """Mean of the blended win rates per line-up, adjusted for the balance of roles."""
    full = (
        F.bool_or(F.coalesce(F.col("position").isin(*FRONT_LINE), F.lit(False))),
        F.bool_or(F.coalesce(F.col("position").isin(*DAMAGE), F.lit(False))),
        F.bool_or(F.coalesce(F.col("position") == SUPPORT, F.lit(False))),
    )
    balanced = F.col("has_front") & F.col("has_damage") & F.col("has_support")
    bonus = F.when(balanced, 1.0).when(~F.col("has_support"), -1.5).otherwise(0.0)
    note = F.when(balanced, "balanced").when(~F.col("has_support"), "no_support").otherwise("standard")
    estimate = F.least(
        F.lit(HIGHEST), F.greatest(F.lit(LOWEST), F.col("mean_wr") + F.col("synergy_bonus"))
    )
    return (
        picks.groupBy("lineup_id")
        .agg(
            F.count(F.lit(1)).alias("roles"),
            (order_free_sum(F.col("effective_wr")) / F.count(F.lit(1))).alias("mean_wr"),
            full[0].alias("has_front"), full[1].alias("has_damage"), full[2].alias("has_support"),
        )
        .withColumn("synergy_bonus", bonus)
        .select(
            "lineup_id", "roles", round_to(estimate, 1).alias("predicted_wr"),
            "synergy_bonus", note.alias("synergy_note"),
        )
        .withColumn("favour", favour(F.col("predicted_wr"), *CLOSE_CALL))
    )
