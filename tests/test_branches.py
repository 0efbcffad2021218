"""Every class, label and fallback occurs in the results of the varied queries."""

import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
FAVOURS = {"favourable", "neutral", "unfavourable"}

LABELS = [
    ("vw_meta_champions_varied", "tier", {"S", "A", "B", "C"}),
    ("meta_tiers_varied", "tier", {"S", "A", "B", "C", "D"}),
    ("wr_anomalies_varied", "direction", {"overperforming", "underperforming"}),
    ("pick_quadrants_varied", "quadrant", {"often_winning", "often_losing", "seldom_winning", "seldom_losing"}),
    ("champion_bars_varied", "favour", FAVOURS),
    ("player_outliers_varied", "outlier_group", {"carries", "padders", "underrated"}),
    ("player_flags_varied", "favour", FAVOURS),
    ("player_flags_varied", "avg_kda_good", {True, False}),
    ("player_flags_varied", "winrate_pct_good", {True, False}),
    ("player_flags_varied", "avg_vision_good", {True, False}),
    ("player_flags_varied", "avg_cs_good", {True, False}),
    ("top_champions_per_player_varied", "favour", FAVOURS),
    ("player_style_varied", "style", {"aggressive", "support", "careful", "universal"}),
    ("player_style_varied", "pool_type", {"one_trick", "narrow", "flexible"}),
    ("recommend_champions_varied", "style_label", {"aggressive", "supportive", "safe", "balanced"}),
    ("predict_lineup_winrate_varied", "favour", FAVOURS),
    ("predict_lineup_winrate_varied", "synergy_note", {"balanced", "no_support", "standard"}),
    ("item_report_varied", "favour", FAVOURS),
    ("balance_by_position", "balance", {"balanced", "attention", "unbalanced"}),
    ("action_plan_varied", "kind", {
        "strongest_champion", "champion_to_avoid", "position_edge", "stats_without_wins", "wins_without_stats"}),
    ("insights_varied", "tag", {
        "META", "PICK TREND", "BROKEN", "DAMAGE TREND", "POSITION EDGE", "STAT PADDING"}),
]


@pytest.mark.parametrize("query, column, labels", LABELS, ids=lambda value: str(value)[:40])
def test_labels(spark, query, column, labels):
    found = {r[0] for r in QUERIES[query](spark, SF_DIR).select(column).distinct().collect()}
    assert found == labels


def test_thresholds_remove_groups(spark):
    from matchforge.plans import marts
    from registry import bindings as b

    with b.varied_reading():
        fact = b.participants(spark, SF_DIR)
        items = b.items(spark, SF_DIR)
    for mart, args, limit in (
        (marts.player_stats, (), {"min_games": 0}), (marts.champion_stats, (), {"min_picks": 0}),
        (marts.player_champion_stats, (), {"min_games": 0}), (marts.item_popularity, (items,), {"min_purchases": 0}),
    ):
        assert 0 < mart(fact, *args).count() < mart(fact, *args, **limit).count()


def test_ranks_have_nulls_and_ties(spark):
    top = QUERIES["vw_top_players_varied"](spark, SF_DIR)
    row = top.agg(
        F.count_if(F.col("avg_kda").isNull()).alias("nulls"),
        F.count(F.lit(1)).alias("n"), F.countDistinct("rank_wr").alias("ranks"),
    ).first()
    assert row["nulls"] > 0 and row["ranks"] < row["n"]


def test_lineup_fallbacks_and_limits(spark):
    picks = QUERIES["lineup_breakdown_varied"](spark, SF_DIR)
    row = picks.agg(
        F.count_if(F.col("champion_wr").isNull()).alias("unknown"),
        F.count_if((F.col("confidence") > 0) & (F.col("confidence") < 100)).alias("blended"),
        F.count_if(F.col("position").isNull()).alias("no_position"),
    ).first()
    assert min(row) > 0
    ends = QUERIES["predict_lineup_winrate_varied"](spark, SF_DIR).agg(F.min("predicted_wr"), F.max("predicted_wr")).first()
    assert tuple(ends) == (20.0, 80.0)
