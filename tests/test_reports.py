import datetime
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchforge.functions.ranking import By, Rank, magnitude, with_ranks
from matchforge.operators.graph import expand_players
from matchforge.plans import champions as c
from matchforge.plans import lineups as l
from matchforge.plans import players as p
from matchforge.plans import reports, timeline

CHAMPION = (
    "champion_name STRING, team_position STRING, picks BIGINT, winrate_pct DOUBLE, avg_kda DOUBLE, "
    "avg_damage DOUBLE, avg_gold DOUBLE, avg_vision DOUBLE"
)
PLAYER = (
    "puuid STRING, summoner_name STRING, games_played BIGINT, avg_kda DOUBLE, winrate_pct DOUBLE, "
    "avg_damage DOUBLE, avg_vision DOUBLE, avg_cs DOUBLE, most_played_champion STRING, main_position STRING"
)


def champion(name, position="TOP", picks=20, wr=50.0, kda=3.0, damage=100.0, vision=10.0):
    return (name, position, picks, wr, kda, damage, 1.0, vision)


def player(name, kda=3.0, wr=50.0, games=10, damage=100.0, vision=10.0, favourite="A", position="TOP", cs=100.0):
    return (f"id-{name}", name, games, kda, wr, damage, vision, cs, favourite, position)


def champions(spark, *rows):
    return spark.createDataFrame(list(rows), CHAMPION)


def players(spark, *rows):
    return spark.createDataFrame(list(rows), PLAYER)


# --- ranks --------------------------------------------------------------------------

@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("average", [True, False])
def test_rank_matches_pandas(spark, descending, average):
    values = [((i * 37) % 101) / 10 - 3 if i % 9 else None for i in range(400)]
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v DOUBLE")
    got = with_ranks(df, {"r": Rank([By("v", descending=descending)], average=average)}).filter("v IS NOT NULL")
    want = pd.Series(values, dtype=float).rank(ascending=not descending, method="average" if average else "min").dropna()
    assert {r.id: float(r.r) for r in got.collect()} == want.to_dict()


def test_rank_of_two_keys_and_nulls_first(spark):
    df = spark.createDataFrame([(1, 5.5, 3), (2, 5.5, 4), (3, None, 1), (4, 5.2, 9), (5, 5.5, 3)], "id INT, a DOUBLE, b INT")
    got = with_ranks(df, {"r": Rank([By("a", nulls_first=True), By("b")])})
    assert {r.id: r.r for r in got.collect()} == {3: 1, 2: 2, 1: 3, 5: 3, 4: 5}
    counts = with_ranks(df, {"r": Rank([By("b")], bucket=magnitude)})
    assert {r.id: r.r for r in counts.collect()} == {4: 1, 2: 2, 1: 3, 5: 3, 3: 5}


def test_rank_sorts_no_whole_set_in_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 70).cast("double").alias("v"))
    plan = with_ranks(df, {"r": Rank([By("v")])})._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "__size" in line:
            continue  # sums over the buckets
        assert "Window [" not in line or "], [__bucket" in line


# --- champions -------------------------------------------------------------------------

def test_meta_tiers(spark):
    df = champions(
        spark, champion("a", picks=40, wr=54.0), champion("b", picks=30, wr=52.0), champion("c", picks=20, wr=60.0),
        champion("d", picks=10, wr=45.0), champion("e", picks=5, wr=44.9), champion("f", picks=5, wr=48.0),
    )
    tiers = c.meta_tiers(df)
    assert {r.champion_name: r.tier for r in tiers.collect()} == {"a": "S", "b": "A", "c": "A", "d": "C", "e": "D", "f": "B"}
    assert [(r.tier, r.champions) for r in c.tier_counts(tiers).collect()] == [("S", 1), ("A", 2), ("B", 1), ("C", 1), ("D", 1)]
    assert [r.champion_name for r in c.strongest(tiers).collect()] == ["a", "c", "b"]
    assert c.tier_list(tiers, position="MID").count() == 0 and c.tier_list(tiers).count() == 4
    quadrants = {r.champion_name: (r.median_picks, r.quadrant) for r in c.pick_quadrants(tiers).collect()}
    assert quadrants["a"] == (25.0, "often_winning") and quadrants["d"] == (25.0, "seldom_losing") and "e" not in quadrants


def test_tier_counts_of_nothing(spark):
    tiers = c.meta_tiers(champions(spark, champion("a"))).limit(0)
    assert [r.champions for r in c.tier_counts(tiers).collect()] == [0] * 5


def test_anomalies(spark):
    df = champions(spark, *[champion(f"n{i}") for i in range(10)], champion("up", wr=70.0), champion("down", wr=30.0),
                   champion("rare", picks=14, wr=99.0))
    wr = pd.Series([50.0] * 10 + [70.0, 30.0])
    got = {r.champion_name: (r.direction, round(r.z_score, 9)) for r in c.winrate_anomalies(df).collect()}
    assert got == {"up": ("overperforming", round(20 / wr.std(), 9)), "down": ("underperforming", round(-20 / wr.std(), 9))}


def test_anomalies_of_few_or_equal_rows(spark):
    assert c.winrate_anomalies(champions(spark, champion("a", wr=10.0), champion("b", wr=90.0))).count() == 0
    assert c.winrate_anomalies(champions(spark, *[champion(f"n{i}") for i in range(5)])).count() == 0


def test_bars_candidates_and_classes(spark):
    df = champions(spark, champion("a", picks=30, wr=55.0), champion("b", picks=40, wr=45.0), champion("c", picks=9),
                   champion("d", "SUPPORT", picks=50, wr=50.0), champion("e", "", picks=50))
    bars = c.champion_bars(df, position="TOP").collect()
    assert [(r.champion_name, r.favour) for r in bars] == [("b", "unfavourable"), ("a", "favourable")]
    assert [r.champion_name for r in c.champion_bars(df, top_n=1).collect()] == ["d"]
    assert [(r.position_order, r.champion_name) for r in c.lineup_candidates(df).collect()] == [
        (1, "a"), (1, "b"), (1, "c"), (5, "d")]


# --- players -----------------------------------------------------------------------------

def test_outliers_match_pandas(spark):
    rows = [player(f"n{i:02d}", kda=1 + (i * 7 % 11) / 2, wr=40.0 + (i * 13 % 17)) for i in range(20)] + [player("none", kda=None)]
    df = pd.DataFrame(rows, columns=[x.split()[0] for x in PLAYER.split(", ")])
    df["kda_z"] = (df.avg_kda - df.avg_kda.mean()) / df.avg_kda.std()
    df["wr_z"] = (df.winrate_pct - df.winrate_pct.mean()) / df.winrate_pct.std()
    df["gap"] = df.kda_z - df.wr_z
    want = {
        "carries": df[(df.kda_z > 0.5) & (df.wr_z > 0.5)].sort_values(["wr_z", "summoner_name"], ascending=[False, True]).head(5),
        "padders": df.sort_values(["gap", "summoner_name"], ascending=[False, True]).head(3),
        "underrated": df.sort_values(["gap", "summoner_name"]).head(3),
    }
    got = p.player_outliers(players(spark, *rows)).collect()
    for group, frame in want.items():
        mine = sorted((r.place, r.summoner_name) for r in got if r.outlier_group == group)
        assert [n for _, n in mine] == list(frame.summoner_name), group


def test_few_players_and_equal_players(spark):
    assert p.player_outliers(players(spark, player("a"), player("b"), player("c"))).count() == 0
    same = p.player_outliers(players(spark, *[player(n) for n in "abcd"])).collect()
    assert {(r.outlier_group, r.gap) for r in same} == {("padders", 0.0), ("underrated", 0.0)}


def test_outlier_cards(spark):
    rows = [player(f"n{i}", kda=float(i), wr=50.0 + (i % 3)) for i in range(9)]
    cards = p.outlier_cards(p.player_outliers(players(spark, *rows))).collect()
    assert all(r.place <= 3 for r in cards)
    assert all(r.gap > 0.3 for r in cards if r.outlier_group == "padders")
    assert all(r.gap < -0.3 for r in cards if r.outlier_group == "underrated")


def test_rank_gap(spark):
    got = {r.summoner_name: r for r in p.rank_gap(players(
        spark, player("a", kda=5.0, wr=40.0), player("b", kda=3.0, wr=60.0), player("c", kda=3.0, wr=60.0), player("d", kda=None, wr=50.0))).collect()}
    assert (got["a"].kda_rank, got["a"].wr_rank, got["a"].gap) == (1.0, 4.0, 3.0)
    assert (got["b"].kda_rank, got["b"].wr_rank, got["b"].gap) == (2.5, 1.5, -1.0)
    assert got["d"].kda_rank is None and got["d"].gap is None


POOL = "puuid STRING, champion_name STRING, team_position STRING, games_played BIGINT, avg_damage DOUBLE, avg_vision DOUBLE, avg_kda DOUBLE"


def test_pools_and_styles(spark):
    rows = [("one", "A", "TOP", 70, 25000.0, 10.0, 3.0), ("one", "B", "TOP", 30, 15000.0, 10.0, 3.0)]
    rows += [("sup", "A", "TOP", 50, 100.0, 50.0, 9.0), ("sup", "B", "TOP", 50, 100.0, 50.0, None)]
    rows += [("safe", x, "TOP", 10, 100.0, 1.0, 5.0) for x in "ABCDEF"]
    rows += [("any", "A", "TOP", 1, 30000.0, 1.0, 3.2)]
    top = p.top_champions(spark.createDataFrame(rows, POOL))
    assert top.filter("puuid = 'safe'").count() == 5
    assert {r.champion_name: r.share_pct for r in top.filter("puuid = 'one'").collect()} == {"A": 70.0, "B": 30.0}
    got = {r.puuid: r for r in p.player_styles(top).collect()}
    assert (got["one"].style, got["one"].pool_type, got["one"].top1_share, got["one"].avg_damage) == ("aggressive", "one_trick", 70.0, 22000.0)
    assert (got["sup"].style, got["sup"].pool_type, got["sup"].avg_kda) == ("support", "narrow", 4.5)
    assert (got["safe"].style, got["safe"].pool_type) == ("careful", "flexible")
    assert got["any"].style == "universal"


def test_recommendations_match_a_player_at_a_time(spark):
    roster = [champion(f"c{i:02d}", pos, picks=5 + i * 3 % 29, wr=45.0 + i * 7 % 13, kda=None if i == 4 else 1.0 + i % 5,
                       damage=100.0 + i * 31 % 70, vision=10.0 + i % 7) for pos in ("TOP", "MID") for i in range(14)]
    people = [player(f"p{i}", kda=k, damage=d, vision=v, favourite=f, position=pos) for i, (k, d, v, f, pos) in enumerate([
        (2.0, 200.0, 1.0, "c03", "TOP"), (2.0, 1.0, 100.0, "c10", "MID"), (5.0, 1.0, 1.0, "", "TOP"), (3.0, 1.0, 1.0, None, "MID"),
        (None, 200.0, 100.0, "c07", "TOP"), (2.0, 200.0, 100.0, "c02", "MID"), (3.0, 1.0, 1.0, "x", "NOWHERE")])]
    frame = pd.DataFrame(roster, columns=[x.split()[0] for x in CHAMPION.split(", ")])
    want = {}
    for who in people:
        name, kda, damage, vision, favourite, position = who[1], who[3], who[5], who[6], who[8], who[9]
        pool = frame[frame.team_position == position].copy()
        flags = (kda is not None and kda < 2.5 and damage > pool.avg_damage.median(),
                 vision > pool.avg_vision.median() * 1.3, kda is not None and kda > 4.0)
        score = 0.0 if any(flags) else 20.0
        for flag, column in zip(flags, ("avg_damage", "avg_vision", "avg_kda")):
            score = score + (pool[column].rank(pct=True) * 40 if flag else 0)
        pool["fit"] = score + (pool.winrate_pct - 50) * 1.5 + pool.picks.rank(pct=True) * 10
        pool = pool[(pool.picks >= 10) & (pool.champion_name != favourite)]
        best = pool.sort_values(["fit", "champion_name"], ascending=[False, True]).head(5)
        want.update({(name, i + 1): (r.champion_name, None if math.isnan(r.fit) else round(r.fit, 9))
                     for i, r in enumerate(best.itertuples())})
    got = {(r.summoner_name, r.place): (r.champion_name, None if r.fit_score is None else round(r.fit_score, 9))
           for r in p.recommend_champions(players(spark, *people), champions(spark, *roster)).collect()}
    assert got == want


def test_flags_sizes_and_lookup(spark):
    df = players(spark, player("a", kda=3.0, wr=50.0, vision=40.0, cs=160.0, games=10), player("b", kda=None, wr=45.0, games=5))
    flags = {r.summoner_name: r for r in p.player_flags(df).collect()}
    assert all(flags["a"][f"{m}_good"] for m in ("avg_kda", "winrate_pct", "avg_vision", "avg_cs"))
    assert not flags["b"].avg_kda_good and flags["b"].favour == "unfavourable"
    assert {r.summoner_name: r.marker_size for r in p.marker_sizes(df).collect()} == {"a": 38.0, "b": 23.0}
    assert [r.summoner_name for r in p.player_table(df).collect()] == ["a", "b"]
    assert p.one_player(df, puuid="id-a").count() == 1 and p.one_player(df.drop("puuid"), puuid="id-a", summoner_name="b").count() == 1


# --- line-ups -------------------------------------------------------------------------------

def test_lineups(spark):
    roster = champions(spark, champion("A", "TOP", picks=25, wr=60.0), champion("B", "MID", picks=100, wr=40.0))
    positions = spark.createDataFrame([("TOP", 50.0), ("MID", 48.0), ("SUPPORT", 52.0)], "team_position STRING, winrate_pct DOUBLE")
    picks = spark.createDataFrame(
        [(1, "TOP", "A"), (1, "MID", "B"), (1, "SUPPORT", "Z"), (2, "TOP", "A"), (3, "SUPPORT", "Z"), (4, "ODD", "Q"), (4, "SUPPORT", "Z")],
        "lineup_id INT, position STRING, champion_name STRING")
    rated = l.lineup_picks(picks, roster, positions)
    shown = {(r.lineup_id, r.position): r for r in l.lineup_breakdown(rated).collect()}
    assert (shown[1, "TOP"].effective_wr, shown[1, "TOP"].confidence) == (55.0, 50.0)
    assert (shown[1, "MID"].effective_wr, shown[1, "MID"].confidence) == (40.0, 100.0)
    assert (shown[1, "SUPPORT"].champion_wr, shown[1, "SUPPORT"].effective_wr, shown[4, "ODD"].effective_wr) == (None, 52.0, 50.0)
    got = {r.lineup_id: (r.predicted_wr, r.synergy_bonus, r.synergy_note) for r in l.predict_lineups(rated).collect()}
    assert got == {1: (50.0, 1.0, "balanced"), 2: (53.5, -1.5, "no_support"), 3: (52.0, 0.0, "standard"), 4: (51.0, 0.0, "standard")}


def test_estimate_is_kept_within_limits(spark):
    roster = champions(spark, champion("A", "TOP", picks=50, wr=99.0), champion("B", "TOP", picks=50, wr=1.0))
    positions = spark.createDataFrame([], "team_position STRING, winrate_pct DOUBLE")
    picks = spark.createDataFrame([(1, "TOP", "A"), (2, "TOP", "B")], "lineup_id INT, position STRING, champion_name STRING")
    rated = l.lineup_picks(picks, roster, positions)
    assert {r.lineup_id: r.predicted_wr for r in l.predict_lineups(rated).collect()} == {1: 80.0, 2: 20.0}


# --- timeline and summaries --------------------------------------------------------------------

def days(spark, values):
    start = datetime.date(2025, 1, 1)
    return spark.createDataFrame(
        [(start + datetime.timedelta(days=i), float(v), 1.0, 1.0, 10) for i, v in enumerate(values)],
        "game_day DATE, avg_damage DOUBLE, avg_duration_min DOUBLE, avg_kills DOUBLE, total_matches BIGINT")


def test_timeline_against_pandas(spark):
    values = [100 + (i * 17 % 23) for i in range(30)]
    values[11] = 900
    series = pd.Series(values, dtype=float)
    got = timeline.timeline_anomalies(days(spark, values)).orderBy("game_day").collect()
    want = series.rolling(7, center=True).mean()
    assert [r.ma7 is None for r in got] == list(want.isna())
    assert all(abs(r.ma7 - w) < 1e-9 for r, w in zip(got, want) if r.ma7 is not None)
    assert [r.anomaly for r in got] == list((series - series.mean()).abs() > 2 * series.std())
    delta = timeline.period_delta(days(spark, values)).collect()[0]
    early, late = series.head(7).mean(), series.tail(7).mean()
    assert abs(delta.delta_pct - (late - early) / early * 100) < 1e-9
    with pytest.raises(ValueError):
        timeline.timeline_anomalies(days(spark, values), "other")


def test_action_plan_insights_and_health(spark):
    roster = champions(
        spark, *[champion(f"n{i}", picks=20 + i) for i in range(10)], champion("best", picks=90, wr=58.0), champion("worst", picks=40, wr=30.0))
    people = players(spark, *[player(f"p{i}") for i in range(8)], player("padder", kda=9.0, wr=40.0), player("hidden", kda=1.0, wr=65.0))
    positions = spark.createDataFrame([("TOP", 53.0, 10.0, 1.0, 1.0, 1.0), ("MID", 49.0, 20.0, 1.0, 1.0, 1.0)],
                                      "team_position STRING, winrate_pct DOUBLE, avg_damage DOUBLE, avg_kills DOUBLE, avg_gold DOUBLE, avg_vision DOUBLE")
    plan = reports.action_plan(roster, people, positions).orderBy("priority").collect()
    assert [(r.priority, r.subject) for r in plan] == [(1, "best"), (2, "worst"), (3, "TOP"), (4, "padder"), (5, "hidden")]
    assert (plan[2].contrast, plan[2].contrast_winrate_pct) == ("MID", 49.0)
    notes = {r.tag: r for r in reports.insights(roster, people, positions, days(spark, range(1, 21))).collect()}
    assert set(notes) == {"PICK TREND", "BROKEN", "DAMAGE TREND", "POSITION EDGE", "STAT PADDING"}
    assert notes["DAMAGE TREND"].detail == "up" and notes["STAT PADDING"].subject == "padder"
    health = reports.balance_health(roster, people, positions).collect()[0]
    assert (health.balance, health.overperforming, health.s_tier_champions, health.actions, health.players) == ("balanced", 0, 1, 5, 10)
    radar = {r.team_position: r for r in reports.position_radar(positions).collect()}
    assert (radar["TOP"].winrate_pct, radar["MID"].avg_damage, radar["TOP"].avg_gold) == (1.0, 1.0, 0.5)


def test_quiet_data_gives_no_actions(spark):
    roster = champions(spark, *[champion(f"n{i}", picks=20) for i in range(5)])
    people = players(spark, *[player(f"p{i}") for i in range(5)])
    positions = spark.createDataFrame([("TOP", 50.0)], "team_position STRING, winrate_pct DOUBLE")
    assert reports.action_plan(roster, people, positions).count() == 0


# --- player graph ---------------------------------------------------------------------------------

EDGES = [("m1", "s", 1), ("m1", "a", 1), ("m2", "a", 2), ("m2", "b", 2), ("m3", "b", 3), ("m3", "c", 3), ("m3", "", 3), ("m3", None, 3),
         ("m0", "s", 0), ("m0", "far", 0)]


def expand(spark, depth, count=1, profiles="abc"):
    seed = spark.createDataFrame([("s", 100, "CHALLENGER"), ("s", 100, "CHALLENGER"), (None, 5, "X")], "puuid STRING, leaguePoints INT, _tier STRING")
    edges = spark.createDataFrame(EDGES, "match_id STRING, puuid STRING, game_date INT")
    known = spark.createDataFrame([(x, f"name {x}", "T") for x in profiles], "puuid STRING, gameName STRING, tagLine STRING")
    return expand_players(seed, edges, known, depth=depth, matches_per_player=count, queue="Q", region="R")


def test_graph_depth(spark):
    assert expand(spark, 1).count() == 3  # the seed as it is
    # a's most recent match is m2, b's is m3
    for depth, reached in ((2, "a"), (3, "ab"), (4, "abc"), (9, "abc")):
        got = {r.puuid: r for r in expand(spark, depth).collect()}
        assert set(got) == {"s", None, *reached}
        assert (got["a"]._tier, got["a"]._graph_level, got["a"].leaguePoints, got["a"].summonerName) == ("GRAPH", "expanded", None, "name a")


def test_player_without_profile_is_met_but_not_listed(spark):
    assert {r.puuid for r in expand(spark, 4, profiles="bc").collect()} == {"s", None, "b", "c"}


def test_older_matches_count_when_asked_for(spark):
    edges = {r.puuid for r in expand(spark, 2, count=2, profiles=["a", "far"]).collect()}
    assert edges == {"s", None, "a", "far"}
