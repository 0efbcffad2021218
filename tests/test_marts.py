import datetime
import re

import pytest
from pyspark.sql import functions as F

from conftest import POSITIONS, document, land
from matchforge import schema
from matchforge.plans import marts, pipeline, views
from matchforge.sources.tables import MARTS, read_marts, write_mart

FACT = (
    "match_id STRING, game_duration BIGINT, game_date TIMESTAMP_NTZ, puuid STRING, summoner_name STRING, "
    "team_position STRING, win BOOLEAN, kills BIGINT, deaths BIGINT, assists BIGINT, gold_earned BIGINT, "
    "minions_killed BIGINT, neutral_minions_killed BIGINT, damage_to_champions BIGINT, vision_score BIGINT, "
    "item0 BIGINT, item1 BIGINT, item2 BIGINT, item3 BIGINT, item4 BIGINT, item5 BIGINT, item6 BIGINT, "
    "champion_name STRING"
)


def row(match="M0", number=0, **changes):
    base = dict(
        match_id=match, game_duration=1800, game_date=datetime.datetime(2025, 1, 15, 23, 30),
        puuid=f"player-{number}", summoner_name=f"Name {number}", team_position=POSITIONS[number % 10],
        win=number < 5, kills=8, deaths=2, assists=5, gold_earned=12000, minions_killed=180,
        neutral_minions_killed=20, damage_to_champions=22000, vision_score=45,
        item0=3031, item1=3006, item2=0, item3=0, item4=None, item5=0, item6=3363,
        champion_name="Jinx" if number % 2 == 0 else "Thresh",
    )
    return {**base, **changes}


def frame(spark, rows):
    names = [part.split()[0] for part in FACT.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], FACT)


@pytest.fixture(scope="module")
def fact(spark):
    return frame(spark, [row(f"M{m}", n) for m in range(5) for n in range(10)]).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([("3031", "Edge", 3400, "Damage")], "item_id STRING, item_name STRING, gold_total BIGINT, tags STRING")


def test_player_stats(fact):
    got = marts.player_stats(fact).orderBy("puuid").collect()
    assert len(got) == 10
    first = got[0].asDict()
    assert first == {
        "puuid": "player-0", "summoner_name": "Name 0", "games_played": 5, "avg_kills": 8.0, "avg_deaths": 2.0,
        "avg_assists": 5.0, "avg_kda": 6.5, "winrate_pct": 100.0, "avg_gold": 12000.0, "avg_damage": 22000.0,
        "avg_vision": 45.0, "avg_cs": 200.0, "most_played_champion": "Jinx", "main_position": "TOP",
    }


def test_position_and_champion_invariants(fact):
    positions = marts.position_stats(fact).collect()
    assert len(positions) == 5 and {p.winrate_pct for p in positions} == {50.0}
    assert marts.champion_stats(fact).agg(F.sum("picks")).collect()[0][0] == 50


def test_having_thresholds(spark):
    df = frame(spark, [row("A"), row("B"), row("B"), row("C", 1), row("C", 1)])
    assert marts.player_stats(df, min_games=2).collect()[0].games_played == 2  # distinct matches
    assert marts.player_stats(df).count() == 0
    assert {r.puuid: r.games_played for r in marts.player_champion_stats(df).collect()} == {"player-0": 3, "player-1": 2}
    assert marts.champion_stats(df).count() == 0 and marts.champion_stats(df, min_picks=3).count() == 1


def test_null_keys_and_zero_deaths(spark):
    rows = [row(f"M{i}", 0, deaths=0, team_position=None) for i in range(5)]
    rows += [row(f"N{i}", 1, puuid=None) for i in range(5)]
    rows += [row(f"O{i}", 2, champion_name=None, summoner_name=None, team_position="") for i in range(5)]
    df = frame(spark, rows)
    players = {r.puuid: r for r in marts.player_stats(df).collect()}
    assert set(players) == {"player-0", "player-2"}
    assert players["player-0"].avg_kda is None and players["player-0"].main_position is None
    assert players["player-2"].most_played_champion is None and players["player-2"].games_played == 5
    assert {r.team_position for r in marts.champion_stats(df).collect()} == {None, "JUNGLE"}
    assert [r.team_position for r in marts.position_stats(df).collect()] == ["JUNGLE"]


def test_favourite_takes_the_smallest_of_a_tie(spark):
    names = ["B", "A", "B", "A", "C", None, None, None]
    df = frame(spark, [row(f"M{i}", 0, champion_name=c) for i, c in enumerate(names)])
    assert marts.player_stats(df).collect()[0].most_played_champion == "A"


def test_rounding_is_half_away_from_zero(spark):
    df = frame(spark, [row(f"M{i}", 0, kills=k) for i, k in enumerate([1] * 7 + [2])])  # mean 1.125
    assert marts.player_stats(df).collect()[0].avg_kills == 1.13


def test_items(spark, fact, items):
    got = {r.item_id: r for r in marts.item_popularity(fact, items).collect()}
    assert {k: v.total_purchases for k, v in got.items()} == {"3031": 50, None: 50}
    assert got["3031"].item_id_num == "3031" and got[None].item_name is None and got["3031"].winrate_pct == 50.0
    assert marts.item_popularity(fact, items, min_purchases=51).count() == 0


def test_two_unknown_items_share_one_group(spark, items):
    df = frame(spark, [row(f"M{i}", 0, item0=1, item1=2, item2=3031) for i in range(10)])
    assert {r.item_id: r.total_purchases for r in marts.item_popularity(df, items).collect()} == {None: 20, "3031": 10}


def test_timeline(spark, fact):
    day = marts.match_timeline(fact).collect()
    assert [(d.game_day, d.total_matches, d.avg_duration_min) for d in day] == [(datetime.date(2025, 1, 15), 5, 30.0)]
    assert marts.match_timeline(frame(spark, [row(game_date=None)])).count() == 0


def test_marts_from_cells_are_the_same(spark):
    rows = [row(f"M{i % 23}", (i * 7) % 10, kills=i % 11, deaths=i % 3, win=i % 2 == 0,
                team_position=[None, "", "TOP", "MID"][i % 4], champion_name=[None, "A", "B"][i % 3],
                summoner_name=None if i % 5 == 0 else "n", vision_score=None if i % 6 == 0 else i)
            for i in range(300)]
    df = frame(spark, rows)
    cells = marts.mart_cells(df)
    for build in (marts.player_stats, marts.player_champion_stats, marts.champion_stats, marts.position_stats):
        direct, merged = (sorted(m.collect(), key=repr) for m in (build(df), build(df, cells)))
        assert direct == merged and direct


def test_cells_are_not_regrouped_for_the_votes(spark):
    """Cells are one row per player, champion and position already; favourites and ties come out as from the fact."""
    names = {"summoner_name": None, "champion_name": None}
    df = frame(spark, [row(f"M{m}", n, **(names if m == 4 else {})) for m in range(6) for n in range(3)]
               + [row(f"N{m}", 0, champion_name="Ahri") for m in range(5)] + [row(f"O{m}", 3, champion_name=None) for m in range(4)])
    stats = marts.player_stats(df, marts.mart_cells(df).localCheckpoint())
    assert sorted(map(str, stats.collect())) == sorted(map(str, marts.player_stats(df).collect()))
    favourites = {(r.puuid, r.summoner_name): r.most_played_champion for r in stats.collect()}
    assert favourites["player-0", "Name 0"] == "Ahri" and favourites["player-3", "Name 3"] is None
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(puuid#\d+, summoner_name#\d+, champion_name#\d+", plan)


def test_views(spark, fact, items):
    top = views.top_players(marts.player_stats(fact)).collect()
    assert sorted(r.rank_wr for r in top) == [1] * 5 + [6] * 5 and {r.rank_kda for r in top} == {1}
    meta = views.meta_champions(marts.champion_stats(fact)).collect()
    assert {r.tier for r in meta} == {"A", "C"} and max(r.position_rank for r in meta) == 1
    efficiency = {r.item_name: r for r in views.item_efficiency(marts.item_popularity(fact, items)).collect()}
    assert efficiency["Edge"].gold_efficiency_score == 0.0 and efficiency[None].gold_efficiency_score is None
    assert {r.avg_kda for r in views.position_overview(marts.position_stats(fact)).collect()} == {6.5}


def test_deathless_players_rank_first_by_kda(spark):
    df = frame(spark, [row(f"M{i}", n, deaths=0 if n == 3 else 2) for i in range(5) for n in (1, 3)])
    ranks = {r.summoner_name: r.rank_kda for r in views.top_players(marts.player_stats(df)).collect()}
    assert ranks == {"Name 3": 1, "Name 1": 2}


def test_meta_tier_limits(spark):
    data = [("a", 20, 55.0, "S"), ("b", 19, 55.0, "A"), ("c", 50, 10.0, "A"), ("d", 5, 52.0, "A"),
            ("e", 5, 48.0, "B"), ("f", 5, 47.9, "C")]
    df = spark.createDataFrame([(n, "TOP", p, w, 1.0, 1.0) for n, p, w, _ in data],
                               "champion_name STRING, team_position STRING, picks BIGINT, winrate_pct DOUBLE, avg_kda DOUBLE, avg_damage DOUBLE")
    got = {r.champion_name: (r.tier, r.position_rank) for r in views.meta_champions(df).collect()}
    assert {k: v[0] for k, v in got.items()} == {n: t for n, _, _, t in data}
    assert (got["c"][1], got["d"][1], got["e"][1]) == (1, 4, 4)


def test_timeline_trends(spark):
    start = datetime.date(2025, 1, 1)
    df = spark.createDataFrame(
        [(start + datetime.timedelta(days=i * 2), i * i, 50.0, 1.0, float(i), float(i)) for i in range(10)],
        "game_day DATE, total_matches BIGINT, overall_winrate DOUBLE, avg_kills DOUBLE, avg_damage DOUBLE, avg_duration_min DOUBLE")
    got = views.timeline_trends(df).orderBy("game_day").collect()
    assert [r.damage_ma7 for r in got][:3] == [0.0, 0.5, 1.0] and got[9].damage_ma7 == 6.0
    assert [r.matches_delta for r in got][:3] == [None, 1, 3]


def test_pipeline_end_to_end_and_rebuild(spark, tmp_path):
    import json

    raw, processed, out = (str(tmp_path / n) for n in ("raw", "processed", "marts"))
    assert pipeline.run(spark, raw, processed, out) == {}  # nothing landed: no failure, nothing built
    land(spark, raw, "chunk_00000", *[(f"M{i}", document()) for i in range(3)])
    land(spark, raw, "chunk_00001", ("M0", document()), ("X", "NOT_JSON"), ("M3", document(gameDuration=60)))
    (tmp_path / "raw" / "static").mkdir()
    (tmp_path / "raw" / "static" / "items.json").write_text(json.dumps(
        {"_version": "1", "data": {"3031": {"name": "Edge", "gold": {"total": 3400}}}}))
    first = pipeline.run(spark, raw, processed, out)
    assert set(first) == set(MARTS)
    assert spark.read.parquet(f"{processed}/matches.parquet").count() == 40
    counts = {name: df.count() for name, df in first.items()}
    assert counts["mart_player_stats"] == 10 and counts["mart_position_stats"] == 5
    again = pipeline.run(spark, raw, processed, out)
    assert {name: df.count() for name, df in again.items()} == counts
    assert spark.table("vw_top_players").count() == 0  # four matches each, five needed
    assert spark.sql("SELECT item_name FROM vw_item_efficiency WHERE item_name = 'Edge'").count() == 1
    skipped = pipeline.run(spark, raw, processed, out, skip_transform=True, skip_quality=True, skip_marts=True)
    assert set(skipped) == set(MARTS)


def test_first_occurrence_wins_across_chunks(spark, tmp_path):
    from conftest import participant

    raw, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    land(spark, raw, "chunk_00001", ("M", document([participant(0, kills=2)])))
    land(spark, raw, "chunk_00000", ("M", document([participant(0, kills=1)])))
    assert pipeline.transform_matches(spark, raw, processed)
    assert [r.kills for r in spark.read.parquet(f"{processed}/matches.parquet").collect()] == [1]


def test_nothing_readable_leaves_the_old_fact(spark, tmp_path):
    raw, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    land(spark, raw, "chunk_00000", ("M", document()))
    assert pipeline.transform_matches(spark, raw, processed)
    other = str(tmp_path / "other")
    land(spark, other, "chunk_00000", ("M", "NOT_JSON"))
    assert not pipeline.transform_matches(spark, other, processed)
    assert not pipeline.transform_matches(spark, raw, processed, {})
    assert spark.read.parquet(f"{processed}/matches.parquet").count() == 10


def test_mart_readers_normalize_positions(spark, tmp_path):
    write_mart(spark.createDataFrame([("UTILITY",)], "team_position STRING"), str(tmp_path), "mart_position_stats")
    got = read_marts(spark, str(tmp_path))
    assert list(got) == ["mart_position_stats"]
    assert got["mart_position_stats"].collect()[0].team_position == "SUPPORT"


def test_pipeline_expands_players_and_types_added_fields(spark, tmp_path):
    from conftest import participant

    raw, processed, out = (str(tmp_path / n) for n in ("raw", "processed", "marts"))
    people = {"M1": "ab", "M2": "bc", "M3": "cd"}
    land(spark, raw, "chunk_00000", *[
        (m, document([participant(0, puuid=p, riotIdGameName=f"Name {p}", challenges={"kda": 2.5}) for p in who]))
        for m, who in people.items()])
    seed = spark.createDataFrame([("a", "First", 3, 1)], "puuid STRING, summonerName STRING, wins LONG, losses LONG")
    seed.write.parquet(f"{raw}/players/players.parquet")
    fields = {**schema.DEFAULT_FIELD_MAP, "kda": "challenges.kda"}
    for _ in range(2):  # a second run starts from the league again
        pipeline.run(spark, raw, processed, out, field_map=fields, types={"kda": "double"}, depth=3, matches_per_player=5)
        players = spark.read.parquet(f"{processed}/players.parquet")
        assert sorted(r.puuid for r in players.collect()) == ["a", "b", "c"]
    fact = spark.read.parquet(f"{processed}/matches.parquet")
    assert dict(fact.dtypes)["kda"] == "double" and {r.kda for r in fact.collect()} == {2.5}


def test_days_carry_no_totals_per_match(fact):
    """Days and matches are told apart on their own: no grouping by match sums anything."""
    plan = marts.match_timeline(fact)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    by_match = [line for line in plan.splitlines() if "Aggregate [game_day" in line and "match_id" in line]
    assert by_match and not [line for line in by_match if "sum(" in line]
