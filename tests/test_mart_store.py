"""Marts kept up to date by loads: equal to a full build, and only touched periods are read and written."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, raw_frame
from matchforge import schema
from matchforge.plans import mart_store, marts, pipeline
from matchforge.plans.mart_store import DAY, UNDATED, MartStore, distinct_matches, match_bitmaps
from matchforge.sources import raw as landing

FACT = (
    "match_id STRING, puuid STRING, summoner_name STRING, champion_name STRING, team_position STRING, win BOOLEAN, "
    "kills BIGINT, deaths BIGINT, assists BIGINT, gold_earned BIGINT, damage_to_champions BIGINT, vision_score BIGINT, "
    "minions_killed BIGINT, neutral_minions_killed BIGINT, game_date TIMESTAMP_NTZ, game_duration BIGINT, "
    "item0 BIGINT, item1 BIGINT, item2 BIGINT, item3 BIGINT, item4 BIGINT, item5 BIGINT")
ITEMS = "item_id STRING, item_name STRING, gold_total BIGINT, tags STRING"


def fact_rows():
    rows = []
    for i in range(400):
        match = None if i % 97 == 0 else f"M{i // 5}"
        day = None if i % 31 == 0 else datetime(2024, 1 + (i // 5) % 4, 1 + i % 3)
        rows.append((
            match, None if i % 41 == 0 else f"p{i % 7}", None if i % 7 == 3 else f"n{i % 7}", ("A", "B", None)[i % 3], ("TOP", "", None, "MID")[i % 4],
            None if i % 13 == 0 else i % 2 == 0, i % 9, i % 3, i % 5, 100 * i, 7 * i, i % 50, i % 80, 3, day, 1800 + i,
            i % 4, 0, None, 3, 5000 + i % 2, 0))
    return rows


def by_text(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(fact_rows(), FACT)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(str(i), f"item {i}", 100, "t") for i in range(4)], ITEMS)


def full_build(fact, items):
    return {
        "mart_player_stats": marts.player_stats(fact), "mart_player_champion_stats": marts.player_champion_stats(fact),
        "mart_champion_stats": marts.champion_stats(fact), "mart_position_stats": marts.position_stats(fact),
        "mart_match_timeline": marts.match_timeline(fact), "mart_item_popularity": marts.item_popularity(fact, items)}


def test_loads_equal_a_full_build(spark, fact, items, tmp_path):
    store = MartStore(spark, str(tmp_path / "store"))
    assert store.marts(items) == {} and store.add("none", fact.limit(0)) == []
    late = F.coalesce(F.month("game_date") >= 3, F.lit(False)) & (F.col("kills") < 6)
    assert store.add("first", fact.filter(~late)) == ["2024-01", "2024-02", "2024-03", "2024-04", UNDATED]
    cells = tmp_path / "store" / "cells"
    files = lambda period: {p.name for p in (cells / f"period={period}").glob("*.parquet")}
    before = {period: files(period) for period in ("2024-01", "2024-03", UNDATED)}
    # the second load, broken off once and repeated, touches two months
    for _ in range(2):
        assert store.add("second", fact.filter(late)) == ["2024-03", "2024-04"]
    assert files("2024-01") == before["2024-01"] and files(UNDATED) == before[UNDATED]
    assert files("2024-03") != before["2024-03"]
    got, want = store.marts(items), full_build(fact, items)
    assert set(got) == set(want)
    for name in want:
        assert by_text(got[name]) == by_text(want[name]), name
    numbers = store.read("numbers")
    ids = fact.filter("match_id is not null").select("match_id").distinct().count()
    assert numbers.agg(F.count("*"), F.min("match_no"), F.max("match_no"), F.count_distinct("match_no")).first() == (ids, 1, ids, ids)


def test_only_touched_periods_are_scanned(spark, fact, tmp_path):
    store = MartStore(spark, str(tmp_path / "store"), period=DAY)
    store.add("all", fact)
    plan = store.touched(["2024-01-01", "2024-02-02"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan
    assert {r.period for r in store.touched(["2024-01-01"]).select("period").distinct().collect()} == {"2024-01-01"}
    # marts come from cells: no plan of theirs reads the fact
    for name, mart in store.marts().items():
        assert f"{tmp_path}/store/fact" not in "".join(mart.inputFiles()), name


def test_bitmaps_count_distinct_matches(spark):
    rows = spark.createDataFrame([(k, n) for k in "ab" for n in (1, 1, 32768, 32769, 10**9, None)] + [("a", 2)], "k STRING, match_no LONG")
    parts = match_bitmaps(rows.limit(6), ["k"]).unionByName(match_bitmaps(rows, ["k"]))
    assert dict(map(tuple, distinct_matches(parts, ["k"], "n").collect())) == {"a": 5, "b": 4}


def test_a_players_matches_take_no_bitmaps(spark, fact, tmp_path):
    """What is kept of matches is narrow and no longer than the fact, however far apart their numbers are."""
    store = MartStore(spark, str(tmp_path / "store"))
    store.add("all", fact)
    for table in ("games", "day_matches"):
        kept = store.read(table)
        assert not [f.name for f in kept.schema if f.dataType.simpleString() == "binary"], table
        assert 0 < kept.count() <= fact.count()
    assert "match_no" not in store.read("fact").columns


@pytest.mark.parametrize("fields", [schema.DEFAULT_FIELD_MAP, {**schema.DEFAULT_FIELD_MAP, "puuid": "riotIdGameName"}])
def test_a_load_brings_what_others_have_not(spark, tmp_path, monkeypatch, fields):
    """Pairs of other loads go with the later copies; flattened rows are staged once, and no second time by the store."""
    staged = []
    for module in (pipeline, mart_store):
        whole = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, whole=whole: staged.append((name, len(df.columns))) or whole(df, name))
    folder, store = str(tmp_path), str(tmp_path / "store")
    loads = [
        [("A", document([participant(0, kills=1), participant(1, kills=1)])), ("A", document([participant(0, kills=2)]))],
        [("A", document([participant(1, kills=3), participant(2, kills=3)])), ("B", document([participant(0, kills=3)])), (None, document([participant(0, kills=3)]))]]
    for number, records in enumerate([*loads, None]):
        if records:
            chunks = landing.append_raw_matches(raw_frame(spark, *records), folder)
        pipeline.add_load(spark, folder, chunks, store, field_map=fields, period="yyyy")
        rows = mart_store.MartStore(spark, store, "yyyy").read("fact").collect()
        got = sorted((str(r.match_id), r.puuid[-1], r.kills) for r in rows)
        assert got == [("A", "0", 1), ("A", "1", 1), *([("A", "2", 3), ("B", "0", 3), ("None", "0", 3)] if number else [])]
    if fields is schema.DEFAULT_FIELD_MAP:
        assert staged and not [name for name, columns in staged if columns >= len(fields)]
