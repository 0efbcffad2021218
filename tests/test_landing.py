import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import document, land, participant, raw_frame
from matchforge.operators.flatten import flatten_matches
from matchforge.operators.incremental import landed_matches, new_matches
from matchforge.operators.recent import recent_matches
from matchforge.sources import dictionaries, players, raw, relational, tables
from matchforge.streaming.flatten_stream import flatten_landed_chunks


def test_landed_ids(spark, tmp_path, caplog):
    assert raw.landed_match_ids(spark, str(tmp_path / "none")).count() == 0
    land(spark, tmp_path, "chunk_00000", ("A", "{}"), ("B", "{}"), (None, "{}"))
    land(spark, tmp_path, "chunk_00001", ("B", "{}"), ("C", "{}"))
    (tmp_path / "matches" / "chunk_00002.parquet").write_bytes(b"not parquet")
    assert {r[0] for r in raw.landed_match_ids(spark, str(tmp_path)).collect()} == {"A", "B", "C"}
    assert "1 chunks" in caplog.text
    assert [r[0].rpartition("/")[2] for r in raw.silent_chunks(spark, str(tmp_path)).collect()] == ["chunk_00002.parquet"]
    assert raw.silent_chunks(spark, str(tmp_path / "none")).count() == 0


def test_append_only_when_there_is_something(spark, tmp_path):
    assert raw.append_raw_matches(raw_frame(spark), str(tmp_path)) is None
    assert not (tmp_path / "matches").exists()
    for match in "AB":
        assert "/matches/landed_" in raw.append_raw_matches(raw_frame(spark, (match, "{}")), str(tmp_path))
    assert raw.append_raw_matches(raw_frame(spark), str(tmp_path)) is None
    assert raw.landed_match_ids(spark, str(tmp_path)).count() == 2


def test_new_and_landed_matches(spark):
    fetched = raw_frame(spark, ("A", "1"), ("B", "2"), ("B", "2"), ("C", "3"))
    landed = raw_frame(spark, ("A", "0"), ("A", "0"), (None, "0"))
    assert {r.match_id for r in new_matches(fetched, landed).collect()} == {"B", "C"}
    assert new_matches(fetched, landed).count() == 2
    wanted = spark.createDataFrame([("B",), ("B",), ("Z",)], "match_id STRING")
    assert [r.match_id for r in landed_matches(fetched, wanted).collect()] == ["B"]


def test_recent_matches(spark):
    data = [("p", f"m{i}", i) for i in range(5)] + [("p", "m4", 4), ("q", "m0", 0), (None, "m1", 1), ("p", "old", None)]
    got = recent_matches(spark.createDataFrame(data, "puuid STRING, match_id STRING, game_date INT"), 2)
    assert sorted((r.puuid, r.match_id, r.recency) for r in got.collect()) == [
        ("p", "m3", 2), ("p", "m4", 1), ("q", "m0", 1)]


def test_player_dimension(spark):
    df = spark.createDataFrame(
        [("a", 50, 20, "x"), ("b", 0, 0, "x"), ("c", None, 3, "x")], "puuid STRING, wins BIGINT, losses BIGINT, _raw_json STRING"
    )
    got = players.player_dimension(df)
    assert got.columns == ["puuid", "wins", "losses", "winrate"]
    assert [r.winrate for r in got.orderBy("puuid").collect()] == [0.7143, None, None]


def test_relational_form(spark):
    df = spark.createDataFrame([("a", 1, "S", "n")], "puuid STRING, leaguePoints BIGINT, _tier STRING, extra STRING")
    assert players.relational_form(df, "players").columns == ["puuid", "league_points", "tier"]


def test_league_entries_and_missing_ids(spark):
    payloads = spark.createDataFrame([
        (json.dumps({"tier": "MASTER", "queue": "Q", "entries": [
            {"summonerId": "1", "leaguePoints": 10, "wins": 1, "losses": 2, "extra": {"a": 1}}, {"summonerId": "2", "puuid": "own"}]}),),
        (json.dumps({"entries": [{"summonerId": "3"}]}),),
    ], "document STRING")
    rows = players.league_entries(payloads, league="challenger", queue="SOLO", region="euw1")
    got = {r.summonerId: r for r in rows.collect()}
    assert (got["1"]._tier, got["1"]._queue, got["1"].leaguePoints) == ("MASTER", "Q", 10)
    assert json.loads(got["1"]._raw_json)["extra"] == {"a": 1}
    assert (got["3"]._tier, got["3"]._queue, got["3"]._region) == ("CHALLENGER", "SOLO", "euw1")
    known = spark.createDataFrame([("1", "found"), ("2", "other"), (None, "no")], "id STRING, puuid STRING")
    filled = {r.summonerId: r.puuid for r in players.fill_missing_puuid(rows, known).collect()}
    assert filled == {"1": "found", "2": "own", "3": None}


CHAMPIONS = {"_version": "14.2.0", "data": {
    "Jinx": {"key": "222", "name": "Jinx", "title": "t", "tags": ["Marksman", "Mage"], "partype": "Mana", "blurb": "b",
             "stats": {"hp": 630, "attackspeed": 0.625}},
    "Thresh": {"key": "412", "name": "Thresh"}}}
ITEMS = {"_version": "14.2.0", "data": {
    "3031": {"name": "Edge", "plaintext": "crit", "tags": ["Damage"], "gold": {"total": 3400, "sell": 2380, "purchasable": True},
             "from": ["1038", "1018"], "into": [], "depth": 3},
    "1001": {"name": "Boots", "gold": {"total": 300}}}}


def test_dictionaries(spark, tmp_path):
    assert dictionaries.read_documents(spark, str(tmp_path / "none.json")) is None
    (tmp_path / "champions.json").write_text(json.dumps(CHAMPIONS, indent=2))
    (tmp_path / "items.json").write_text(json.dumps(ITEMS, indent=2))
    champions = {r.champion_key: r for r in dictionaries.champions(
        dictionaries.read_documents(spark, str(tmp_path / "champions.json"))).collect()}
    assert len(champions) == 2
    assert (champions["Jinx"].champion_id, champions["Jinx"].tags, champions["Jinx"].hp, champions["Jinx"].dd_version) == (
        "222", "Marksman, Mage", 630.0, "14.2.0")
    assert (champions["Thresh"].tags, champions["Thresh"].blurb, champions["Thresh"].mp) == ("", "", None)
    items = {r.item_id: r for r in dictionaries.items(
        dictionaries.read_documents(spark, str(tmp_path / "items.json"))).collect()}
    assert (items["3031"].gold_total, items["3031"].from_items, items["3031"].into_items) == (3400, "1038, 1018", "")
    assert (items["1001"].description, items["1001"].purchasable, items["1001"].depth) == ("", None, None)


def test_overwrite_keeps_the_old_table_when_there_is_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.overwrite_table(spark.range(3).toDF("x"), path)
    assert not tables.overwrite_table(spark.range(0).toDF("x"), path)
    assert spark.read.parquet(path).count() == 3
    assert tables.overwrite_table(spark.range(2).toDF("x"), path)
    assert spark.read.parquet(path).count() == 2


def test_empty_relational_load_touches_nothing(spark):
    nowhere = relational.Database("jdbc:none:", {"driver": "none"})
    assert relational.load_table(spark.range(0).toDF("x"), nowhere, "t") == 0


def test_relational_options():
    options = relational.Database("jdbc:x:y", {"user": "u"}, batch_rows=500, connections=3).options("mart_a")
    assert options == {"user": "u", "url": "jdbc:x:y", "dbtable": "mart_a", "batchsize": "500", "numPartitions": "3"}


def test_refresh_time_is_added_once(spark):
    df = tables.with_refresh_time(spark.range(1))
    assert "refreshed_at" in df.columns and tables.with_refresh_time(df) is df


def test_item_report_is_ordered(spark):
    df = spark.range(50).select(
        F.col("id").cast("string").alias("item_id"), F.lit(7).alias("total_purchases"))
    assert [r.item_id for r in tables.item_report(df, 3).collect()] == ["0", "1", "10"]


def test_stream_adds_only_new_rows(spark, tmp_path):
    raw_dir, fact, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    land(spark, raw_dir, "chunk_00000", ("A", document()), ("B", "NOT_JSON"))
    flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    assert spark.read.parquet(fact).count() == 10
    people = [participant(i) for i in range(9, 12)]
    land(spark, raw_dir, "chunk_00001", ("A", document(people)), ("C", document()), ("C", document()))
    flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    landed = spark.read.parquet(fact)
    assert landed.count() == 10 + 2 + 10
    assert landed.select("match_id", "puuid").distinct().count() == 22
    flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    assert spark.read.parquet(fact).count() == 22


def test_stream_batch_replay_adds_nothing(spark, tmp_path):
    from matchforge.streaming.flatten_stream import append_new_participants

    batch = raw_frame(spark, ("A", document()))
    for _ in range(2):
        append_new_participants(batch, str(tmp_path / "fact"))
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 10


def test_stream_keeps_what_landed_first(spark, tmp_path):
    """Of copies inside a batch and across batches the first to land stays, as in the batch path."""
    raw_dir, fact, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    kills = iter((9, 1, 5, 3))
    for _ in range(2):
        for _ in range(2):
            rows = raw_frame(spark, ("M", document([participant(0, kills=next(kills))])))
            raw.append_raw_matches(rows, raw_dir)
        flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    assert [r.kills for r in spark.read.parquet(fact).collect()] == [9]
    batch_path = flatten_matches(raw.read_raw_matches(spark, raw_dir), first_by=raw.FILE_ORDER)
    assert [r.kills for r in batch_path.collect()] == [9]


def test_stream_replay_replaces_its_batch(spark, tmp_path):
    from matchforge.streaming.flatten_stream import append_new_participants

    fact = str(tmp_path / "fact")
    first, second = raw_frame(spark, ("A", document())), raw_frame(spark, ("A", document()), ("B", document()))
    append_new_participants(first, fact, name="q-0")
    append_new_participants(second, fact, name="q-1")
    # an attempt that broke off left other rows in the folder of the second batch
    raw_frame(spark, ("X", "{}")).write.mode("append").parquet(f"{fact}/batch=q-1")
    append_new_participants(second, fact, name="q-1")
    rows = spark.read.parquet(fact)
    assert {(r.batch, r.match_id, r.n) for r in rows.groupBy("batch", "match_id").agg(F.count("*").alias("n")).collect()} == {
        ("q-0", "A", 10), ("q-1", "B", 10)}


def test_missing_inputs_are_none(spark, tmp_path, caplog):
    assert raw.read_raw_matches(spark, str(tmp_path)) is None
    assert raw.read_parquet_if_present(spark, str(tmp_path / "x")) is None
    assert "nothing to read" in caplog.text


def test_appended_chunks_keep_their_order(spark, tmp_path):
    landed = str(tmp_path)
    for kills in range(4):
        new = raw_frame(spark, *[("M", document([participant(0, kills=kills)]))])
        assert raw.append_raw_matches(new, landed)
    rows = flatten_matches(raw.read_raw_matches(spark, landed), first_by=raw.FILE_ORDER).collect()
    assert [r.kills for r in rows] == [0]


def test_staged_tables_go_with_their_run(spark, tmp_path):
    from pathlib import Path

    from matchforge.session import shared_folder, stage, staged_run

    root = Path(shared_folder(spark).removeprefix("file:")) / "staged"
    before = set(root.glob("*")) if root.exists() else set()
    with pytest.raises(KeyError), staged_run(spark):
        assert stage(spark.range(5), "five").count() == 5
        assert set(root.glob("*")) - before
        raise KeyError
    assert set(root.glob("*")) == before


def test_failed_replacement_leaves_the_old_dataset(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.replace_dataset(spark.range(3), path)
    with pytest.raises(Exception):
        tables.replace_dataset(spark.range(3).selectExpr("raise_error('no') AS id"), path)
    assert spark.read.parquet(path).count() == 3
    tables.replace_dataset(spark.read.parquet(path).limit(1), path)  # may read what it replaces
    assert spark.read.parquet(path).count() == 1
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["table"]


def test_relational_read_in_ranges():
    from matchforge.sources.relational import Database, read_options

    database = Database("jdbc:x", connections=4)
    assert read_options(database, "t")["numPartitions"] == "1"
    ranged = read_options(database, "t", ("id", 1, 100))
    assert (ranged["partitionColumn"], ranged["upperBound"], ranged["numPartitions"]) == ("id", "100", "4")


def test_loads_are_sorted_before_their_documents_are_made(spark, tmp_path):
    """No document goes through the shuffle of the sort."""
    from registry import bindings, queries

    for name in ("lineitem", "part"):
        spark.createDataFrame([], bindings.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    for load in queries._two_loads(spark, str(tmp_path)):
        plan = load._jdf.queryExecution().optimizedPlan().toString()
        assert "AS readable" in plan.partition("Sort [")[0] and "AS readable" not in plan.partition("Sort [")[2]


def test_stream_shuffles_no_whole_rows(spark, tmp_path, monkeypatch):
    """The batch is deduplicated by its keys, and its staged rows are gone afterwards."""
    from matchforge.streaming import flatten_stream

    seen = []
    narrow = flatten_stream.flatten_first
    monkeypatch.setattr(flatten_stream, "flatten_first", lambda *a, **k: seen.append(narrow(*a, **k)) or seen[-1])
    raw_dir, fact, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    land(spark, raw_dir, "chunk_00000", ("A", document()), ("A", document()))
    flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    assert spark.read.parquet(fact).count() == 10
    assert "Window" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert not [p for p in seen[0].inputFiles() if Path(p.removeprefix("file:")).exists()]


def test_stream_reads_the_keys_of_other_batches_once(spark, tmp_path, monkeypatch):
    """No list of matches and no distinct pairs go before: a pair is in one batch only."""
    from matchforge.streaming import flatten_stream

    seen = []
    narrow = flatten_stream.flatten_first
    monkeypatch.setattr(flatten_stream, "flatten_first", lambda *a, **k: seen.append(k["known"]) or narrow(*a, **k))
    raw_dir, fact, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    people = [participant(0, puuid=None, kills=7), participant(1, kills=7), participant(20, kills=7)]
    for chunk, record in enumerate([("A", document([participant(0, puuid=None), participant(1)])), ("A", document(people)), (None, document(people))]):
        land(spark, raw_dir, f"chunk_{chunk:05d}", record, record, ("Z", "{}"))
        flatten_landed_chunks(spark, raw_dir, fact, state).awaitTermination()
    rows = spark.read.parquet(fact)
    assert sorted((str(r.match_id), str(r.puuid), r.kills) for r in rows.collect()) == [
        ("A", "None", 8), ("A", "player-1", 8), ("A", "player-20", 7),
        ("None", "None", 7), ("None", "player-1", 7), ("None", "player-20", 7)]
    for known in seen[1:]:
        plan = known._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
