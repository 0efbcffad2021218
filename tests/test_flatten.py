import datetime
import json

import pytest
from pyspark.sql import functions as F

from conftest import document, participant, raw_frame
from matchforge import schema
from matchforge.operators.flatten import (
    corrupt_matches, flatten_first, flatten_matches, keep_first, normalize_position_columns,
)
from matchforge.operators.recent import in_queue
from matchforge.session import PLACE, TASK, at_places, stage_with_places
from matchforge.sources import documents


def rows(df, *columns):
    return sorted(df.select(*columns).collect(), key=repr)


def test_ten_rows_per_match_with_all_columns(spark):
    flat = flatten_matches(raw_frame(spark, *[(f"M{i}", document()) for i in range(3)]))
    assert flat.columns == list(schema.DEFAULT_FIELD_MAP)
    assert flat.count() == 30
    assert flat.select("match_id").distinct().count() == 3
    types = dict(flat.dtypes)
    assert types["kills"] == "bigint" and types["win"] == "boolean" and types["game_date"] == "timestamp_ntz"


def test_values_and_types(spark):
    row = flatten_matches(raw_frame(spark, ("M", document([participant(1)])))).collect()[0]
    assert (row.match_id, row.game_duration, row.game_version, row.game_mode) == ("M", 1800, "14.1.1", "CLASSIC")
    assert row.game_date == datetime.datetime(2023, 11, 14, 22, 13, 20)
    assert (row.kills, row.win, row.item0, row.item3, row.champion_id) == (8, True, 3031, None, 222)


def test_nested_and_missing_paths(spark):
    fields = {
        "kda": "challenges.kda", "solo": "challenges.soloKills", "no": "challenges.missing",
        "deep": "a.b.c.d", "through_scalar": "kills.x", "mode": "__game_mode__",
    }
    flat = flatten_matches(
        raw_frame(spark, ("M", document([participant(0, challenges={"kda": 4.5, "soloKills": 2})]))), fields
    )
    assert flat.collect()[0].asDict() == {
        "kda": "4.5", "solo": "2", "no": None, "deep": None, "through_scalar": None, "mode": "CLASSIC"
    }


def test_types_of_added_columns(spark):
    raw = raw_frame(spark, ("M", document([participant(0, pentaKills=1, challenges={"kda": 4.5})])))
    flat = flatten_matches(raw, {"pentakills": "pentaKills", "kda": "challenges.kda"}, types={"kda": "double"})
    assert flat.collect()[0].asDict() == {"pentakills": 1, "kda": 4.5}


def test_overlapping_paths_are_refused(spark):
    with pytest.raises(ValueError):
        flatten_matches(raw_frame(spark), {"all": "challenges", "kda": "challenges.kda"})


def test_empty_field_map_is_refused(spark):
    with pytest.raises(ValueError):
        flatten_matches(raw_frame(spark, ("M", document())), {})


def test_odd_values_do_not_cost_the_others(spark):
    people = [
        participant(0, championId="222", deaths=2.0, assists="many", win="true"),
        None,
        participant(1, kills=7.5),
    ]
    flat = flatten_matches(raw_frame(spark, ("M", document(people))))
    assert rows(flat, "puuid", "champion_id", "deaths", "assists", "kills", "win") == [
        ("player-0", 222, 2, None, 8, True), ("player-1", 222, 2, 5, None, True),
    ]


def test_corrupt_documents_are_skipped_and_listed(spark):
    bad = {"broken": "NOT_JSON{{{{", "list": "[]", "null": None, "cut": document()[:-40], "tail": document() + " x",
           "text": '"info"', "two": document() + document(), "listed": f"{document()},{document()}",
           "quotes": document().replace('"', "'")}
    repeated = document()[:-1] + ', "x": 1, "x": NaN}'
    raw = raw_frame(spark, ("good", document()), ("empty", '{"info": {}}'), ("spaced", f" {document()}\n"),
                    ("repeated", repeated), *bad.items())
    flat = flatten_matches(raw)
    assert {r.match_id for r in flat.select("match_id").distinct().collect()} == {"good", "spaced", "repeated"}
    assert {r.match_id for r in corrupt_matches(raw).collect()} == set(bad)


def test_duplicates_across_documents_keep_the_first(spark):
    raw = raw_frame(
        spark,
        ("M", document([participant(0, kills=1), participant(0, kills=2), participant(1, kills=3)])),
        ("M", document([participant(1, kills=4), participant(2, kills=5)])),
        ("N", document([participant(0, kills=6)])),
    ).withColumn("place", F.monotonically_increasing_id())
    flat = flatten_matches(raw, first_by=["place"])
    assert rows(flat, "match_id", "puuid", "kills") == [
        ("M", "player-0", 1), ("M", "player-1", 3), ("M", "player-2", 5), ("N", "player-0", 6),
    ]


def test_missing_player_id_is_one_key(spark):
    people = [participant(0, puuid=None, kills=1), participant(1, puuid=None, kills=2)]
    assert flatten_matches(raw_frame(spark, ("M", document(people)))).count() == 1


def test_key_with_very_many_copies(spark):
    df = spark.range(200_000).select((F.col("id") % 3 == 0).alias("hot"), "id").select(
        F.when(F.col("hot"), 0).otherwise(F.col("id")).alias("key"), "id"
    )
    kept = keep_first(df, ["key"], ["id"])
    assert kept.count() == df.select("key").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_position_names(spark):
    raw = raw_frame(spark, ("M", document([
        participant(i, teamPosition=p) for i, p in enumerate(["MIDDLE", "UTILITY", "TOP", "", None])
    ])))
    flat = flatten_matches(raw)
    assert rows(flat, "puuid", "team_position") == [
        ("player-0", "MID"), ("player-1", "SUPPORT"), ("player-2", "TOP"), ("player-3", ""), ("player-4", None),
    ]
    again = spark.createDataFrame([("UTILITY", "MIDDLE", 1)], "team_position STRING, main_position STRING, n INT")
    assert normalize_position_columns(again).collect()[0] == ("SUPPORT", "MID", 1)


def test_timestamp_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        flat = flatten_matches(raw_frame(spark, ("M", document([participant(0)], gameEndTimestamp=1700000000123))))
        assert flat.collect()[0].game_date == datetime.datetime(2023, 11, 14, 22, 13, 20, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_each_document_is_parsed_once(spark):
    plan = flatten_matches(raw_frame(spark, ("M", document())))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") <= 3  # the strict test, typed, and the fallback for odd documents


def test_stored_documents_give_the_same_rows(spark, tmp_path):
    """Documents kept as VARIANT against their text, under several field maps."""
    people = [
        participant(0, championId="222", deaths=2.0, assists="many", win="true"), None, {},
        participant(1, kills=7.5, challenges={"kda": 4.5, "it's": {"a b": 1}}), participant(2, puuid=None, challenges=None)]
    good = document(people)
    bad = ["NOT_JSON{{{{", "[]", None, good[:-40], good + " x", '"info"', good + good, f"{good},{good}", good.replace('"', "'"), ""]
    bad += [document([participant(0), 5]), document(["text"]), document([[1]])]
    odd = [good[:-1] + ', "x": 1, "x": NaN}', f" {good}\n", '{"info": {}}', '{"info": {"participants": 3}}', '{"info": null}', "{}"]
    raw = raw_frame(spark, *[(f"M{i}", text) for i, text in enumerate([good, document(), *bad, *odd])])
    documents.parsed(raw).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    assert stored.filter("odd IS NOT NULL").count() == 1
    nested = {"id": "__match_id__", "kda": "challenges.kda", "odd": "challenges.it's.a b", "mode": "__game_mode__", "no": "a.b"}
    for fields, types in ((schema.DEFAULT_FIELD_MAP, {}), (nested, {"kda": "double", "odd": "bigint"})):
        want = flatten_matches(raw, fields, types=types, deduplicate=False)
        got = flatten_matches(stored, fields, types=types, deduplicate=False, parse=documents.read_documents)
        assert got.schema == want.schema and rows(got, *fields) == rows(want, *fields)


def test_narrow_deduplication_equals_the_wide_one(spark):
    texts = [document([participant(i % 4, kills=k), participant(0, puuid=None, kills=k)]) for k, i in enumerate((0, 1, 0, 2, 1, 3))]
    raw = raw_frame(spark, *[(None if k == 5 else f"M{k % 2}", t) for k, t in enumerate(texts)]).withColumn("place", -F.monotonically_increasing_id())
    got, want = flatten_first(raw, first_by=["place"]), flatten_matches(raw, first_by=["place"])
    assert rows(got, *got.columns) == rows(want, *want.columns) and got.count() == 8
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan


def test_reads_like_json_dumps(spark):
    text = json.dumps({"info": {"participants": [participant(0, riotIdGameName="Ünïcode \"quoted\"")]}}, ensure_ascii=False)
    assert flatten_matches(raw_frame(spark, ("M", text))).collect()[0].summoner_name == 'Ünïcode "quoted"'


def test_text_behind_the_object_is_refused(spark):
    """A bracket closes the list that a text is tested in, but not the text."""
    good = document([participant(0)])
    texts = [good + "]", good + "] x", f" {good} ]", good + "\n"]
    raw = raw_frame(spark, *[(f"M{i}", text) for i, text in enumerate(texts)])
    assert [r.match_id for r in flatten_matches(raw).collect()] == ["M3"]
    assert corrupt_matches(raw).count() == 3
    stored = documents.parsed(raw)
    assert [r.match_id for r in flatten_matches(stored, parse=documents.read_documents).collect()] == ["M3"]


def test_good_documents_are_parsed_by_one_parser(spark):
    """The strict test by itself is only for documents that the typed parse does not settle."""
    plan = flatten_matches(raw_frame(spark, ("M", document())))._jdf.queryExecution().optimizedPlan().toString()
    alone = [line for line in plan.splitlines() if "_none,StringType" in line]
    assert alone and not [line for line in alone if line.strip(" :+-").startswith("Filter")]


def test_stored_documents_are_parsed_once(spark):
    plan = documents.parsed(raw_frame(spark, ("M", document())))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_known_pairs_are_left_out(spark):
    raw = raw_frame(spark, ("A", document([participant(i) for i in range(3)])), (None, document([participant(0, puuid=None)])))
    known = spark.createDataFrame([("A", "player-1"), (None, None), ("B", "player-0")], "m STRING, p STRING")
    got = flatten_first(raw.withColumn("place", F.lit(0)), first_by=["place"], known=known)
    assert sorted((r.match_id, r.puuid) for r in got.collect()) == [("A", "player-0"), ("A", "player-2")]


def test_a_filter_on_the_match_parses_no_text_again(spark):
    texts = [document([participant(i)], queueId=q) for i, q in enumerate((420, 440, None, "420"))]
    raw = raw_frame(spark, *[(f"M{i}", text) for i, text in enumerate(texts)])
    fields = {"puuid": "puuid", "queue_id": "__queue_id__", "mode": "__game_mode__"}
    flat = flatten_matches(raw, fields, deduplicate=False)
    asked = in_queue(flat, 420).filter("mode = 'CLASSIC'")
    assert sorted(r.puuid for r in asked.collect()) == ["player-0", "player-2", "player-3"]
    parsers = [df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") for df in (flat, asked)]
    assert parsers[0] == parsers[1]


def test_copies_of_all_kinds_against_plain_python(spark):
    """Keys with one, two and very many copies, null ones, over several tasks, against a loop over the records."""
    records = []
    for i in range(300):
        match = None if i % 50 == 7 else f"M{i if i % 3 else i % 9}"
        people = [(None if (i + k) % 11 == 0 else f"p{(i + k) % 4}", 1000 * i + k) for k in range(3)]
        records.append((match, i * 7919 % 1009 // 2, people))
    raw = spark.createDataFrame(
        [(m, document([participant(0, puuid=p, kills=kills) for p, kills in people]), place) for m, place, people in records],
        "match_id STRING, _raw_json STRING, place INT").repartition(7)
    first = {}
    for match, place, people in records:
        for at, (player, kills) in enumerate(people):
            found = first.setdefault((match, player), (place, at, {kills}))
            if (place, at) < found[:2]:
                first[match, player] = (place, at, {kills})
            elif (place, at) == found[:2]:  # a tie of records: either
                found[2].add(kills)
    for fields in ({"m": "__match_id__", "p": "puuid", "kills": "kills"}, {"m": "__match_id__", "p": "puuid", "kills": "kills", "place": "x.y"}):
        for flat in (flatten_first(raw, fields, first_by=["place"]), flatten_matches(raw, fields, first_by=["place"])):
            got = flat.collect()
            assert len(got) == len(first) and all(r.kills in first[r.m, r.p][2] for r in got)
    # keys that the fact does not hold, or not as text
    for fields, types in (({"kills": "kills"}, {}), ({"kills": "kills", "p": "puuid"}, {"p": "int"})):
        assert flatten_first(raw, fields, types=types, first_by=["place"]).count() == len(first)


def test_no_row_of_the_fact_is_shuffled_for_its_copies(spark):
    """However many the copies are: what is dealt out are the lists of their places."""
    raw = raw_frame(spark, ("M", document()), ("M", document()), ("N", document())).withColumn("place", F.lit(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for flat in (flatten_first(raw, first_by=["place"]), flatten_matches(raw, first_by=["place"])):
            plan = flat._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.splitlines() if "Exchange " in line]
            assert len(exchanges) == 1 and "hashpartitioning(__task" in exchanges[0] and "Bucketed: true" in plan
            assert not [word for word in ("Sort ", "SortMergeJoin", "Window") if word in plan]
            assert flat.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_at_places(spark):
    rows = stage_with_places(spark.range(0, 1000, numPartitions=3), "numbers")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("numbers_")]
    for wanted in ([], [0], [999], [5, 5, 63, 64, 333, 334, 700], list(range(1000))):
        places = rows.filter(F.col("id").isin(wanted)).select(PLACE)
        places = places.unionByName(places)
        inside, outside = at_places(rows, places), at_places(rows, places, inside=False)
        assert inside.columns == ["id", TASK, PLACE]
        assert sorted(r.id for r in inside.collect()) == sorted(set(wanted))
        assert sorted(r.id for r in outside.collect()) == sorted(set(range(1000)) - set(wanted))
