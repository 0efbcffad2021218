"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.functions.numeric import round_to, text_to_bigint
from matchforge.operators import flatten, graph, incremental, quality
from matchforge.operators.recent import recent_matches
from matchforge.plans import champions, lineups, mart_store, marts, pipeline, players, reports, timeline, views
from matchforge.session import stage, work_folder
from matchforge.sources import catalog, dictionaries, documents, ledger, raw, tables
from matchforge.sources import players as players_source
from matchforge.streaming.flatten_stream import BATCH, flatten_landed_chunks
from registry import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles whose last digits depend on the order of summation."""
    return df.withColumns({c: round_to(F.col(c), digits) for c in columns})


# --- marts ------------------------------------------------------------------

@register
def mart_player_stats(spark, sf_dir):
    return marts.player_stats(b.participants(spark, sf_dir, *b.PLAYER_FACT))


@register
def mart_player_champion_stats(spark, sf_dir):
    return marts.player_champion_stats(b.participants(spark, sf_dir, *b.PLAYER_CHAMPION_FACT))


@register
def mart_champion_stats(spark, sf_dir):
    return marts.champion_stats(b.participants(spark, sf_dir, *b.CHAMPION_FACT))


@register
def mart_position_stats(spark, sf_dir):
    return marts.position_stats(b.participants(spark, sf_dir, *b.POSITION_FACT))


@register
def mart_match_timeline(spark, sf_dir):
    return marts.match_timeline(b.participants(spark, sf_dir, *b.DAY_FACT))


@register
def mart_item_popularity(spark, sf_dir):
    return marts.item_popularity(b.participants(spark, sf_dir, *b.ITEM_FACT), b.items(spark, sf_dir))


# The four marts that the pipeline merges from one staged pass over the fact.

@register
def merged_player_stats(spark, sf_dir):
    return _marts(spark, sf_dir, "player_stats")[0]


@register
def merged_player_champion_stats(spark, sf_dir):
    return _marts(spark, sf_dir, "player_champion_stats")[0]


@register
def merged_champion_stats(spark, sf_dir):
    return _marts(spark, sf_dir, "champion_stats")[0]


@register
def merged_position_stats(spark, sf_dir):
    return _marts(spark, sf_dir, "position_stats")[0]


@register
def marts_read_back(spark, sf_dir):
    """The champion mart replaced twice, read with the mart reader and through its view."""
    folder = work_folder(spark, "marts")
    for _ in range(2):
        tables.write_mart(mart_champion_stats(spark, sf_dir), folder, "mart_champion_stats")
    tables.publish_views(tables.read_marts(spark, folder))
    return spark.table("vw_meta_champions")


# The marts of a store that is filled by two loads, the second one repeated.

def _mart_store(spark, sf_dir):
    """All but the later lines of the last years first, then those: some periods are met twice."""
    store = mart_store.MartStore(spark, work_folder(spark, "mart_store"), period="yyyy")
    fact = b.participants(spark, sf_dir)
    late = F.coalesce((F.year("game_date") >= 1997) & (F.col("item3") > 3), F.lit(False))
    store.add("first", fact.filter(~late))
    for _ in range(2):
        store.add("second", fact.filter(late))
    return store.marts(b.items(spark, sf_dir))


@register
def incremental_player_stats(spark, sf_dir):
    return _mart_store(spark, sf_dir)["mart_player_stats"]


@register
def incremental_champion_stats(spark, sf_dir):
    return _mart_store(spark, sf_dir)["mart_champion_stats"]


@register
def incremental_match_timeline(spark, sf_dir):
    return _mart_store(spark, sf_dir)["mart_match_timeline"]


@register
def incremental_item_popularity(spark, sf_dir):
    return _mart_store(spark, sf_dir)["mart_item_popularity"]


def _loaded_marts(spark, sf_dir):
    """Marts over two appends of raw records, the second one repeated, put through the pipeline's load step."""
    folder = work_folder(spark, "loaded")
    for load in _two_loads(spark, sf_dir):
        chunks = raw.append_raw_matches(load, folder)
        marts_ = pipeline.add_load(spark, folder, chunks, f"{folder}/store", period="yyyy")
    return pipeline.add_load(spark, folder, chunks, f"{folder}/store", period="yyyy") or marts_


@register
def loaded_player_stats(spark, sf_dir):
    return _loaded_marts(spark, sf_dir)["mart_player_stats"]


# Marts and views in a database of the catalog, published twice.

def _catalog(spark, sf_dir):
    folder = work_folder(spark, "catalog")
    found = catalog.Catalog(spark, f"marts_{folder[-32:]}", folder)
    marts_ = {"mart_player_stats": mart_player_stats(spark, sf_dir), "mart_match_timeline": mart_match_timeline(spark, sf_dir)}
    for _ in range(2):
        found.publish_marts(marts_)
    return found


@register
def catalog_names(spark, sf_dir):
    """What a probe of the catalog finds, with the rows behind each name."""
    found = _catalog(spark, sf_dir)
    counted = [found.read(name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")) for name in found.found("%")]
    return reduce(DataFrame.unionByName, counted)


@register
def catalog_top_players(spark, sf_dir):
    return _catalog(spark, sf_dir).read("vw_top_players")


# --- views over stored marts --------------------------------------------------

def stored(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written as a table first, as the views and reports read it."""
    return stage(query(spark, sf_dir), query.__name__)


@register
def vw_top_players(spark, sf_dir):
    return views.top_players(stored(mart_player_stats, spark, sf_dir))


@register
def vw_meta_champions(spark, sf_dir):
    return views.meta_champions(mart_champion_stats(spark, sf_dir))


@register
def vw_item_efficiency(spark, sf_dir):
    return views.item_efficiency(stored(mart_item_popularity, spark, sf_dir))


@register
def vw_position_overview(spark, sf_dir):
    return views.position_overview(mart_position_stats(spark, sf_dir))


@register
def vw_timeline_trends(spark, sf_dir):
    return rounded(
        views.timeline_trends(mart_match_timeline(spark, sf_dir)), "damage_ma7", "duration_ma7"
    )


# --- flattening and landing -----------------------------------------------------

# A field map with nested paths next to the match-level ones.
NESTED_FIELDS = {
    "match_id": "__match_id__",
    "game_mode": "__game_mode__",
    "puuid": "puuid",
    "kda": "challenges.kda",
    "first_streak": "challenges.streak.first",
    "absent": "challenges.nothing.here",
    "team_position": "teamPosition",
}


def _landed(spark, sf_dir):
    """The raw records written as landed files first, as the flattening finds them."""
    return stage(b.raw_matches(spark, sf_dir), "raw")


@register
def flatten_matches(spark, sf_dir):
    return flatten.flatten_matches(_landed(spark, sf_dir), deduplicate=False)


@register
def flatten_dedup(spark, sf_dir):
    return flatten.flatten_matches(_landed(spark, sf_dir), first_by=b.RAW_ORDER)


@register
def flatten_dedup_narrow(spark, sf_dir):
    """The same without a whole row in a shuffle, as the pipeline does it."""
    return flatten.flatten_first(_landed(spark, sf_dir), first_by=b.RAW_ORDER)


def _two_loads(spark, sf_dir):
    """The raw records in two loads, each in order: lines 1 to 3 of the orders, then the rest."""
    early = F.col("l_linenumber") <= 3
    return [b.raw_matches(spark, sf_dir, part=part, ordered=True) for part in (early, ~early)]


@register
def flatten_two_loads(spark, sf_dir):
    """Two appends, read back as landed chunks and put through the pipeline's own step."""
    folder = work_folder(spark, "loads")
    for load in _two_loads(spark, sf_dir):
        raw.append_raw_matches(load, folder)
    pipeline.transform_matches(spark, folder, f"{folder}/processed")
    return tables.read_processed(spark, f"{folder}/processed")["matches"]


@register
def stream_two_loads(spark, sf_dir):
    """The fact after a stream run behind each of two appends, and one that finds nothing new."""
    folder = work_folder(spark, "stream")
    for load in [*_two_loads(spark, sf_dir), None]:
        if load is not None:
            raw.append_raw_matches(load, folder)
        flatten_landed_chunks(spark, folder, f"{folder}/fact", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/fact").drop(BATCH)


@register
def ledger_lookup(spark, sf_dir):
    """Participants of the 100 dearest matches, each from the record that landed first, found by the ledger."""
    folder = work_folder(spark, "ledger")
    keys = ledger.Ledger(spark, f"{folder}/keys")
    for load in _two_loads(spark, sf_dir):
        keys.grow(raw.read_raw_matches(spark, folder, raw.append_raw_matches(load, folder)))
    dearest = b.read(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    found = keys.first_records(raw.read_raw_matches(spark, folder), dearest.select(F.expr("'M' || o_orderkey").alias("match_id")))
    return flatten.flatten_matches(found, deduplicate=False)


@register
def flatten_typed_fields(spark, sf_dir):
    """Fields beyond the known ones, with types of their own."""
    types = {"kda": "double", "first_streak": "bigint"}
    return flatten.flatten_first(_landed(spark, sf_dir), NESTED_FIELDS, types=types, first_by=b.RAW_ORDER)


def _documents(spark, sf_dir):
    """The raw records parsed once and stored as VARIANT."""
    return stage(documents.parsed(b.raw_matches(spark, sf_dir), *b.RAW_ORDER), "documents")


@register
def variant_matches(spark, sf_dir):
    return flatten.flatten_first(_documents(spark, sf_dir), first_by=b.RAW_ORDER, parse=documents.read_documents)


@register
def variant_typed_fields(spark, sf_dir):
    """Another field map read from the same stored form."""
    types = {"kda": "double", "first_streak": "bigint"}
    return flatten.flatten_first(
        _documents(spark, sf_dir), NESTED_FIELDS, types=types, first_by=b.RAW_ORDER, parse=documents.read_documents)


@register
def recent_matches_of_queue(spark, sf_dir):
    """The three latest ranked matches of each player, from the documents."""
    fields = {"match_id": "__match_id__", "puuid": "puuid", "game_date": "__game_date__", "queue_id": "__queue_id__"}
    met = flatten.flatten_matches(_landed(spark, sf_dir), fields, deduplicate=False)
    return recent_matches(met, 3, schema.QUEUE_IDS["RANKED_SOLO_5x5"])


@register
def flatten_nested_fields(spark, sf_dir):
    return flatten.flatten_first(_landed(spark, sf_dir), NESTED_FIELDS, first_by=b.RAW_ORDER)


@register
def corrupt_matches(spark, sf_dir):
    bad = flatten.corrupt_matches(_landed(spark, sf_dir))
    return bad.groupBy("match_id").agg(F.count(F.lit(1)).alias("records"))


@register
def json_path_projection(spark, sf_dir):
    text = F.get_json_object("props", "$.k")
    return b.read(spark, sf_dir, "events").select(
        "event_id", text_to_bigint(text).alias("k"), F.get_json_object("props", "$.a.b").alias("missing")
    )


@register
def incremental_new_matches(spark, sf_dir):
    return incremental.new_matches(
        b.fetched_matches(spark, sf_dir), b.matches_with_status(spark, sf_dir, "F"), first_by=b.RAW_ORDER
    )


@register
def landed_match_lookup(spark, sf_dir):
    return incremental.landed_matches(
        b.fetched_matches(spark, sf_dir), b.matches_with_status(spark, sf_dir, "P"), first_by=b.RAW_ORDER
    )


@register
def landed_match_ids(spark, sf_dir):
    return incremental.landed_keys(b.fetched_matches(spark, sf_dir))


@register
def recent_matches_per_player(spark, sf_dir):
    return recent_matches(b.participants(spark, sf_dir, "match_id", "puuid", "game_date"), 5)


def _league(spark, sf_dir):
    return players_source.league_entries(
        b.league_documents(spark, sf_dir), league="challenger", queue="RANKED_SOLO_5x5", region="euw1"
    )


@register
def league_entries(spark, sf_dir):
    raw = F.get_json_object("_raw_json", "$.summonerId").alias("raw_summoner")
    return _league(spark, sf_dir).select(
        "puuid", "summonerId", "summonerName", "leaguePoints", "wins", "losses", "veteran",
        "_tier", "_queue", "_region", raw,
    )


@register
def fill_missing_puuid(spark, sf_dir):
    filled = players_source.fill_missing_puuid(_league(spark, sf_dir), b.summoners(spark, sf_dir))
    return filled.select("summonerId", "puuid")


@register
def player_winrate(spark, sf_dir):
    return players_source.player_dimension(_league(spark, sf_dir)).select(
        "summonerId", "summonerName", "wins", "losses", "winrate", "_tier"
    )


@register
def player_relational_form(spark, sf_dir):
    dimension = players_source.player_dimension(_league(spark, sf_dir))
    return players_source.relational_form(dimension, "players").drop("winrate")


@register
def players_table(spark, sf_dir):
    """Landed players through the pipeline's step and the reader of processed tables."""
    folder = work_folder(spark, "players")
    _league(spark, sf_dir).drop("_raw_json").write.parquet(f"{folder}/players/players.parquet")
    pipeline.transform_players(spark, folder, f"{folder}/processed")
    processed = tables.read_processed(spark, f"{folder}/processed")["players"]
    return processed.select("summonerId", "summonerName", "wins", "losses", "winrate", "_tier")


@register
def flatten_champion_dictionary(spark, sf_dir):
    return dictionaries.champions(b.champion_documents(spark, sf_dir))


@register
def flatten_item_dictionary(spark, sf_dir):
    return dictionaries.items(b.item_documents(spark, sf_dir))


def _from_files(spark, sf_dir, name):
    """A dictionary written as files and put through the pipeline's step and the reader."""
    folder = work_folder(spark, "dictionaries")
    b.dictionary_files(spark, sf_dir, folder)
    pipeline.transform_dictionaries(spark, folder, f"{folder}/processed")
    return tables.read_processed(spark, f"{folder}/processed")[name]


@register
def champion_dictionary_files(spark, sf_dir):
    return _from_files(spark, sf_dir, "champions")


@register
def item_dictionary_files(spark, sf_dir):
    return _from_files(spark, sf_dir, "items")


@register
def refreshed_positions(spark, sf_dir):
    """The position mart with its load time, as stored: whether rows have it, and how many times there are."""
    rows = stage(tables.with_refresh_time(mart_position_stats(spark, sf_dir)), "refreshed")
    times = rows.agg(F.countDistinct("refreshed_at")).scalar()
    past = F.col("refreshed_at") <= F.current_timestamp()
    return rows.select("team_position", "total_games", past.alias("stamped"), times.alias("times"))


@register
def dq_report(spark, sf_dir):
    return quality.quality_checks(b.flawed_fact(spark, sf_dir), "matches")


@register
def dq_summary(spark, sf_dir):
    summary = quality.quality_summary(b.flawed_fact(spark, sf_dir), "matches")
    return summary.withColumns({c: F.array_join(c, " ") for c in ("failed", "doubtful")})


@register
def dq_empty_table(spark, sf_dir):
    nothing = b.flawed_fact(spark, sf_dir).filter(F.col("kills") < -1000)
    return quality.quality_checks(nothing, "matches")


@register
def expand_players(spark, sf_dir):
    return graph.expand_players(
        b.seed_players(spark, sf_dir), b.part_players(spark, sf_dir), b.profiles(spark, sf_dir),
        depth=3, matches_per_player=2, queue="RANKED_SOLO_5x5", region="euw1",
    )


# --- reports ----------------------------------------------------------------------

def _marts(spark, sf_dir, *names):
    """Stored marts merged from one staged pass over the fact, as the pipeline builds them."""
    fact = b.participants(spark, sf_dir, *b.PLAYER_FACT)
    cells = stage(marts.mart_cells(fact), "cells")
    return [stage(getattr(marts, name)(fact, cells), name) for name in names]


def _champions(spark, sf_dir):
    return stored(mart_champion_stats, spark, sf_dir)


def _players(spark, sf_dir):
    return stored(mart_player_stats, spark, sf_dir)


def _positions(spark, sf_dir):
    return stored(mart_position_stats, spark, sf_dir)


def _timeline(spark, sf_dir):
    return stored(mart_match_timeline, spark, sf_dir)


def _player_champions(spark, sf_dir):
    return stored(mart_player_champion_stats, spark, sf_dir)


@register
def meta_tiers(spark, sf_dir):
    return champions.meta_tiers(_champions(spark, sf_dir)).select(
        "champion_name", "team_position", "picks", "winrate_pct", "tier"
    )


@register
def tier_counts(spark, sf_dir):
    return champions.tier_counts(champions.tier_list(champions.meta_tiers(_champions(spark, sf_dir))))


@register
def strongest_champions(spark, sf_dir):
    return champions.strongest(champions.meta_tiers(_champions(spark, sf_dir)))


@register
def wr_anomalies(spark, sf_dir):
    found = champions.winrate_anomalies(_champions(spark, sf_dir))
    return rounded(found, "z_score").select(
        "champion_name", "team_position", "picks", "winrate_pct", "z_score", "direction"
    )


@register
def pick_quadrants(spark, sf_dir):
    return champions.pick_quadrants(champions.meta_tiers(_champions(spark, sf_dir)))


@register
def champion_bars(spark, sf_dir):
    return champions.champion_bars(_champions(spark, sf_dir))


@register
def lineup_candidates(spark, sf_dir):
    return champions.lineup_candidates(mart_champion_stats(spark, sf_dir))


@register
def champion_table(spark, sf_dir):
    return champions.champion_table(mart_champion_stats(spark, sf_dir))


@register
def player_outliers(spark, sf_dir):
    return rounded(players.player_outliers(_players(spark, sf_dir)), "kda_z", "wr_z", "gap")


@register
def outlier_cards(spark, sf_dir):
    cards = players.outlier_cards(players.player_outliers(_players(spark, sf_dir)))
    return rounded(cards, "kda_z", "wr_z", "gap")


@register
def avg_rank_gap(spark, sf_dir):
    return players.rank_gap(_players(spark, sf_dir)).select(
        "puuid", "summoner_name", "avg_kda", "winrate_pct", "kda_rank", "wr_rank", "gap"
    )


@register
def player_flags(spark, sf_dir):
    return players.player_flags(mart_player_stats(spark, sf_dir))


@register
def marker_sizes(spark, sf_dir):
    return players.marker_sizes(_players(spark, sf_dir))


@register
def one_player(spark, sf_dir):
    return players.one_player(mart_player_champion_stats(spark, sf_dir), puuid="7").select(
        "puuid", "champion_name", "team_position", "games_played")


@register
def player_table(spark, sf_dir):
    return players.player_table(mart_player_stats(spark, sf_dir))


@register
def top_champions_per_player(spark, sf_dir):
    top = players.champion_pools(mart_player_champion_stats(spark, sf_dir))
    return rounded(top, "share_pct").select(
        "puuid", "champion_name", "team_position", "games_played", "winrate_pct", "avg_kda",
        "place", "share_pct", "favour",
    )


@register
def player_style(spark, sf_dir):
    return players.player_styles(players.top_champions(mart_player_champion_stats(spark, sf_dir)))


@register
def recommend_champions(spark, sf_dir):
    found = players.recommend_champions(*_marts(spark, sf_dir, "player_stats", "champion_stats"))
    return rounded(found, "fit_score")


def _picks(spark, sf_dir):
    return lineups.lineup_picks(
        b.lineups(spark, sf_dir), *_marts(spark, sf_dir, "champion_stats", "position_stats")
    )


@register
def lineup_breakdown(spark, sf_dir):
    return lineups.lineup_breakdown(_picks(spark, sf_dir))


@register
def predict_lineup_winrate(spark, sf_dir):
    return lineups.predict_lineups(_picks(spark, sf_dir))


@register
def timeline_anomalies(spark, sf_dir):
    return rounded(timeline.timeline_anomalies(_timeline(spark, sf_dir), "avg_damage"), "ma7")


@register
def timeline_anomalies_duration(spark, sf_dir):
    return rounded(timeline.timeline_anomalies(_timeline(spark, sf_dir), "avg_duration_min"), "ma7")


@register
def period_delta(spark, sf_dir):
    days = _timeline(spark, sf_dir)
    every = [timeline.period_delta(days, metric) for metric in timeline.METRICS]
    return rounded(reduce(DataFrame.unionByName, every), "early", "late", "delta_pct")


@register
def position_radar(spark, sf_dir):
    scaled = reports.position_radar(_positions(spark, sf_dir))
    return rounded(scaled, *reports.RADAR_METRICS)


@register
def item_report(spark, sf_dir):
    bought = tables.item_report(mart_item_popularity(spark, sf_dir))
    return bought.withColumn("favour", champions.favour(F.col("winrate_pct")))


@register
def action_plan(spark, sf_dir):
    plan = reports.action_plan(*_marts(spark, sf_dir, "champion_stats", "player_stats", "position_stats"))
    return rounded(plan, "gap")


@register
def insights(spark, sf_dir):
    found = reports.insights(
        *_marts(spark, sf_dir, "champion_stats", "player_stats", "position_stats"), _timeline(spark, sf_dir)
    )
    return rounded(found, "value")


@register
def balance_by_position(spark, sf_dir):
    return reports.balance_by_position(_champions(spark, sf_dir))


@register
def balance_health(spark, sf_dir):
    health = reports.balance_health(*_marts(spark, sf_dir, "champion_stats", "player_stats", "position_stats"))
    return rounded(health, "mean_winrate_pct")


# --- the same over the varied reading -------------------------------------------------

# Queries whose thresholds, classes and fallbacks the plain reading does not all reach.
VARIED = (
    "mart_player_stats", "mart_champion_stats", "mart_item_popularity", "merged_player_champion_stats",
    "vw_top_players", "vw_meta_champions", "vw_item_efficiency", "meta_tiers", "tier_counts",
    "wr_anomalies", "pick_quadrants", "champion_bars", "player_outliers", "avg_rank_gap", "player_flags",
    "marker_sizes", "top_champions_per_player", "player_style", "recommend_champions", "lineup_breakdown",
    "predict_lineup_winrate", "period_delta", "item_report", "action_plan", "insights", "balance_health", "balance_by_position",
)


def _over_varied(query: Query) -> Query:
    def run(spark, sf_dir):
        with b.varied_reading():
            return query(spark, sf_dir)

    run.__name__ = f"{query.__name__}_varied"
    return run


for _name in VARIED:
    register(_over_varied(QUERIES[_name]))
