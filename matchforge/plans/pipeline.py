"""The batch pipeline: raw files to processed tables, checks, marts and views."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.operators.flatten import flatten_first
from matchforge.operators.graph import expand_players
from matchforge.operators.quality import quality_summary
from matchforge.plans import marts
from matchforge.plans.mart_store import MONTH, MartStore
from matchforge.session import stage, staged_run
from matchforge.sources import dictionaries
from matchforge.sources.players import player_dimension
from matchforge.sources.raw import FILE_ORDER, read_parquet_if_present, read_raw_matches
from matchforge.sources.relational import Database, load_marts, load_processed
from matchforge.sources.tables import (
    overwrite_table, publish_views, read_marts, read_processed, replace_dataset, write_mart,
)

log = logging.getLogger(__name__)


# Fields the player graph needs, whatever the fact's own map selects.
EDGE_FIELDS = {
    "match_id": schema.MATCH_ID_PATH, "puuid": "puuid",
    "game_date": schema.DEFAULT_FIELD_MAP["game_date"], "queue_id": "__queue_id__",
    "gameName": "riotIdGameName", "tagLine": "riotIdTagline",
}
_EDGE = "__edge_"


def landed_participants(
    spark: SparkSession, raw_dir: str, field_map: Mapping[str, str], types: Mapping[str, str], *, edges: bool
) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of the fact and, if asked for, what the player graph needs, from one parse of the documents."""
    raw = read_raw_matches(spark, raw_dir)
    if raw is None or not (field_map or edges):
        return None, None
    wanted = dict(field_map)
    if edges:
        wanted |= {f"{_EDGE}{name}": path for name, path in EDGE_FIELDS.items()}
        dates = {f"{_EDGE}game_date": "bigint", f"{_EDGE}queue_id": "bigint"}
        types = {**types, **dates}
    rows = flatten_first(raw, wanted, types=types, first_by=FILE_ORDER)
    if not edges:
        return rows, None
    rows = stage(rows, "participants")
    return (
        rows.select(*field_map) if field_map else None,
        rows.select(*[F.col(f"{_EDGE}{name}").alias(name) for name in EDGE_FIELDS]))


def transform_matches(
    spark: SparkSession, raw_dir: str, processed_dir: str,
    field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    types: Mapping[str, str] = MappingProxyType({}),
    rows: DataFrame | None = None,
) -> bool:
    """Raw chunks to the participant fact, first occurrence in file order kept.

    ``types`` names the SQL types of added fields; without one they are text. ``rows`` are
    the participants if they are already parsed.
    """
    if rows is None:
        rows, _ = landed_participants(spark, raw_dir, field_map, types, edges=False)
    if rows is None or not field_map:
        log.warning("no raw matches or no field map; the fact is left as it is")
        return False
    return overwrite_table(rows, f"{processed_dir}/matches.parquet")


def expand_raw_players(
    spark: SparkSession, raw_dir: str, *, depth: int, matches_per_player: int, queue: str, region: str,
    met: DataFrame | None = None,
) -> bool:
    """Add to the landed players those met within ``depth - 1`` steps in the landed matches of the queue.

    Names are the ones the matches give; of several the smallest. ``met`` are the fields of
    ``EDGE_FIELDS`` if they are already parsed.
    """
    path = f"{raw_dir}/players/players.parquet"
    seed = read_parquet_if_present(spark, path)
    if seed is None or depth <= 1 or "puuid" not in seed.columns:
        return False
    if met is None:
        _, met = landed_participants(spark, raw_dir, {}, {}, edges=True)
    if met is None:
        return False
    if "_graph_level" in seed.columns:  # players of an earlier expansion are found again
        seed = seed.filter(F.col("_graph_level").isNull()).drop("_graph_level")
    profiles = met.groupBy("puuid").agg(F.min("gameName").alias("gameName"), F.min("tagLine").alias("tagLine"))
    replace_dataset(
        expand_players(
            seed, met, profiles, depth=depth, matches_per_player=matches_per_player, queue=queue, region=region,
            queue_id=schema.QUEUE_IDS.get(queue),
        ),
        path,
    )
    return True


def transform_players(spark: SparkSession, raw_dir: str, processed_dir: str) -> bool:
    raw = read_parquet_if_present(spark, f"{raw_dir}/players/players.parquet")
    if raw is None:
        return False
    replace_dataset(player_dimension(raw), f"{processed_dir}/players.parquet")
    return True


def transform_dictionaries(spark: SparkSession, raw_dir: str, processed_dir: str) -> list[str]:
    """Champion and item dictionaries; returns the tables written."""
    written = []
    for name, flatten in (("champions", dictionaries.champions), ("items", dictionaries.items)):
        documents = dictionaries.read_documents(spark, f"{raw_dir}/static/{name}.json")
        if documents is not None:
            replace_dataset(flatten(documents), f"{processed_dir}/{name}.parquet")
            written.append(name)
    return written


def check_quality(tables: Mapping[str, DataFrame]) -> dict[str, tuple[list[str], list[str]]]:
    """Failed and doubtful checks of every table; they are logged and do not stop the run."""
    found = {}
    for name, df in tables.items():
        row = quality_summary(df, name).first()
        found[name] = row["failed"], row["doubtful"]
        log.log(logging.WARNING if row["failed"] else logging.INFO, "%s: failed %s, doubtful %s", name, *found[name])
    return found


def build_marts(tables: Mapping[str, DataFrame], marts_dir: str) -> list[str]:
    """All marts the processed tables allow; returns their names.

    Four marts are merged from one staged pass over the fact instead of
    scanning it once each.
    """
    fact = tables.get("matches")
    if fact is None:
        log.warning("no participant fact; marts are not built")
        return []
    cells = stage(marts.mart_cells(fact), "cells")
    built = {
        "mart_player_stats": marts.player_stats(fact, cells),
        "mart_player_champion_stats": marts.player_champion_stats(fact, cells),
        "mart_champion_stats": marts.champion_stats(fact, cells),
        "mart_match_timeline": marts.match_timeline(fact),
        "mart_position_stats": marts.position_stats(fact, cells),
    }
    if "items" in tables:
        built["mart_item_popularity"] = marts.item_popularity(fact, tables["items"])
    for name, mart in built.items():
        write_mart(mart, marts_dir, name)
    return list(built)


def add_load(
    spark: SparkSession, raw_dir: str, chunks: str, store_dir: str, items: DataFrame | None = None,
    *, field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP, types: Mapping[str, str] = MappingProxyType({}),
    period: str = MONTH,
) -> dict[str, DataFrame]:
    """Bring one append of raw chunks into a mart store and return the marts of all loads so far.

    Only the chunks of the append are parsed, and only the periods it touches are aggregated.
    ``chunks`` is the path that the append returned; the same path again replaces its own rows.
    """
    store, load = MartStore(spark, store_dir, period), chunks.rstrip("/").rpartition("/")[2]
    raw = read_raw_matches(spark, raw_dir, chunks)
    if raw is not None:
        # where the fact's keys are those of the documents, pairs of other loads go with the later copies
        keys = {"match_id": schema.MATCH_ID_PATH, "puuid": "puuid"}
        alike = all(field_map.get(name) == path and name not in types for name, path in keys.items())
        known = store.known(load, raw) if alike else None
        rows = flatten_first(raw, field_map, types=types, first_by=FILE_ORDER, known=known)
        store.add(load, rows if alike else store.without_known(load, rows), staged=alike)
    return store.marts(items)


def run(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    marts_dir: str,
    *,
    field_map: Mapping[str, str] = schema.DEFAULT_FIELD_MAP,
    types: Mapping[str, str] = MappingProxyType({}),
    depth: int = 1,
    matches_per_player: int = 20,
    queue: str = "RANKED_SOLO_5x5",
    region: str = "euw1",
    skip_transform: bool = False,
    skip_quality: bool = False,
    skip_marts: bool = False,
    database: Database | None = None,
) -> dict[str, DataFrame]:
    """Run the stages in order and return the marts.

    Stages hand over through files, so any of them can be skipped when its
    output is already there. With a ``depth`` above 1 the landed players are first
    expanded along the landed matches. Tables staged on the way are deleted.
    """
    with staged_run(spark):
        if not skip_transform:
            rows, met = landed_participants(spark, raw_dir, field_map, types, edges=depth > 1)
            expand_raw_players(
                spark, raw_dir, depth=depth, matches_per_player=matches_per_player, queue=queue, region=region, met=met)
            transform_matches(spark, raw_dir, processed_dir, field_map, types, rows)
            transform_players(spark, raw_dir, processed_dir)
            transform_dictionaries(spark, raw_dir, processed_dir)
        tables = read_processed(spark, processed_dir)
        if not skip_quality:
            check_quality(tables)
        if not skip_marts:
            build_marts(tables, marts_dir)
    ready = read_marts(spark, marts_dir)
    publish_views(ready)
    if database is not None:
        load_processed(tables, database)
        load_marts(ready, database)
    return ready
