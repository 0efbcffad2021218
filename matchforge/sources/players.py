"""League entries and the player dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchforge import schema
from matchforge.functions.numeric import ratio, round_to


def league_entries(payloads: DataFrame, *, league: str, queue: str, region: str) -> DataFrame:
    """Landed league documents (column ``document``) to one raw player row per entry.

    Tier and queue come from the document, else from the arguments. Readers that
    want the league order sort by ``leaguePoints``; stored rows carry none.
    """
    parsed = F.from_json("document", schema.LEAGUE_DOCUMENT)
    return (
        payloads.select(parsed.alias("doc"))
        .select("doc.tier", "doc.queue", F.explode("doc.entries").alias("_raw_json"))
        .withColumn("entry", F.from_json("_raw_json", schema.LEAGUE_ENTRY))
        .select(
            "entry.*",
            "_raw_json",
            F.coalesce("tier", F.lit(league.upper())).alias("_tier"),
            F.coalesce("queue", F.lit(queue)).alias("_queue"),
            F.lit(region).alias("_region"),
        )
    )


def fill_missing_puuid(players: DataFrame, summoners: DataFrame) -> DataFrame:
    """Players lacking a puuid get it from the landed summoner table (id, puuid).

    Only they are joined, so complete rows and rows without any id stay out of
    the shuffle.
    """
    lookup = (
        summoners.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("puuid").alias("found_puuid"))
    )
    if "puuid" not in players.columns:
        players = players.withColumn("puuid", F.lit(None).cast("string"))
    to_ask = F.col("puuid").isNull() & F.col("summonerId").isNotNull()
    found = (
        players.filter(to_ask)
        .drop("puuid")
        .join(lookup, F.col("summonerId") == F.col("id"), "left")
        .withColumnRenamed("found_puuid", "puuid")
        .select(players.columns)
    )
    return players.filter(~to_ask).unionByName(found)


def player_dimension(raw_players: DataFrame) -> DataFrame:
    """The kept columns that exist, plus ``winrate`` over decided games."""
    kept = raw_players.select([c for c in schema.PLAYER_COLUMNS if c in raw_players.columns])
    if {"wins", "losses"} <= set(kept.columns):
        games = F.col("wins") + F.col("losses")
        decided = F.when(games > 0, games)
        kept = kept.withColumn("winrate", round_to(ratio(F.col("wins"), decided), 4))
    return kept


def relational_form(df: DataFrame, table: str) -> DataFrame:
    """Snake-case names and only the columns the relational copy of ``table`` has."""
    if table == "players":
        df = df.withColumnsRenamed(schema.PLAYER_RELATIONAL_NAMES)
    allowed = schema.RELATIONAL_COLUMNS[table]
    return df.select([c for c in df.columns if c in allowed])
