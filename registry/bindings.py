"""The given tables read as match data.

A line item is a participant: its order is the match, its supplier the player,
its part the champion (brand) and position (type). Only the dimensions that the
requested columns need are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators.flatten import normalize_position, normalize_position_columns
from matchforge.session import spread, spread_in_order

# Part types -> position names as the match API writes them; the sixth type has none.
POSITION_OF_TYPE = {
    "ECONOMY": "TOP",
    "STANDARD": "JUNGLE",
    "MEDIUM": "MIDDLE",
    "LARGE": "BOTTOM",
    "SMALL": "UTILITY",
    "PROMO": "",
}


# Columns of the tables that are read; a stated schema saves the footer scan.
TABLES = {
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{sf_dir}/{table}.parquet")


def _whole_sql(value: str) -> str:
    return f"CAST(floor({value}) AS BIGINT)"


def _whole(value: str) -> Column:
    return F.expr(_whole_sql(value))


def _position_sql(names: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{part_type}' THEN '{name}'" for part_type, name in names.items())
    return f"CASE p_type {whens} END"


def api_position() -> Column:
    return F.expr(_position_sql(POSITION_OF_TYPE))


# Fact column -> (SQL over the line item and its dimensions, dimension it needs).
COLUMNS: dict[str, tuple[str, str | None]] = {
    "match_id": ("l_orderkey", None),
    "puuid": ("nullif(l_suppkey, 0)", None),
    "summoner_name": ("s_name", "supplier"),
    "win": ("l_linestatus = 'F'", None),
    "kills": (_whole_sql("l_quantity / 5"), None),
    "deaths": ("CAST(l_linenumber - 1 AS BIGINT)", None),
    "assists": (_whole_sql("p_size / 5"), "part"),
    "gold_earned": (_whole_sql("l_extendedprice"), None),
    "damage_to_champions": (_whole_sql("l_extendedprice * (1 - l_discount) / 2"), None),
    "vision_score": (_whole_sql("l_discount * 900"), None),
    "minions_killed": ("CAST(p_size AS BIGINT)", "part"),
    "neutral_minions_killed": ("CAST(l_linenumber AS BIGINT)", None),
    "champion_name": ("CASE WHEN p_size = 50 THEN NULL ELSE p_brand END", "part"),
    "team_position": (_position_sql(POSITION_OF_TYPE), "part"),
    "game_date": ("nullif(l_shipdate, TIMESTAMP_NTZ '1999-01-01 00:00:00')", None),
    "game_duration": (_whole_sql("o_totalprice / 100"), "orders"),
    "item0": ("l_partkey", None),
    "item1": ("CASE WHEN l_linenumber = 1 THEN 0 ELSE l_suppkey END", None),
    "item2": ("CAST(nullif(p_size, 1) AS BIGINT)", "part"),
    "item3": ("CAST(l_linenumber AS BIGINT)", None),
    "item4": ("CASE WHEN l_returnflag = 'R' THEN CAST(-l_linenumber AS BIGINT) ELSE l_partkey END", None),
    "item5": ("CAST(0 AS BIGINT)", None),
    "item6": ("l_suppkey", None),
}

# Names first: a branch that drops the later dimensions then loses their joins.
_JOINS = {
    "supplier": ("l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
}


# A second reading of the same rows, one text for Spark and for the check: players from one
# game to hundreds, some without deaths; champions that are rare, always win or never do;
# players of one champion; win rates that differ by player and position; damage that grows.
VARIED = """
  SELECT l_orderkey AS match_id, player AS puuid, 'N' || player AS summoner_name, champion AS champion_name,
         CASE role WHEN 0 THEN 'TOP' WHEN 1 THEN 'JUNGLE' WHEN 2 THEN 'MID' WHEN 3 THEN 'BOTTOM'
                   WHEN 4 THEN 'SUPPORT' WHEN 5 THEN '' END AS team_position,
         CASE WHEN l_tax = 0.08 AND l_linenumber = 2 THEN NULL
              WHEN champion = 'Main0' THEN true WHEN champion = 'Main6' THEN false
              ELSE (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 100
                   < 40 + (player % 9) * 4 + CASE WHEN role = 0 THEN 8 ELSE 0 END END AS win,
         CAST(floor(l_quantity / 5) AS BIGINT) + player % 9 AS kills,
         CAST(CASE WHEN player % 11 = 0 THEN 0 ELSE l_linenumber - 1 + player % 4 * 2 END AS BIGINT) AS deaths,
         CAST(floor(p_size / 5) AS BIGINT) AS assists,
         CAST(floor(l_extendedprice) AS BIGINT) AS gold_earned,
         CAST(floor(l_extendedprice * (year(l_shipdate) - 1990) * (player % 5) / 20) AS BIGINT) AS damage_to_champions,
         CAST(floor(l_discount * 300) AS BIGINT) + player % 5 * 15 AS vision_score,
         CAST(p_size * 6 AS BIGINT) AS minions_killed, CAST(l_linenumber * 5 AS BIGINT) AS neutral_minions_killed,
         l_shipdate AS game_date, CAST(floor(l_extendedprice / 20) AS BIGINT) AS game_duration,
         CASE WHEN l_partkey % 5 = 0 AND l_quantity < 45 THEN 0 ELSE l_partkey END AS item0,
         CASE WHEN l_linenumber = 1 THEN 5000000 + l_partkey END AS item1,
         CAST(l_linenumber AS BIGINT) AS item2, 100 + player % 9 AS item3,
         CAST(NULL AS BIGINT) AS item4, CAST(0 AS BIGINT) AS item5
  FROM (
    SELECT *, CASE WHEN champion LIKE 'Main%' THEN player % 5 ELSE (l_orderkey + l_partkey) % 7 END AS role
    FROM (
      SELECT *, CASE WHEN l_partkey % 97 = 0 THEN NULL
                     WHEN l_quantity >= 46 AND l_quantity < 48 THEN 'R' || (l_partkey % 60)
                     WHEN l_linenumber <= player % 6 THEN 'Main' || (player % 7)
                     ELSE 'C' || (l_orderkey % 30) END AS champion
      FROM (
        SELECT *, CASE WHEN l_quantity >= 48 THEN 2000000 + l_partkey * 1000 + l_suppkey
                       WHEN l_quantity >= 25 THEN 1000000 + l_partkey ELSE l_suppkey END AS player
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey) AS by_player) AS by_champion) AS by_role
"""

_reading_varied: ContextVar[bool] = ContextVar("varied", default=False)


@contextmanager
def varied_reading() -> Iterator[None]:
    """Inside, the fact and the line-ups are read as ``VARIED`` says."""
    token = _reading_varied.set(True)
    try:
        yield
    finally:
        _reading_varied.reset(token)


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        VARIED.replace("FROM lineitem LEFT JOIN part", "FROM {lineitem} LEFT JOIN {part}"),
        lineitem=read(spark, sf_dir, "lineitem"), part=read(spark, sf_dir, "part"),
    )


def participants(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The participant fact with the given columns (all when none are named)."""
    if _reading_varied.get():
        return _varied(spark, sf_dir).select(*columns or ["*"])
    chosen = columns or tuple(COLUMNS)
    rows = read(spark, sf_dir, "lineitem")
    for table, (left, right) in _JOINS.items():
        if any(COLUMNS[c][1] == table for c in chosen):
            dimension = read(spark, sf_dir, table)
            rows = rows.join(dimension, rows[left] == dimension[right], "left")
    return normalize_position_columns(rows.selectExpr(*[f"{COLUMNS[c][0]} AS {c}" for c in chosen]))


PLAYER_FACT = (
    "match_id", "puuid", "summoner_name", "champion_name", "team_position", "win", "kills",
    "deaths", "assists", "gold_earned", "damage_to_champions", "vision_score",
    "minions_killed", "neutral_minions_killed",
)
CHAMPION_FACT = (
    "champion_name", "team_position", "win", "kills", "deaths", "assists",
    "gold_earned", "damage_to_champions", "vision_score",
)
PLAYER_CHAMPION_FACT = ("puuid", "summoner_name", *CHAMPION_FACT)
POSITION_FACT = (
    "team_position", "win", "kills", "deaths", "assists", "gold_earned",
    "damage_to_champions", "vision_score", "minions_killed", "neutral_minions_killed",
)
DAY_FACT = ("match_id", "game_date", "win", "kills", "deaths", "damage_to_champions", "game_duration")
ITEM_FACT = ("win", "item0", "item1", "item2", "item3", "item4", "item5")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the item dimension, keyed by text ids."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("item_name"),
        _whole("p_retailprice").alias("gold_total"),
        F.col("p_type").alias("tags"),
    )


# --- landed documents ---------------------------------------------------------

# Total order of the raw records made from line items.
RAW_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def broken(document: Column) -> Column:
    """Records that are not one JSON object, from a good one: no JSON, nothing, a list, cut off, two, single quotes."""
    forms = (
        F.lit("NOT_JSON{{{{"), F.lit(None).cast("string"), F.concat(F.lit("["), document, F.lit("]")),
        F.substring(document, 1, 200), F.concat(document, document), F.translate(document, '"', "'"), F.lit(""))
    chosen = F.lit(None).cast("string")
    for number, form in enumerate(forms, start=1):
        chosen = F.when(F.col("l_linenumber") == number, form).otherwise(chosen)
    return chosen


def raw_matches(
    spark: SparkSession, sf_dir: str, *, part: Column | None = None, ordered: bool = False
) -> DataFrame:
    """One raw match record per line item, with its supplier and its part as participants.

    An order with several lines is a match landed in several copies; suppliers
    met twice in an order are the duplicates. Lines taxed at 8 % are unreadable, in a way that
    depends on the line's number. ``part`` chooses among the lines; ``ordered`` sorts them by
    ``RAW_ORDER`` before their documents are made, which are many times as long.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = read(spark, sf_dir, "lineitem")
    lines = lines if part is None else lines.filter(part)
    if not ordered:  # a sort deals the lines out itself
        lines = spread(lines, tasks, "l_partkey")
    parts = read(spark, sf_dir, "part")
    rows = lines.join(parts, lines["l_partkey"] == parts["p_partkey"], "left")
    if ordered:
        rows = spread_in_order(rows, tasks, *RAW_ORDER)
    won = F.col("l_linestatus") == "F"
    quantity = _whole("l_quantity / 5")
    challenges = F.struct(
        F.col("l_quantity").alias("kda"), F.struct(F.col("l_linenumber").alias("first")).alias("streak")
    )

    def participant(player: Column, team: int, win: Column, kills: Column, item0: Column) -> Column:
        return F.struct(
            player.alias("puuid"),
            F.concat(F.lit("name "), player).alias("riotIdGameName"),
            F.lit(team).alias("teamId"),
            api_position().alias("teamPosition"),
            F.lit("CARRY").alias("role"),
            win.alias("win"),
            kills.alias("kills"),
            (F.col("l_linenumber") - 1).alias("deaths"),
            F.col("p_size").alias("assists"),
            _whole("l_extendedprice").alias("goldEarned"),
            _whole("l_extendedprice / 2").alias("totalDamageDealtToChampions"),
            _whole("l_discount * 900").alias("visionScore"),
            item0.alias("item0"),
            F.lit(0).alias("item1"),
            F.col("p_brand").alias("championName"),
            F.col("p_size").alias("championId"),
            challenges.alias("challenges"),
        )

    info = F.struct(
        F.col("l_linenumber").alias("gameDuration"),
        F.lit("14.1.1").alias("gameVersion"),
        F.expr("datediff(l_shipdate, DATE '1970-01-01') * 86400000L").alias("gameEndTimestamp"),
        F.lit("CLASSIC").alias("gameMode"),
        F.expr("CASE l_returnflag WHEN 'N' THEN 420 WHEN 'A' THEN 440 END").alias("queueId"),
        F.array(
            participant(F.expr("'S' || nullif(l_suppkey, 0)"), 100, won, quantity, F.col("l_partkey")),
            participant(F.expr("'P' || l_partkey"), 200, ~won, quantity + 1, F.lit(None).cast("bigint")),
        ).alias("participants"),
    )
    # a column of its own, as each form of ``broken`` would hold the whole expression
    rows = rows.select("l_orderkey", "l_tax", *RAW_ORDER, F.to_json(F.struct(info.alias("info"))).alias("readable"))
    document = F.when(F.col("l_tax") == 0.08, broken(F.col("readable"))).otherwise(F.col("readable"))
    return rows.select(
        F.expr("'M' || l_orderkey").alias("match_id"),
        document.alias("_raw_json"),
        F.lit("euw1").alias("_region"),
        *RAW_ORDER,
    )


def fetched_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched match records, one per line item, so most ids come several times."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"), *RAW_ORDER
    )


def matches_with_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.filter(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("match_id"))


def league_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One league document per supplier nation and player: wins and losses of the player's lines.

    Half of the documents name no tier; players without wins carry no puuid.
    """
    record = (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count(F.when(F.col("l_linestatus") == "F", 1)).alias("wins"),
            F.count(F.when(F.col("l_linestatus") != "F", 1)).alias("losses"),
        )
    )
    suppliers = read(spark, sf_dir, "supplier")
    rows = suppliers.join(record, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    entry = F.struct(
        F.expr("CASE WHEN s_acctbal >= 5000 THEN 'U' || s_suppkey END").alias("puuid"),
        F.expr("'I' || s_suppkey").alias("summonerId"),
        F.col("s_name").alias("summonerName"),
        _whole("s_acctbal").alias("leaguePoints"),
        F.coalesce("wins", F.lit(0)).alias("wins"),
        F.coalesce("losses", F.lit(0)).alias("losses"),
        (F.col("s_acctbal") > 0).alias("veteran"),
    )
    tier = F.expr("CASE WHEN s_nationkey < 12 THEN 'MASTER' END")
    document = F.to_json(F.struct(tier.alias("tier"), F.array(entry).alias("entries")))
    return rows.select(document.alias("document"))


def summoners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed summoner records, without those of nation 3."""
    return (
        read(spark, sf_dir, "supplier")
        .filter(F.col("s_nationkey") != 3)
        .select(F.expr("'I' || s_suppkey").alias("id"), F.expr("'U' || s_suppkey").alias("puuid"))
    )


def champion_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Champion dictionary documents with one part as the entry of each."""
    entry = F.struct(
        F.col("p_size").cast("string").alias("key"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("title"),
        F.expr("CASE WHEN p_size > 25 THEN p_type END").alias("blurb"),
        F.array("p_type", "p_brand").alias("tags"),
        F.struct(F.col("p_retailprice").alias("hp"), F.col("p_size").alias("armor")).alias("stats"),
    )
    return read(spark, sf_dir, "part").select(
        F.to_json(
            F.struct(
                F.lit("14.2.0").alias("_version"),
                F.create_map(F.expr("'C' || p_partkey"), entry).alias("data"),
            )
        ).alias("document")
    )


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item dictionary documents with one part as the entry of each."""
    gold = F.struct(
        _whole("p_retailprice").alias("total"),
        _whole("p_retailprice * 0.5").alias("sell"),
        (F.col("p_size") > 10).alias("purchasable"),
    )
    entry = F.struct(
        F.col("p_name").alias("name"),
        F.array("p_type").alias("tags"),
        gold.alias("gold"),
        F.expr("CASE WHEN p_size > 25 THEN array(p_brand, p_type) END").alias("into"),
        F.col("p_size").alias("depth"),
    )
    return read(spark, sf_dir, "part").select(
        F.to_json(
            F.struct(
                F.lit("14.2.0").alias("_version"),
                F.create_map(F.col("p_partkey").cast("string"), entry).alias("data"),
            )
        ).alias("document")
    )


def dictionary_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Champion and item dictionaries as pretty-printed files, a thousand entries in each."""
    for name, documents in (("champions", champion_documents), ("items", item_documents)):
        entries = documents(spark, sf_dir).select(
            F.from_json("document", "_version STRING, data MAP<STRING, STRING>").alias("d")).select(
            "d._version", F.explode("d.data").alias("key", "entry"))
        number = F.expr("CAST(regexp_replace(key, '[^0-9]', '') AS BIGINT) DIV 1000").alias("file")
        whole = entries.groupBy("_version", number).agg(F.map_from_entries(F.collect_list(F.struct(
            "key", F.try_parse_json("entry").alias("entry")))).alias("data"))
        text = F.to_json(F.struct("_version", "data"), {"pretty": "true"}).alias("value")
        whole.select("file", text).write.partitionBy("file").text(f"{folder}/static/{name}.json")


def flawed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with missing values, negatives, out-of-range values and one column left out."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("puuid"),
        F.expr("CASE WHEN l_tax = 0.08 THEN NULL ELSE l_linestatus = 'F' END").alias("win"),
        F.expr("CAST(floor(l_quantity) AS BIGINT) - 2").alias("kills"),
        F.expr("CAST(l_linenumber AS BIGINT)").alias("deaths"),
        F.expr("CAST(floor(l_quantity * 3) AS BIGINT)").alias("assists"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END").alias("gold_earned"),
        F.lit("x").alias("champion_name"),
        F.expr("nullif(l_returnflag, 'N')").alias("team_position"),
        F.expr("CAST(floor(l_discount * 9000) AS BIGINT) - 100").alias("vision_score"),
    )


def lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a line-up: its parts as champions at their positions."""
    if _reading_varied.get():
        return _varied(spark, sf_dir).select(
            F.col("match_id").alias("lineup_id"), F.col("team_position").alias("position"), "champion_name")
    lines = read(spark, sf_dir, "lineitem")
    parts = read(spark, sf_dir, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_orderkey").alias("lineup_id"),
        normalize_position(api_position()).alias("position"),
        F.col("p_brand").alias("champion_name"),
    )


def part_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the players of the orders they are in, for the player graph."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.expr("'P' || l_partkey").alias("puuid"),
        F.col("l_shipdate").alias("game_date"),
    )


def seed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small promotional parts of one brand as the league the search starts from."""
    parts = read(spark, sf_dir, "part")
    return parts.filter((F.col("p_brand") == "Brand#3") & (F.col("p_type") == "PROMO")).select(
        F.expr("'P' || p_partkey").alias("puuid"),
        F.col("p_name").alias("summonerName"),
        F.col("p_size").cast("bigint").alias("leaguePoints"),
        F.lit("CHALLENGER").alias("_tier"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account records of the parts; those of size 13 have none."""
    parts = read(spark, sf_dir, "part")
    return parts.filter(F.col("p_size") != 13).select(
        F.expr("'P' || p_partkey").alias("puuid"),
        F.col("p_name").alias("gameName"),
        F.col("p_brand").alias("tagLine"),
    )
