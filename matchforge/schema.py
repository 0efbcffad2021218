"""Column names, types and thresholds that define the data model."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# The default field map (fact column -> path in the match
# document). ``__name__`` paths are read from the match, others from the
# participant.
# ---------------------------------------------------------------------------
DEFAULT_FIELD_MAP: dict[str, str] = {
    "match_id": "__match_id__",
    "game_duration": "__game_duration__",
    "game_version": "__game_version__",
    "game_date": "__game_date__",
    "game_mode": "__game_mode__",
    "puuid": "puuid",
    "summoner_name": "riotIdGameName",
    "team_id": "teamId",
    "team_position": "teamPosition",
    "role": "role",
    "win": "win",
    "kills": "kills",
    "deaths": "deaths",
    "assists": "assists",
    "gold_earned": "goldEarned",
    "minions_killed": "totalMinionsKilled",
    "neutral_minions_killed": "neutralMinionsKilled",
    "damage_to_champions": "totalDamageDealtToChampions",
    "damage_taken": "totalDamageTaken",
    "healing_done": "totalHeal",
    "vision_score": "visionScore",
    "wards_placed": "wardsPlaced",
    "wards_killed": "wardsKilled",
    "item0": "item0",
    "item1": "item1",
    "item2": "item2",
    "item3": "item3",
    "item4": "item4",
    "item5": "item5",
    "item6": "item6",
    "champion_name": "championName",
    "champion_id": "championId",
}

# Paths answered by the match itself -> field of ``info``
# (the match id comes from the raw record, not from the document).
MATCH_ID_PATH = "__match_id__"
MATCH_LEVEL_PATHS: dict[str, str] = {
    "__game_duration__": "gameDuration",
    "__game_version__": "gameVersion",
    "__game_date__": "gameEndTimestamp",
    "__game_mode__": "gameMode",
    "__queue_id__": "queueId",
}

# The number matches carry for a queue that leagues name.
QUEUE_IDS: dict[str, int] = {"RANKED_SOLO_5x5": 420, "RANKED_FLEX_SR": 440}

# Fact columns held as nullable 64-bit integers.
INTEGER_COLUMNS: tuple[str, ...] = (
    "kills", "deaths", "assists", "gold_earned",
    "minions_killed", "neutral_minions_killed",
    "damage_to_champions", "damage_taken", "healing_done",
    "vision_score", "wards_placed", "wards_killed",
    "item0", "item1", "item2", "item3", "item4", "item5", "item6",
    "game_duration", "champion_id", "team_id", "queue_id",
    # columns a field map may add
    "pentakills", "quadrakills", "turret_kills", "dragon_kills", "baron_kills",
    "time_spent_living", "crowd_control_score",
    "spell1_casts", "spell2_casts", "spell3_casts", "spell4_casts",
)
BOOLEAN_COLUMNS: tuple[str, ...] = ("win", "first_blood")
EPOCH_MS_COLUMNS: tuple[str, ...] = ("game_date",)

# Position names written by the match API -> names used here.
POSITION_NAMES: dict[str, str] = {"MIDDLE": "MID", "UTILITY": "SUPPORT"}
POSITION_ORDER: tuple[str, ...] = ("TOP", "JUNGLE", "MID", "BOTTOM", "SUPPORT")

# Item slots counted as purchases; the seventh slot (item6) is not one.
PURCHASE_SLOTS: tuple[str, ...] = ("item0", "item1", "item2", "item3", "item4", "item5")

# Columns kept in the player dimension, in order.
PLAYER_COLUMNS: tuple[str, ...] = (
    "puuid", "summonerId", "summonerName", "riotIdGameName", "riotIdTagline",
    "leaguePoints", "rank", "wins", "losses", "veteran", "inactive",
    "freshBlood", "hotStreak", "_tier", "_queue", "_region",
)

# Player column -> name in the relational copy.
PLAYER_RELATIONAL_NAMES: dict[str, str] = {
    "summonerId": "summoner_id",
    "summonerName": "summoner_name",
    "riotIdGameName": "riot_id_name",
    "riotIdTagline": "riot_id_tagline",
    "leaguePoints": "league_points",
    "freshBlood": "fresh_blood",
    "hotStreak": "hot_streak",
    "_tier": "tier",
    "_queue": "queue",
    "_region": "region",
}

# Columns the relational copy of each processed table holds.
RELATIONAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "players": (
        "puuid", "summoner_id", "summoner_name", "riot_id_name", "riot_id_tagline",
        "league_points", "rank", "wins", "losses", "veteran", "inactive",
        "fresh_blood", "hot_streak", "tier", "queue", "region", "winrate",
    ),
    "matches": tuple(DEFAULT_FIELD_MAP),
    "champions": (
        "champion_id", "champion_key", "champion_name", "title", "tags", "resource",
        "blurb", "dd_version", "hp", "mp", "armor", "spellblock", "attackdamage",
        "attackspeed", "movespeed",
    ),
    "items": (
        "item_id", "item_name", "description", "tags", "gold_total", "gold_sell",
        "purchasable", "from_items", "into_items", "depth", "dd_version",
    ),
}

RAW_MATCH_SCHEMA = "match_id STRING, _raw_json STRING, _region STRING"

CHAMPION_DOCUMENT = (
    "_version STRING, data MAP<STRING, STRUCT<key: STRING, name: STRING, title: STRING, "
    "blurb: STRING, tags: ARRAY<STRING>, partype: STRING, "
    "stats: STRUCT<hp: DOUBLE, mp: DOUBLE, armor: DOUBLE, spellblock: DOUBLE, "
    "attackdamage: DOUBLE, attackspeed: DOUBLE, movespeed: DOUBLE>>>"
)
ITEM_DOCUMENT = (
    "_version STRING, data MAP<STRING, STRUCT<name: STRING, plaintext: STRING, "
    "tags: ARRAY<STRING>, gold: STRUCT<total: BIGINT, sell: BIGINT, purchasable: BOOLEAN>, "
    "`from`: ARRAY<STRING>, into: ARRAY<STRING>, depth: BIGINT>>"
)
LEAGUE_DOCUMENT = "tier STRING, queue STRING, entries ARRAY<STRING>"
LEAGUE_ENTRY = (
    "puuid STRING, summonerId STRING, summonerName STRING, riotIdGameName STRING, "
    "riotIdTagline STRING, leaguePoints BIGINT, rank STRING, wins BIGINT, losses BIGINT, "
    "veteran BOOLEAN, inactive BOOLEAN, freshBlood BOOLEAN, hotStreak BOOLEAN"
)
