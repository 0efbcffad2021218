"""SQL for the same results over the same tables.

The logic of marts, views and reports is written anew; the reading of the tables as
match data repeats the binding's expressions, and sums that decide a digit its decimals.
"""

from __future__ import annotations

from registry.bindings import VARIED
from registry.queries import VARIED as VARIED_QUERIES

FACT = """
fact AS (
  SELECT l.l_orderkey AS match_id,
         nullif(l.l_suppkey, 0) AS puuid,
         s.s_name AS summoner_name,
         l.l_linestatus = 'F' AS win,
         CAST(floor(l.l_quantity / 5) AS BIGINT) AS kills,
         CAST(l.l_linenumber - 1 AS BIGINT) AS deaths,
         CAST(floor(p.p_size / 5) AS BIGINT) AS assists,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS gold_earned,
         CAST(floor(l.l_extendedprice * (1 - l.l_discount) / 2) AS BIGINT) AS damage_to_champions,
         CAST(floor(l.l_discount * 900) AS BIGINT) AS vision_score,
         CAST(p.p_size AS BIGINT) AS minions_killed,
         CAST(l.l_linenumber AS BIGINT) AS neutral_minions_killed,
         CASE WHEN p.p_size = 50 THEN NULL ELSE p.p_brand END AS champion_name,
         CASE p.p_type WHEN 'ECONOMY' THEN 'TOP' WHEN 'STANDARD' THEN 'JUNGLE'
              WHEN 'MEDIUM' THEN 'MID' WHEN 'LARGE' THEN 'BOTTOM'
              WHEN 'SMALL' THEN 'SUPPORT' WHEN 'PROMO' THEN '' END AS team_position,
         nullif(l.l_shipdate, TIMESTAMP '1999-01-01 00:00:00') AS game_date,
         CAST(floor(o.o_totalprice / 100) AS BIGINT) AS game_duration,
         l.l_partkey AS item0,
         CASE WHEN l.l_linenumber = 1 THEN 0 ELSE l.l_suppkey END AS item1,
         CAST(nullif(p.p_size, 1) AS BIGINT) AS item2,
         CAST(l.l_linenumber AS BIGINT) AS item3,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(-l.l_linenumber AS BIGINT) ELSE l.l_partkey END AS item4,
         CAST(0 AS BIGINT) AS item5
  FROM lineitem l
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
  LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
)"""


def rnd(expression: str, digits: int) -> str:
    """Half away from zero on the scaled double."""
    if digits == 0:
        return f"round({expression})"
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"round(({expression}) * {scale}) / {scale}"


def avg(column: str, digits: int) -> str:
    return rnd(f"avg({column})", digits)


WINRATE = rnd("avg(CASE WHEN win THEN 1.0::DOUBLE WHEN NOT win THEN 0.0::DOUBLE END) * 100", 1)
KDA = rnd("avg(kills + assists) / nullif(avg(deaths), 0)", 2)

PLAYERS = f"""
votes AS (
  SELECT puuid, summoner_name, kind, choice, count(*) AS n
  FROM (SELECT puuid, summoner_name, 'c' AS kind, champion_name AS choice FROM fact
        UNION ALL
        SELECT puuid, summoner_name, 'p' AS kind, team_position AS choice FROM fact)
  WHERE puuid IS NOT NULL AND choice IS NOT NULL
  GROUP BY ALL
),
favourites AS (
  SELECT puuid, summoner_name, kind, choice
  FROM votes
  QUALIFY row_number() OVER (PARTITION BY puuid, summoner_name, kind ORDER BY n DESC, choice) = 1
),
players AS (
  SELECT t.*, c.choice AS most_played_champion, q.choice AS main_position
  FROM (
    SELECT puuid, summoner_name, count(DISTINCT match_id) AS games_played,
           {avg('kills', 2)} AS avg_kills, {avg('deaths', 2)} AS avg_deaths,
           {avg('assists', 2)} AS avg_assists, {KDA} AS avg_kda, {WINRATE} AS winrate_pct,
           {avg('gold_earned', 0)} AS avg_gold, {avg('damage_to_champions', 0)} AS avg_damage,
           {avg('vision_score', 1)} AS avg_vision,
           {avg('minions_killed + neutral_minions_killed', 1)} AS avg_cs
    FROM fact WHERE puuid IS NOT NULL
    GROUP BY puuid, summoner_name HAVING count(DISTINCT match_id) >= 3) t
  LEFT JOIN favourites c ON c.kind = 'c' AND c.puuid = t.puuid
       AND c.summoner_name IS NOT DISTINCT FROM t.summoner_name
  LEFT JOIN favourites q ON q.kind = 'p' AND q.puuid = t.puuid
       AND q.summoner_name IS NOT DISTINCT FROM t.summoner_name
)"""


def _player_champions(min_games: int) -> str:
    return f"""
player_champions AS (
  SELECT puuid, summoner_name, champion_name, team_position, count(*) AS games_played,
         {WINRATE} AS winrate_pct, {avg('kills', 2)} AS avg_kills, {avg('deaths', 2)} AS avg_deaths,
         {avg('assists', 2)} AS avg_assists, {KDA} AS avg_kda,
         {avg('damage_to_champions', 0)} AS avg_damage, {avg('vision_score', 1)} AS avg_vision
  FROM fact WHERE puuid IS NOT NULL AND champion_name IS NOT NULL
  GROUP BY puuid, summoner_name, champion_name, team_position
  HAVING count(*) >= {min_games}
)"""


PLAYER_CHAMPIONS = _player_champions(2)

CHAMPIONS = f"""
champions AS (
  SELECT champion_name, team_position, count(*) AS picks, {WINRATE} AS winrate_pct,
         {avg('kills', 2)} AS avg_kills, {avg('deaths', 2)} AS avg_deaths,
         {avg('assists', 2)} AS avg_assists, {KDA} AS avg_kda,
         {avg('damage_to_champions', 0)} AS avg_damage, {avg('gold_earned', 0)} AS avg_gold,
         {avg('vision_score', 1)} AS avg_vision
  FROM fact WHERE champion_name IS NOT NULL
  GROUP BY champion_name, team_position HAVING count(*) >= 5
)"""

POSITIONS = f"""
positions AS (
  SELECT team_position, count(*) AS total_games, {WINRATE} AS winrate_pct,
         {avg('kills', 2)} AS avg_kills, {avg('deaths', 2)} AS avg_deaths,
         {avg('assists', 2)} AS avg_assists, {avg('damage_to_champions', 0)} AS avg_damage,
         {avg('gold_earned', 0)} AS avg_gold, {avg('vision_score', 1)} AS avg_vision,
         {avg('minions_killed + neutral_minions_killed', 1)} AS avg_cs
  FROM fact WHERE team_position <> ''
  GROUP BY team_position
)"""

TIMELINE = f"""
timeline AS (
  SELECT CAST(game_date AS DATE) AS game_day, count(DISTINCT match_id) AS total_matches,
         {WINRATE} AS overall_winrate, {avg('kills', 2)} AS avg_kills,
         {avg('deaths', 2)} AS avg_deaths, {avg('damage_to_champions', 0)} AS avg_damage,
         {rnd('avg(game_duration) / 60.0::DOUBLE', 1)} AS avg_duration_min
  FROM fact WHERE game_date IS NOT NULL
  GROUP BY CAST(game_date AS DATE)
)"""

ITEMS = f"""
item_dim AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name,
         CAST(floor(p_retailprice) AS BIGINT) AS gold_total, p_type AS tags
  FROM part
),
slots AS (
  SELECT win, unnest([item0, item1, item2, item3, item4, item5]) AS slot_item FROM fact
),
items AS (
  SELECT i.item_id, i.item_name, i.item_id AS item_id_num, count(*) AS total_purchases,
         {WINRATE} AS winrate_pct, i.gold_total, i.tags
  FROM slots LEFT JOIN item_dim i ON i.item_id = CAST(slots.slot_item AS VARCHAR)
  WHERE slot_item IS NOT NULL AND slot_item <> 0
  GROUP BY i.item_id, i.item_name, i.gold_total, i.tags
  HAVING count(*) >= 10
)"""


def over(*ctes: str, select: str) -> str:
    return "WITH " + ",".join([FACT, *ctes]) + "\n" + select


ORACLE: dict[str, str] = {
    "mart_player_stats": over(PLAYERS, select="SELECT * FROM players"),
    "mart_player_champion_stats": over(PLAYER_CHAMPIONS, select="SELECT * FROM player_champions"),
    "mart_champion_stats": over(CHAMPIONS, select="SELECT * FROM champions"),
    "mart_position_stats": over(POSITIONS, select="SELECT * FROM positions"),
    "mart_match_timeline": over(TIMELINE, select="SELECT * FROM timeline"),
    "mart_item_popularity": over(ITEMS, select="SELECT * FROM items"),
    "vw_top_players": over(PLAYERS, select="""
SELECT summoner_name, main_position, most_played_champion, games_played, winrate_pct, avg_kda,
       avg_damage, avg_gold, avg_cs, avg_vision,
       rank() OVER (ORDER BY winrate_pct DESC NULLS FIRST, games_played DESC NULLS FIRST) AS rank_wr,
       rank() OVER (ORDER BY avg_kda DESC NULLS FIRST) AS rank_kda
FROM players WHERE games_played >= 5"""),
    "vw_meta_champions": over(CHAMPIONS, select="""
SELECT champion_name, team_position, picks, winrate_pct, avg_kda, avg_damage,
       CASE WHEN winrate_pct >= 55 AND picks >= 20 THEN 'S'
            WHEN winrate_pct >= 52 OR picks >= 50 THEN 'A'
            WHEN winrate_pct >= 48 THEN 'B' ELSE 'C' END AS tier,
       rank() OVER (PARTITION BY team_position ORDER BY picks DESC) AS position_rank
FROM champions"""),
    "vw_item_efficiency": over(ITEMS, select=f"""
SELECT item_name, total_purchases, winrate_pct, gold_total, tags,
       {rnd('(winrate_pct - 50.0::DOUBLE) / nullif(gold_total, 0) * 10000', 4)} AS gold_efficiency_score,
       rank() OVER (ORDER BY winrate_pct DESC NULLS FIRST) AS rank_wr,
       rank() OVER (ORDER BY total_purchases DESC) AS rank_pop
FROM items WHERE total_purchases >= 10"""),
    "vw_position_overview": over(POSITIONS, select=f"""
SELECT team_position, total_games, winrate_pct, avg_kills, avg_deaths, avg_assists,
       {rnd('(avg_kills + avg_assists) / nullif(avg_deaths, 0)', 2)} AS avg_kda,
       avg_damage, avg_gold, avg_vision, avg_cs
FROM positions"""),
    "vw_timeline_trends": over(TIMELINE, select=f"""
SELECT game_day, total_matches, overall_winrate, avg_kills, avg_damage, avg_duration_min,
       {rnd('avg(avg_damage) OVER w', 6)} AS damage_ma7,
       {rnd('avg(avg_duration_min) OVER w', 6)} AS duration_ma7,
       total_matches - lag(total_matches) OVER (ORDER BY game_day) AS matches_delta
FROM timeline
WINDOW w AS (ORDER BY game_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
}


# A store filled by loads holds the same marts as a full build.
for _mart in ("player_stats", "champion_stats", "match_timeline", "item_popularity"):
    ORACLE[f"incremental_{_mart}"] = ORACLE[f"mart_{_mart}"]


# --- flattening and landing -----------------------------------------------------

POSITION = """CASE p_type WHEN 'ECONOMY' THEN 'TOP' WHEN 'STANDARD' THEN 'JUNGLE' WHEN 'MEDIUM' THEN 'MID'
     WHEN 'LARGE' THEN 'BOTTOM' WHEN 'SMALL' THEN 'SUPPORT' WHEN 'PROMO' THEN '' END"""

RAW_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _side(place: int, player: str, team: int, win: str, kills: str, item0: str) -> str:
    """One of the two participants each readable line stands for."""
    return f"""
  SELECT 'M' || l_orderkey AS match_id, CAST(l_linenumber AS BIGINT) AS game_duration,
         '14.1.1' AS game_version, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS game_date,
         'CLASSIC' AS game_mode, {player} AS puuid, 'name ' || {player} AS summoner_name,
         CAST({team} AS BIGINT) AS team_id, {POSITION} AS team_position, 'CARRY' AS role, {win} AS win,
         CAST({kills} AS BIGINT) AS kills, CAST(l_linenumber - 1 AS BIGINT) AS deaths,
         CAST(p_size AS BIGINT) AS assists, CAST(floor(l_extendedprice) AS BIGINT) AS gold_earned,
         CAST(NULL AS BIGINT) AS minions_killed, CAST(NULL AS BIGINT) AS neutral_minions_killed,
         CAST(floor(l_extendedprice / 2) AS BIGINT) AS damage_to_champions,
         CAST(NULL AS BIGINT) AS damage_taken, CAST(NULL AS BIGINT) AS healing_done,
         CAST(floor(l_discount * 900) AS BIGINT) AS vision_score,
         CAST(NULL AS BIGINT) AS wards_placed, CAST(NULL AS BIGINT) AS wards_killed,
         CAST({item0} AS BIGINT) AS item0, CAST(0 AS BIGINT) AS item1,
         CAST(NULL AS BIGINT) AS item2, CAST(NULL AS BIGINT) AS item3, CAST(NULL AS BIGINT) AS item4,
         CAST(NULL AS BIGINT) AS item5, CAST(NULL AS BIGINT) AS item6,
         p_brand AS champion_name, CAST(p_size AS BIGINT) AS champion_id,
         {place} AS place, l_quantity, {RAW_ORDER}
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE l_tax <> 0.08"""


RECORDS = f"""WITH records AS (
{_side(0, "'S' || nullif(l_suppkey, 0)", 100, "l_linestatus = 'F'", "floor(l_quantity / 5)", "l_partkey")}
  UNION ALL
{_side(1, "'P' || l_partkey", 200, "l_linestatus <> 'F'", "floor(l_quantity / 5) + 1", "NULL")}
)"""
FLAT = f"* EXCLUDE (place, l_quantity, {RAW_ORDER})"
FIRST = f"QUALIFY row_number() OVER (PARTITION BY match_id, puuid ORDER BY {RAW_ORDER}, place) = 1"

LEAGUE = """WITH record AS (
  SELECT l_suppkey, count(*) FILTER (WHERE l_linestatus = 'F') AS wins,
         count(*) FILTER (WHERE l_linestatus <> 'F') AS losses
  FROM lineitem GROUP BY l_suppkey
),
league AS (
  SELECT CASE WHEN s_acctbal >= 5000 THEN 'U' || s_suppkey END AS puuid,
         'I' || s_suppkey AS "summonerId", s_name AS "summonerName",
         CAST(floor(s_acctbal) AS BIGINT) AS "leaguePoints",
         coalesce(wins, 0) AS wins, coalesce(losses, 0) AS losses, s_acctbal > 0 AS veteran,
         CASE WHEN s_nationkey < 12 THEN 'MASTER' ELSE 'CHALLENGER' END AS _tier,
         'RANKED_SOLO_5x5' AS _queue, 'euw1' AS _region
  FROM supplier LEFT JOIN record ON l_suppkey = s_suppkey
)"""

ORACLE |= {
    "flatten_matches": f"{RECORDS} SELECT {FLAT} FROM records",
    "flatten_dedup": f"{RECORDS} SELECT {FLAT} FROM records {FIRST}",
    "flatten_nested_fields": f"""{RECORDS}
SELECT match_id, game_mode, puuid, CAST(l_quantity AS VARCHAR) AS kda,
       CAST(l_linenumber AS VARCHAR) AS first_streak, CAST(NULL AS VARCHAR) AS absent, team_position
FROM records {FIRST}""",
    "flatten_typed_fields": f"""{RECORDS}
SELECT match_id, game_mode, puuid, l_quantity AS kda, CAST(l_linenumber AS BIGINT) AS first_streak,
       CAST(NULL AS VARCHAR) AS absent, team_position
FROM records {FIRST}""",
    "recent_matches_of_queue": """
WITH played AS (
  SELECT 'M' || l_orderkey AS match_id, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS game_date,
         unnest(['S' || nullif(l_suppkey, 0), 'P' || l_partkey]) AS puuid
  FROM lineitem WHERE l_tax <> 0.08 AND l_returnflag <> 'A'
)
SELECT puuid, match_id, max(game_date) AS game_date,
       CAST(row_number() OVER (PARTITION BY puuid ORDER BY max(game_date) DESC NULLS LAST, match_id) AS INTEGER) AS recency
FROM played WHERE puuid IS NOT NULL GROUP BY puuid, match_id QUALIFY recency <= 3""",
    "corrupt_matches": """
SELECT 'M' || l_orderkey AS match_id, count(*) AS records
FROM lineitem WHERE l_tax = 0.08 GROUP BY l_orderkey""",
    "json_path_projection": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.a.b') AS missing
FROM events""",
    "incremental_new_matches": f"""
SELECT l_orderkey AS match_id, {RAW_ORDER} FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = l_orderkey)
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {RAW_ORDER}) = 1""",
    "landed_match_lookup": f"""
SELECT l_orderkey AS match_id, {RAW_ORDER} FROM lineitem
WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' AND o_orderkey = l_orderkey)
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {RAW_ORDER}) = 1""",
    "landed_match_ids": "SELECT DISTINCT l_orderkey AS match_id FROM lineitem WHERE l_orderkey IS NOT NULL",
    "recent_matches_per_player": over(select="""
SELECT puuid, match_id, game_date,
       CAST(row_number() OVER (PARTITION BY puuid ORDER BY game_date DESC NULLS LAST, match_id) AS INTEGER) AS recency
FROM (SELECT puuid, match_id, max(game_date) AS game_date FROM fact
      WHERE puuid IS NOT NULL GROUP BY puuid, match_id)
QUALIFY recency <= 5"""),
    "league_entries": f'{LEAGUE} SELECT *, "summonerId" AS raw_summoner FROM league',
    "fill_missing_puuid": f"""{LEAGUE}
SELECT "summonerId", coalesce(puuid, found) AS puuid
FROM league LEFT JOIN (SELECT 'I' || s_suppkey AS id, 'U' || s_suppkey AS found
                       FROM supplier WHERE s_nationkey <> 3) ON id = "summonerId\"""",
    "player_winrate": f"""{LEAGUE}
SELECT "summonerId", "summonerName", wins, losses, _tier,
       CASE WHEN wins + losses > 0
            THEN {rnd('CAST(wins AS DOUBLE) / nullif(wins + losses, 0)', 4)} END AS winrate
FROM league""",
    "player_relational_form": f"""{LEAGUE}
SELECT puuid, "summonerId" AS summoner_id, "summonerName" AS summoner_name,
       CAST(NULL AS VARCHAR) AS riot_id_name, CAST(NULL AS VARCHAR) AS riot_id_tagline,
       "leaguePoints" AS league_points, CAST(NULL AS VARCHAR) AS rank, wins, losses, veteran,
       CAST(NULL AS BOOLEAN) AS inactive, CAST(NULL AS BOOLEAN) AS fresh_blood,
       CAST(NULL AS BOOLEAN) AS hot_streak, _tier AS tier, _queue AS queue, _region AS region
FROM league""",
    "flatten_champion_dictionary": """
SELECT CAST(p_size AS VARCHAR) AS champion_id, 'C' || p_partkey AS champion_key,
       p_name AS champion_name, p_brand AS title, p_type || ', ' || p_brand AS tags,
       CAST(NULL AS VARCHAR) AS resource, CASE WHEN p_size > 25 THEN p_type ELSE '' END AS blurb,
       '14.2.0' AS dd_version, p_retailprice AS hp, CAST(NULL AS DOUBLE) AS mp,
       CAST(p_size AS DOUBLE) AS armor, CAST(NULL AS DOUBLE) AS spellblock,
       CAST(NULL AS DOUBLE) AS attackdamage, CAST(NULL AS DOUBLE) AS attackspeed,
       CAST(NULL AS DOUBLE) AS movespeed
FROM part""",
    "flatten_item_dictionary": """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_name, '' AS description, p_type AS tags,
       CAST(floor(p_retailprice) AS BIGINT) AS gold_total,
       CAST(floor(p_retailprice * 0.5) AS BIGINT) AS gold_sell, p_size > 10 AS purchasable,
       '' AS from_items, CASE WHEN p_size > 25 THEN p_brand || ', ' || p_type ELSE '' END AS into_items,
       CAST(p_size AS BIGINT) AS depth, '14.2.0' AS dd_version
FROM part""",
}


# --- quality ----------------------------------------------------------------------

def _null_rate(column: str, missing: str) -> str:
    rate = f"(SELECT avg(CASE WHEN {missing} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FROM t)"
    return f"""
SELECT 'null_rate' AS check_name, '{column}' AS column_name, {rnd(rate, 4)} AS value,
       CASE WHEN {rate} > 0.30 THEN 'error' WHEN {rate} > 0.05 THEN 'warning' ELSE 'ok' END AS severity"""


def _bad_count(check: str, column: str, condition: str) -> str:
    count = f"(SELECT count(*) FROM t WHERE {condition})"
    return f"""
SELECT '{check}' AS check_name, '{column}' AS column_name, CAST({count} AS DOUBLE) AS value,
       CASE WHEN {count} > 0 THEN 'error' ELSE 'ok' END AS severity"""


_REQUIRED = ("match_id", "puuid", "win", "kills", "deaths", "assists", "gold_earned", "champion_name", "team_position")
ORACLE["dq_report"] = """
WITH t AS (
  SELECT l_orderkey AS match_id, l_suppkey AS puuid,
         CASE WHEN l_tax = 0.08 THEN NULL ELSE l_linestatus = 'F' END AS win,
         CAST(floor(l_quantity) AS BIGINT) - 2 AS kills, CAST(l_linenumber AS BIGINT) AS deaths,
         CAST(floor(l_quantity * 3) AS BIGINT) AS assists,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS gold_earned,
         'x' AS champion_name, nullif(l_returnflag, 'N') AS team_position,
         CAST(floor(l_discount * 9000) AS BIGINT) - 100 AS vision_score
  FROM lineitem
)
SELECT 'matches' AS table_name, *, severity <> 'error' AS passed FROM (""" + " UNION ALL ".join([
    "SELECT 'row_count' AS check_name, '' AS column_name, CAST((SELECT count(*) FROM t) AS DOUBLE) AS value, 'ok' AS severity",
    "SELECT 'missing_column', 'damage_to_champions', 1.0::DOUBLE, 'error'",
    *[_null_rate(c, f"{c} IS NULL") for c in _REQUIRED],
    *[_bad_count("negative", c, f"{c} < 0") for c in ("kills", "deaths", "assists", "gold_earned", "vision_score")],
    *[_bad_count("out_of_range", c, f"{c} NOT BETWEEN 0 AND 100") for c in ("kills", "deaths", "assists")],
    _bad_count("out_of_range", "vision_score", "vision_score NOT BETWEEN 0 AND 500"),
    """SELECT 'duplicates', 'match_id,puuid',
       CAST((SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT match_id, puuid FROM t)) AS DOUBLE),
       CASE WHEN (SELECT count(*) FROM t) > (SELECT count(*) FROM (SELECT DISTINCT match_id, puuid FROM t))
            THEN 'error' ELSE 'ok' END""",
]) + ")"


# --- player graph -------------------------------------------------------------------

def _level(name: str, frontier: str, known: str) -> str:
    """Players met from ``frontier`` through its two most recent matches, minus ``known``."""
    return f"""
{name} AS (
  SELECT DISTINCT puuid FROM edges
  WHERE match_id IN (
    SELECT match_id FROM (SELECT puuid, match_id, max(game_date) AS game_date FROM edges
                          WHERE puuid IN (SELECT puuid FROM {frontier}) GROUP BY puuid, match_id)
    QUALIFY row_number() OVER (PARTITION BY puuid ORDER BY game_date DESC, match_id) <= 2)
  AND puuid NOT IN ({known})
)"""


ORACLE["expand_players"] = """
WITH edges AS (
  SELECT l_orderkey AS match_id, 'P' || l_partkey AS puuid, l_shipdate AS game_date FROM lineitem
),
seed AS (
  SELECT 'P' || p_partkey AS puuid, p_name, CAST(p_size AS BIGINT) AS points
  FROM part WHERE p_brand = 'Brand#3' AND p_type = 'PROMO'
),""" + _level("level2", "seed", "SELECT puuid FROM seed") + "," + _level(
    "level3", "level2", "SELECT puuid FROM seed UNION ALL SELECT puuid FROM level2"
) + """
SELECT puuid, p_name AS "summonerName", points AS "leaguePoints", 'CHALLENGER' AS _tier,
       CAST(NULL AS VARCHAR) AS "riotIdGameName", CAST(NULL AS VARCHAR) AS "riotIdTagline",
       CAST(NULL AS VARCHAR) AS _queue, CAST(NULL AS VARCHAR) AS _region,
       CAST(NULL AS VARCHAR) AS _graph_level
FROM seed
UNION ALL
SELECT 'P' || p_partkey, p_name, NULL, 'GRAPH', p_name, p_brand, 'RANKED_SOLO_5x5', 'euw1', 'expanded'
FROM part
WHERE p_size <> 13
  AND 'P' || p_partkey IN (SELECT puuid FROM level2 UNION ALL SELECT puuid FROM level3)"""


# --- reports ------------------------------------------------------------------------

def favour(column: str = "winrate_pct", high: int = 55, low: int = 45) -> str:
    return (f"CASE WHEN {column} >= {high} THEN 'favourable' WHEN {column} <= {low} THEN 'unfavourable' "
            "ELSE 'neutral' END")


FAVOUR = favour()

TIERED = """
cuts AS (SELECT quantile_cont(picks, 0.5) AS half, quantile_cont(picks, 0.75) AS quarter FROM champions),
tiered AS (
  SELECT champions.*,
         CASE WHEN winrate_pct >= 54 AND picks >= quarter THEN 'S'
              WHEN winrate_pct >= 52 AND picks >= half THEN 'A'
              WHEN winrate_pct >= 48 THEN 'B' WHEN winrate_pct >= 45 THEN 'C' ELSE 'D' END AS tier
  FROM champions, cuts
)"""

ANOMALIES = """
spread AS (
  SELECT count(*) AS n, avg(winrate_pct) AS mean, stddev_samp(winrate_pct) AS std
  FROM champions WHERE picks >= 15
),
anomalies AS (
  SELECT *, CASE WHEN z > 0 THEN 'overperforming' ELSE 'underperforming' END AS direction
  FROM (SELECT champions.*, (winrate_pct - mean) / CASE WHEN std = 0 THEN 1 ELSE std END AS z, n
        FROM champions, spread WHERE picks >= 15)
  WHERE n >= 3 AND abs(z) >= 1.5
)"""

OUTLIERS = """
population AS (
  SELECT count(*) AS n, avg(avg_kda) AS km, stddev_samp(avg_kda) AS ks,
         avg(winrate_pct) AS wm, stddev_samp(winrate_pct) AS ws
  FROM players
),
scored AS (
  SELECT *, kda_z - wr_z AS gap
  FROM (SELECT players.*, (avg_kda - km) / CASE WHEN ks = 0 THEN 1 ELSE ks END AS kda_z,
               (winrate_pct - wm) / CASE WHEN ws = 0 THEN 1 ELSE ws END AS wr_z
        FROM players, population WHERE n >= 4)
),
outliers AS (
  SELECT 'carries' AS outlier_group, row_number() OVER (ORDER BY wr_z DESC NULLS LAST, summoner_name, puuid) AS place, *
  FROM scored WHERE kda_z > 0.5 AND wr_z > 0.5 QUALIFY place <= 5
  UNION ALL
  SELECT 'padders', row_number() OVER (ORDER BY gap DESC NULLS LAST, summoner_name, puuid) AS place, *
  FROM scored QUALIFY place <= 3
  UNION ALL
  SELECT 'underrated', row_number() OVER (ORDER BY gap NULLS LAST, summoner_name, puuid) AS place, *
  FROM scored QUALIFY place <= 3
)"""

OUTLIER_COLUMNS = f"""outlier_group, CAST(place AS INTEGER) AS place, puuid, summoner_name, winrate_pct, avg_kda,
       {rnd('kda_z', 6)} AS kda_z, {rnd('wr_z', 6)} AS wr_z, {rnd('gap', 6)} AS gap"""

RANKED = """
gaps AS (
  SELECT *, wr_rank - kda_rank AS gap
  FROM (SELECT *,
          CASE WHEN avg_kda IS NOT NULL THEN rank() OVER (ORDER BY avg_kda DESC NULLS LAST)
               + (count(*) OVER (PARTITION BY avg_kda) - 1) / 2.0::DOUBLE END AS kda_rank,
          CASE WHEN winrate_pct IS NOT NULL THEN rank() OVER (ORDER BY winrate_pct DESC NULLS LAST)
               + (count(*) OVER (PARTITION BY winrate_pct) - 1) / 2.0::DOUBLE END AS wr_rank
        FROM players)
)"""

TOPS = """
tops AS (
  SELECT *, row_number() OVER (PARTITION BY puuid ORDER BY games_played DESC, champion_name,
                               team_position NULLS FIRST) AS place
  FROM player_champions QUALIFY place <= 5
)"""


def share(column: str) -> str:
    """Average ascending rank over the non-null count, by position."""
    return f"""CASE WHEN {column} IS NOT NULL THEN
      (rank() OVER (PARTITION BY team_position ORDER BY {column} NULLS LAST)
       + (count({column}) OVER (PARTITION BY team_position, {column}) - 1) / 2.0::DOUBLE)
      / count({column}) OVER (PARTITION BY team_position) END"""


PLAIN_PICKS = f"""SELECT l_orderkey AS lineup_id, {POSITION} AS position, p_brand AS champion_name
  FROM lineitem JOIN part ON p_partkey = l_partkey"""
PICKS = f"""
picks AS (
  {PLAIN_PICKS}
),
rated AS (
  SELECT *, coalesce(champion_wr * confidence + position_baseline * (1 - confidence), position_baseline) AS effective_wr
  FROM (SELECT lineup_id, position, picks.champion_name, c.winrate_pct AS champion_wr,
               coalesce(c.picks, 0) AS picks, coalesce(q.winrate_pct, 50.0::DOUBLE) AS position_baseline,
               coalesce(least(1.0::DOUBLE, c.picks / 50.0::DOUBLE), 0.0::DOUBLE) AS confidence
        FROM picks
        LEFT JOIN champions c ON c.champion_name = picks.champion_name AND c.team_position = position
        LEFT JOIN positions q ON q.team_position = position)
)"""


def _anomaly_days(metric: str) -> str:
    return over(TIMELINE, select=f"""
SELECT game_day, CAST({metric} AS DOUBLE) AS value,
       CASE WHEN count({metric}) OVER w = 7 THEN {rnd(f'avg({metric}) OVER w', 6)} END AS ma7,
       coalesce(abs({metric} - (SELECT avg({metric}) FROM timeline))
                > 2 * (SELECT stddev_samp({metric}) FROM timeline), false) AS anomaly
FROM timeline
WINDOW w AS (ORDER BY game_day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")


def _delta(metric: str) -> str:
    early = f"(SELECT avg({metric}) FROM (FROM timeline ORDER BY game_day LIMIT 7))"
    late = f"(SELECT avg({metric}) FROM (FROM timeline ORDER BY game_day DESC LIMIT 7))"
    return f"""SELECT '{metric}' AS metric, {rnd(early, 6)} AS early, {rnd(late, 6)} AS late,
       {rnd(f'({late} - {early}) / nullif({early}, 0) * 100', 6)} AS delta_pct"""


def _radar(metric: str) -> str:
    low, high = f"(SELECT min({metric}) FROM positions)", f"(SELECT max({metric}) FROM positions)"
    scaled = rnd(f"({metric} - {low}) / nullif({high} - {low}, 0)", 6)
    return f"CASE WHEN {high} > {low} THEN {scaled} ELSE 0.5::DOUBLE END AS {metric}"


PLAN = f"""
best AS (SELECT * FROM positions WHERE winrate_pct IS NOT NULL ORDER BY winrate_pct DESC, team_position LIMIT 1),
worst AS (SELECT * FROM positions WHERE winrate_pct IS NOT NULL ORDER BY winrate_pct, team_position DESC LIMIT 1),
plan AS (
  (SELECT 1 AS priority, 'strongest_champion' AS kind, champion_name AS subject, team_position AS position,
          winrate_pct, picks, CAST(NULL AS DOUBLE) AS gap, CAST(NULL AS VARCHAR) AS contrast,
          CAST(NULL AS DOUBLE) AS contrast_winrate_pct
   FROM tiered WHERE tier = 'S' ORDER BY picks DESC, champion_name, team_position LIMIT 1)
  UNION ALL
  (SELECT 2, 'champion_to_avoid', champion_name, team_position, winrate_pct, picks, NULL, NULL, NULL
   FROM anomalies WHERE direction = 'underperforming' ORDER BY z, champion_name, team_position LIMIT 1)
  UNION ALL
  (SELECT 3, 'position_edge', best.team_position, best.team_position, best.winrate_pct, NULL, NULL,
          worst.team_position, worst.winrate_pct
   FROM best, worst WHERE best.winrate_pct - worst.winrate_pct > 3)
  UNION ALL
  (SELECT * FROM (SELECT 4, 'stats_without_wins', summoner_name, NULL, winrate_pct, NULL, gap, NULL, NULL
   FROM scored WHERE gap IS NOT NULL ORDER BY gap DESC, summoner_name, puuid LIMIT 1) WHERE gap > 0.8)
  UNION ALL
  (SELECT * FROM (SELECT 5, 'wins_without_stats', summoner_name, NULL, winrate_pct, NULL, gap, NULL, NULL
   FROM scored WHERE gap IS NOT NULL ORDER BY gap, summoner_name, puuid LIMIT 1) WHERE gap < -0.8)
)"""

EARLY = "(SELECT avg(avg_damage) FROM (FROM timeline ORDER BY game_day LIMIT 7))"
LATE = "(SELECT avg(avg_damage) FROM (FROM timeline ORDER BY game_day DESC LIMIT 7))"

ORACLE |= {
    "meta_tiers": over(CHAMPIONS, TIERED, select="SELECT champion_name, team_position, picks, winrate_pct, tier FROM tiered"),
    "tier_counts": over(CHAMPIONS, TIERED, select="""
SELECT d.tier, count(t.tier) AS champions
FROM (VALUES ('S'), ('A'), ('B'), ('C'), ('D')) d(tier)
LEFT JOIN tiered t ON t.tier = d.tier AND t.picks >= 10 GROUP BY d.tier"""),
    "strongest_champions": over(CHAMPIONS, TIERED, select="""
SELECT champion_name, team_position, tier, winrate_pct, picks
FROM tiered WHERE picks >= 10 AND tier IN ('S', 'A')"""),
    "wr_anomalies": over(CHAMPIONS, ANOMALIES, select=f"""
SELECT champion_name, team_position, picks, winrate_pct, {rnd('z', 6)} AS z_score, direction FROM anomalies"""),
    "pick_quadrants": over(CHAMPIONS, TIERED, select="""
SELECT champion_name, team_position, picks, winrate_pct, tier, median_picks,
       CASE WHEN picks >= median_picks THEN 'often' ELSE 'seldom' END || '_' ||
       CASE WHEN winrate_pct >= 50 THEN 'winning' ELSE 'losing' END AS quadrant
FROM tiered, (SELECT median(picks) AS median_picks FROM tiered WHERE picks >= 8)
WHERE picks >= 8"""),
    "champion_bars": over(CHAMPIONS, select=f"""
SELECT champion_name, team_position, picks, winrate_pct, avg_kda, avg_damage, {FAVOUR} AS favour
FROM champions WHERE picks >= 10 ORDER BY picks DESC, champion_name, team_position LIMIT 15"""),
    "lineup_candidates": over(CHAMPIONS, select="""
SELECT DISTINCT CAST(list_position(['TOP', 'JUNGLE', 'MID', 'BOTTOM', 'SUPPORT'], team_position) AS INTEGER)
       AS position_order, team_position, champion_name
FROM champions WHERE team_position IN ('TOP', 'JUNGLE', 'MID', 'BOTTOM', 'SUPPORT')"""),
    "champion_table": over(CHAMPIONS, select="""
SELECT champion_name, team_position, picks, winrate_pct, avg_kda, avg_damage FROM champions"""),
    "player_outliers": over(PLAYERS, OUTLIERS, select=f"SELECT {OUTLIER_COLUMNS} FROM outliers"),
    "outlier_cards": over(PLAYERS, OUTLIERS, select=f"""
SELECT {OUTLIER_COLUMNS} FROM outliers
WHERE place <= 3 AND (outlier_group = 'carries' OR (outlier_group = 'padders' AND gap > 0.3)
                      OR (outlier_group = 'underrated' AND gap < -0.3))"""),
    "avg_rank_gap": over(PLAYERS, RANKED, select="""
SELECT puuid, summoner_name, avg_kda, winrate_pct, kda_rank, wr_rank, gap FROM gaps"""),
    "player_flags": over(PLAYERS, select=f"""
SELECT puuid, summoner_name, avg_kda, winrate_pct, avg_vision, avg_cs,
       coalesce(avg_kda >= 3, false) AS avg_kda_good, coalesce(winrate_pct >= 50, false) AS winrate_pct_good,
       coalesce(avg_vision >= 40, false) AS avg_vision_good, coalesce(avg_cs >= 160, false) AS avg_cs_good,
       {FAVOUR} AS favour
FROM players"""),
    "marker_sizes": over(PLAYERS, select=f"""
SELECT puuid, summoner_name, avg_kda, winrate_pct, games_played, {FAVOUR} AS favour,
       {rnd('CAST(games_played AS DOUBLE) / (SELECT max(games_played) FROM players) * 30 + 8', 1)} AS marker_size
FROM players"""),
    "player_table": over(PLAYERS, select="""
SELECT summoner_name, main_position, most_played_champion, games_played, winrate_pct, avg_kda,
       avg_damage, avg_cs
FROM players"""),
    "top_champions_per_player": over(PLAYER_CHAMPIONS, TOPS, select=f"""
SELECT puuid, champion_name, team_position, games_played, winrate_pct, avg_kda, CAST(place AS INTEGER) AS place,
       {rnd('CAST(games_played AS DOUBLE) / sum(games_played) OVER (PARTITION BY puuid) * 100', 6)} AS share_pct,
       {favour('winrate_pct', 52, 48)} AS favour
FROM tops"""),
    "player_style": over(PLAYER_CHAMPIONS, TOPS, select=f"""
SELECT puuid,
       CASE WHEN damage > 20000 AND kda < 3.2 THEN 'aggressive' WHEN vision > 45 THEN 'support'
            WHEN kda > 4.0 THEN 'careful' ELSE 'universal' END AS style,
       CASE WHEN top1 > 0.6 THEN 'one_trick' WHEN top1 > 0.4 THEN 'narrow' ELSE 'flexible' END AS pool_type,
       {rnd('top1 * 100', 0)} AS top1_share, {rnd('damage', 0)} AS avg_damage,
       {rnd('vision', 1)} AS avg_vision, {rnd('kda', 2)} AS avg_kda
FROM (SELECT puuid, CAST(max(games_played) AS DOUBLE) / sum(games_played) AS top1,
             CAST(sum(CAST(avg_damage * games_played AS DECIMAL(28, 9))) AS DOUBLE) / sum(games_played) AS damage,
             CAST(sum(CAST(avg_vision * games_played AS DECIMAL(28, 9))) AS DOUBLE) / sum(games_played) AS vision,
             CAST(sum(CAST(avg_kda * games_played AS DECIMAL(28, 9))) AS DOUBLE) / sum(games_played) AS kda
      FROM tops GROUP BY puuid)"""),
    "recommend_champions": over(PLAYERS, CHAMPIONS, select=f"""
, shares AS (
  SELECT *, {share('avg_damage')} AS damage_share, {share('avg_vision')} AS vision_share,
         {share('avg_kda')} AS kda_share, {share('picks')} AS picks_share,
         median(avg_damage) OVER (PARTITION BY team_position) AS damage_mid,
         median(avg_vision) OVER (PARTITION BY team_position) AS vision_mid
  FROM champions
),
pairs AS (
  SELECT q.puuid, q.summoner_name, q.main_position, s.champion_name, s.winrate_pct, s.picks, s.avg_kda,
         s.damage_share, s.vision_share, s.kda_share, s.picks_share,
         coalesce(q.avg_kda < 2.5 AND q.avg_damage > damage_mid, false) AS aggressive,
         coalesce(q.avg_vision > vision_mid * 1.3::DOUBLE, false) AS supportive,
         coalesce(q.avg_kda > 4.0, false) AS safe
  FROM players q JOIN shares s ON s.team_position = q.main_position
  WHERE s.picks >= 10 AND s.champion_name <> coalesce(q.most_played_champion, '')
),
fitted AS (
  SELECT *, CASE WHEN aggressive THEN damage_share * 40 ELSE 0 END
            + CASE WHEN supportive THEN vision_share * 40 ELSE 0 END
            + CASE WHEN safe THEN kda_share * 40 ELSE 0 END
            + CASE WHEN aggressive OR supportive OR safe THEN 0 ELSE 20 END
            + (winrate_pct - 50) * 1.5::DOUBLE + picks_share * 10 AS fit
  FROM pairs
)
SELECT puuid, summoner_name, main_position,
       CASE WHEN aggressive THEN 'aggressive' WHEN supportive THEN 'supportive'
            WHEN safe THEN 'safe' ELSE 'balanced' END AS style_label,
       CAST(row_number() OVER (PARTITION BY puuid, summoner_name ORDER BY fit DESC NULLS LAST, champion_name)
            AS INTEGER) AS place,
       champion_name, winrate_pct, picks, avg_kda, {rnd('fit', 6)} AS fit_score
FROM fitted QUALIFY place <= 5"""),
    "lineup_breakdown": over(CHAMPIONS, POSITIONS, PICKS, select=f"""
SELECT lineup_id, position, champion_name, champion_wr, picks, position_baseline,
       {rnd('effective_wr', 1)} AS effective_wr, {rnd('confidence * 100', 0)} AS confidence
FROM rated"""),
    "predict_lineup_winrate": over(CHAMPIONS, POSITIONS, PICKS, select=f"""
SELECT lineup_id, roles, {rnd('least(80.0::DOUBLE, greatest(20.0::DOUBLE, mean_wr + synergy_bonus))', 1)} AS predicted_wr,
       synergy_bonus, {favour('predicted_wr', 52, 48)} AS favour,
       CASE WHEN synergy_bonus > 0 THEN 'balanced' WHEN synergy_bonus < 0 THEN 'no_support' ELSE 'standard' END AS synergy_note
FROM (SELECT lineup_id, count(*) AS roles,
             CAST(sum(CAST(effective_wr AS DECIMAL(28, 9))) AS DOUBLE) / count(*) AS mean_wr,
             CASE WHEN bool_or(position IN ('TOP', 'JUNGLE')) AND bool_or(position IN ('MID', 'BOTTOM'))
                       AND bool_or(position = 'SUPPORT') THEN 1.0::DOUBLE
                  WHEN NOT coalesce(bool_or(position = 'SUPPORT'), false) THEN -1.5::DOUBLE ELSE 0.0::DOUBLE END AS synergy_bonus
      FROM rated GROUP BY lineup_id)"""),
    "timeline_anomalies": _anomaly_days("avg_damage"),
    "timeline_anomalies_duration": _anomaly_days("avg_duration_min"),
    "period_delta": over(TIMELINE, select=" UNION ALL ".join(
        _delta(m) for m in ("avg_damage", "avg_duration_min", "avg_kills", "total_matches"))),
    "position_radar": over(POSITIONS, select="SELECT team_position, " + ", ".join(
        _radar(m) for m in ("winrate_pct", "avg_kills", "avg_damage", "avg_gold", "avg_vision")) + " FROM positions"),
    "item_report": over(ITEMS, select=f"""
SELECT *, {FAVOUR} AS favour FROM items ORDER BY total_purchases DESC, item_id NULLS LAST LIMIT 30"""),
    "action_plan": over(CHAMPIONS, PLAYERS, POSITIONS, TIERED, ANOMALIES, OUTLIERS, PLAN, select=f"""
SELECT * REPLACE ({rnd('gap', 6)} AS gap) FROM plan"""),
    "insights": over(CHAMPIONS, PLAYERS, POSITIONS, TIMELINE, RANKED, select=f"""
, notes AS (
  (SELECT 1 AS place, 'META' AS tag, CAST(NULL AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS detail,
          avg(winrate_pct) AS value, CAST(NULL AS DOUBLE) AS extra FROM players HAVING avg(winrate_pct) > 52)
  UNION ALL
  (SELECT 2, 'PICK TREND', champion_name, team_position, winrate_pct, CAST(picks AS DOUBLE)
   FROM champions ORDER BY picks DESC, champion_name, team_position LIMIT 1)
  UNION ALL
  (FROM (SELECT 3, 'BROKEN', champion_name, team_position, winrate_pct, CAST(picks AS DOUBLE) FROM champions
   WHERE picks >= 30 ORDER BY winrate_pct DESC NULLS LAST, champion_name, team_position LIMIT 1)
   WHERE winrate_pct >= 55)
  UNION ALL
  (SELECT 4, 'DAMAGE TREND', NULL, CASE WHEN {LATE} > {EARLY} THEN 'up' ELSE 'down' END,
          abs(({LATE} - {EARLY}) / {EARLY} * 100), NULL
   WHERE abs(({LATE} - {EARLY}) / {EARLY} * 100) > 5 AND (SELECT count(*) FROM timeline) >= 14)
  UNION ALL
  (SELECT 5, 'POSITION EDGE', team_position, NULL, winrate_pct, avg_damage FROM positions
   ORDER BY winrate_pct DESC NULLS LAST, team_position LIMIT 1)
  UNION ALL
  (SELECT 6, 'STAT PADDING', summoner_name, NULL, kda_rank, wr_rank
   FROM (FROM gaps WHERE gap IS NOT NULL ORDER BY gap DESC, summoner_name, puuid LIMIT 1) WHERE gap > 5)
)
SELECT * REPLACE ({rnd('value', 6)} AS value) FROM notes"""),
    "balance_health": over(CHAMPIONS, PLAYERS, POSITIONS, TIERED, ANOMALIES, OUTLIERS, PLAN, select=f"""
SELECT CASE WHEN overperforming <= 1 THEN 'balanced' WHEN overperforming <= 3 THEN 'attention'
            ELSE 'unbalanced' END AS balance, overperforming,
       (SELECT count(*) FROM tiered WHERE tier = 'S') AS s_tier_champions,
       (SELECT count(*) FROM plan) AS actions, (SELECT count(*) FROM players) AS players,
       (SELECT count(*) FROM champions) AS champion_rows,
       {rnd('(SELECT avg(winrate_pct) FROM players)', 6)} AS mean_winrate_pct
FROM (SELECT count(*) AS overperforming FROM anomalies WHERE direction = 'overperforming')"""),
}

ORACLE |= {
    f"merged_{name}": ORACLE[f"mart_{name}"]
    for name in ("player_stats", "player_champion_stats", "champion_stats", "position_stats")
}

ORACLE |= {
    "variant_matches": ORACLE["flatten_dedup"],
    "flatten_dedup_narrow": ORACLE["flatten_dedup"],
    "variant_typed_fields": ORACLE["flatten_typed_fields"],
    "catalog_top_players": ORACLE["vw_top_players"],
    "catalog_names": over(PLAYERS, TIMELINE, select="""
SELECT unnest(['mart_player_stats', 'vw_top_players', 'mart_match_timeline', 'vw_timeline_trends']) AS name,
       unnest([(SELECT count(*) FROM players), (SELECT count(*) FROM players WHERE games_played >= 5),
               (SELECT count(*) FROM timeline), (SELECT count(*) FROM timeline)]) AS n"""),
    "loaded_player_stats": f"{RECORDS}, fact AS (SELECT * FROM records {FIRST}), {PLAYERS} SELECT * FROM players",
    "champion_dictionary_files": ORACLE["flatten_champion_dictionary"],
    "item_dictionary_files": ORACLE["flatten_item_dictionary"],
    "refreshed_positions": over(POSITIONS, select="""
SELECT team_position, total_games, true AS stamped, CAST(1 AS BIGINT) AS times FROM positions"""),
    "balance_by_position": over(CHAMPIONS, select="""
SELECT team_position, count(*) AS champions, overperforming,
       CASE WHEN overperforming <= 1 THEN 'balanced' WHEN overperforming <= 3 THEN 'attention' ELSE 'unbalanced' END AS balance
FROM (
  SELECT team_position, count(*) FILTER (WHERE n >= 3 AND (winrate_pct - mean) / CASE WHEN std = 0 THEN 1 ELSE std END >= 1.5)
           OVER (PARTITION BY team_position) AS overperforming
  FROM (SELECT team_position, winrate_pct, count(*) OVER w AS n, avg(winrate_pct) OVER w AS mean, stddev_samp(winrate_pct) OVER w AS std
        FROM champions WHERE picks >= 15 WINDOW w AS (PARTITION BY team_position)))
GROUP BY team_position, overperforming"""),
}

# The same SQL over the varied reading, whose line-ups are the picks of the fact.
VARIED_FACT = f"fact AS ({VARIED})"
VARIED_PICKS = "SELECT match_id AS lineup_id, team_position AS position, champion_name FROM fact"
ORACLE |= {
    f"{name}_varied": ORACLE[name].replace(FACT, VARIED_FACT).replace(PLAIN_PICKS, VARIED_PICKS)
    for name in VARIED_QUERIES
}

ORACLE |= {
    "flatten_two_loads": ORACLE["flatten_dedup"],
    "stream_two_loads": ORACLE["flatten_dedup"],
    "ledger_lookup": f"""{RECORDS},
wanted AS (SELECT 'M' || o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100),
first_lines AS (
  SELECT l_orderkey, {RAW_ORDER} FROM lineitem WHERE 'M' || l_orderkey IN (SELECT id FROM wanted)
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {RAW_ORDER}) = 1
)
SELECT r.* EXCLUDE (place, l_quantity, {RAW_ORDER}) FROM records r JOIN first_lines f
  ON r.match_id = 'M' || f.l_orderkey AND r.l_linenumber = f.l_linenumber AND r.l_partkey = f.l_partkey
 AND r.l_suppkey = f.l_suppkey AND r.l_extendedprice = f.l_extendedprice""",
    "players_table": ORACLE["player_winrate"],
    "marts_read_back": ORACLE["vw_meta_champions"],
    "one_player": over(PLAYER_CHAMPIONS, select="""
SELECT puuid, champion_name, team_position, games_played FROM player_champions WHERE puuid = 7"""),
    "dq_summary": f"""
SELECT table_name, CAST(max(CASE WHEN check_name = 'row_count' THEN value END) AS BIGINT) AS n_rows,
       coalesce(string_agg(CASE WHEN severity = 'error' THEN code END, ' ' ORDER BY code), '') AS failed,
       coalesce(string_agg(CASE WHEN severity = 'warning' THEN code END, ' ' ORDER BY code), '') AS doubtful
FROM (SELECT *, check_name || ':' || column_name AS code FROM ({ORACLE["dq_report"]}))
GROUP BY table_name""",
    "dq_empty_table": """
SELECT 'matches' AS table_name, 'row_count' AS check_name, '' AS column_name,
       CAST(count(*) AS DOUBLE) AS value, 'error' AS severity, false AS passed
FROM lineitem WHERE l_quantity < -998""",
}
