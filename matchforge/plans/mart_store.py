"""Marts kept up to date load by load from mergeable cells.

A store holds the participant fact and what the marts are merged from, all by period
(calendar month by default) and therefore replaceable period by period:

    numbers/      match_id -> match_no, dense, in the order matches were first played
    fact/         participants, by period and load
    cells/        totals by player, champion and position
    games/        the matches of a player, one row per row of the fact
    days/         totals by calendar day
    day_matches/  the matches of a day, one row per row of the fact
    purchases/    purchases and wins by item id

A load appends its rows to the fact and has the cells of the periods it touches taken again,
from those periods of the fact only (partition filter); every other period stays as it is on
disk. Sums and counts merge by adding, distinct matches by counting each id once, so the marts
equal those of a full build. A load has a name: repeated after a failure it replaces its own rows.

The matches of players and days are narrow copies of the fact's rows, written as they are read.
Bitmaps over match numbers are smaller only where a key has many neighbouring matches: a player
has few, and one bitmap of 4 KB for nearly each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchforge.plans import marts
from matchforge.plans.measures import merge, totals
from matchforge.session import COMPACT, hadoop_path, stage
from matchforge.sources.raw import read_parquet_if_present

MONTH = "yyyy-MM"
DAY = "yyyy-MM-dd"
# The period of rows without a date.
UNDATED = "undated"
# Up to this number of periods, each task writes its own file in every one; rows of more are dealt by period.
FEW_PERIODS = 16
_DYNAMIC = {"partitionOverwriteMode": "dynamic", **COMPACT}


def period_of(game_date: Column, pattern: str) -> Column:
    return F.coalesce(F.date_format(game_date, pattern), F.lit(UNDATED))


def match_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct matches of each key as bitmaps over ``match_no``, one per bucket of numbers."""
    return (
        rows.filter(F.col("match_no").isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number("match_no").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("match_no")).alias("matches"))
    )


def known_matches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The known matches of each key, copies included."""
    return rows.filter(F.col("match_id").isNotNull()).select(*keys, "match_id")


def count_matches(met: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different matches each key has."""
    return met.select(*keys, "match_id").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_matches(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many matches the bitmaps of each key hold together."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("matches").alias("matches"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("matches")).alias(name))


class MartStore:
    """The folder of a store; ``period`` is the date pattern its tables are cut by."""

    def __init__(self, spark: SparkSession, path: str, period: str = MONTH):
        self.spark, self.path, self.period = spark, path.rstrip("/"), period

    def read(self, table: str) -> DataFrame | None:
        # periods look like numbers or dates, but are text
        return read_parquet_if_present(self.spark, f"{self.path}/{table}", self._ddl(table))

    def _ddl(self, table: str) -> str | None:
        files, folder = hadoop_path(self.spark, f"{self.path}/{table}")
        if table == "numbers" or not files.exists(folder):
            return None
        known = self.spark.read.parquet(f"{self.path}/{table}").schema
        kept = [f for f in known.fields if f.name not in ("period", "load")]
        partitions = ["period STRING", "load STRING"] if table == "fact" else ["period STRING"]
        return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *partitions])

    def _replace(self, df: DataFrame, table: str, *partitions: str, periods: int) -> None:
        """Write ``df`` over the partitions it has rows in; ``periods`` is their number."""
        # whole periods per task, large ones split by the sizes that adaptive execution measures
        spread = df.hint("rebalance", *partitions) if periods > FEW_PERIODS else df
        spread.write.mode("overwrite").options(**_DYNAMIC).partitionBy(*partitions).parquet(f"{self.path}/{table}")

    def number(self, rows: DataFrame) -> None:
        """Give the matches of ``rows`` that are met for the first time the next numbers, by date."""
        met = (
            rows.filter(F.col("match_id").isNotNull())
            .groupBy("match_id").agg(F.min("game_date").alias("game_date")))
        known = self.read("numbers")
        first = 1
        if known is not None:
            met = met.join(known.select("match_id"), "match_id", "left_anti")
            first += known.agg(F.coalesce(F.max("match_no"), F.lit(0))).first()[0]
        ordered = met.repartitionByRange("game_date", "match_id").sortWithinPartitions("game_date", "match_id")
        # a task's rows are numbered within it, then moved behind those of the tasks before it
        placed = stage(ordered.select("match_id", F.monotonically_increasing_id().alias("place")), "placed_matches")
        task, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
        placed = placed.select("match_id", task.alias("task"), row.alias("row"))
        before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        offsets = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n")).select(
            "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        numbered = placed.join(offsets, "task").select(
            "match_id", (F.lit(first) + F.col("offset") + F.col("row")).cast("long").alias("match_no"))
        numbered.write.mode("append").parquet(f"{self.path}/numbers")

    def add(self, load: str, rows: DataFrame, *, staged: bool = False) -> list[str]:
        """Add participants under the name of their load; returns the periods whose cells were taken again.

        ``rows`` are participants as the flattening gives them; those another load has brought are
        left out with ``without_known``, or by the flattening if told which they are (``known``). They are
        read three times, so they are staged first unless they come from a ``staged`` table. Nothing is done for an empty load.
        """
        period = period_of(F.col("game_date"), self.period)
        landed = rows.withColumns({"period": period, "load": F.lit(load)})
        if not staged:
            landed = stage(landed, "load")
        periods = sorted(r.period for r in landed.select("period").distinct().collect())  # one per period
        if periods:
            self.number(landed)
            self._replace(landed, "fact", "period", "load", periods=len(periods))
            self.refresh(periods)
        return periods

    def known(self, load: str, records: DataFrame) -> DataFrame | None:
        """The (match, player) pairs that another load has brought, of the matches that ``records`` name; None if there are none.

        Only matches that have a number can be there already; without any, or with nothing but
        new ones, the fact is not looked at.
        """
        fact, numbers = self.read("fact"), self.read("numbers")
        if fact is None:
            return None
        met = records.select("match_id").distinct().join(numbers, "match_id", "left")
        met = stage(met.filter(F.col("match_no").isNotNull() | F.col("match_id").isNull()), "met_again")
        if met.isEmpty():
            return None
        others = fact.filter(F.col("load") != load).select(F.col("match_id").alias("__match"), F.col("puuid").alias("__player"))
        return others.join(met, F.col("__match").eqNullSafe(met["match_id"]), "left_semi")

    def without_known(self, load: str, rows: DataFrame) -> DataFrame:
        """``rows`` without the (match, player) pairs that another load has brought."""
        known = self.known(load, rows)
        if known is None:
            return rows
        same = rows["match_id"].eqNullSafe(known["__match"]) & rows["puuid"].eqNullSafe(known["__player"])
        return rows.join(known, same, "left_anti")

    def touched(self, periods: Sequence[str]) -> DataFrame:
        """The fact of some periods; no file of another one is read."""
        return self.read("fact").filter(F.col("period").isin(list(periods)))

    def refresh(self, periods: Sequence[str]) -> None:
        """Take the cells of some periods from the fact again."""
        rows = self.touched(periods)
        dated = rows.filter(F.col("game_date").isNotNull()).withColumn("game_day", F.col("game_date").cast("date"))
        players = rows.filter(F.col("puuid").isNotNull())
        for table, cells in {
            "cells": totals(rows, ["period", *marts.CELL], marts.PLAYER_QUANTITIES),
            "games": known_matches(players, ["period", *marts.PLAYER]),
            "days": totals(dated, ["period", "game_day"], marts.DAY_QUANTITIES),
            "day_matches": known_matches(dated, ["period", "game_day"]),
            "purchases": totals(marts.purchases(rows, "period"), ["period", "slot_item"], ["win"]),
        }.items():
            self._replace(cells, table, "period", periods=len(periods))

    def marts(self, items: DataFrame | None = None) -> dict[str, DataFrame]:
        """The marts of everything loaded, merged from the cells; the fact is not read."""
        cells = self.read("cells")
        if cells is None:
            return {}
        games = count_matches(self.read("games"), marts.PLAYER, "games_played")
        matches = count_matches(self.read("day_matches"), ["game_day"], "total_matches")
        built = {
            "mart_player_stats": marts.player_stats(None, cells, games),
            "mart_player_champion_stats": marts.player_champion_stats(None, cells),
            "mart_champion_stats": marts.champion_stats(None, cells),
            "mart_position_stats": marts.position_stats(None, cells),
            "mart_match_timeline": marts.timeline_of(
                merge(self.read("days"), ["game_day"], marts.DAY_QUANTITIES).join(matches, "game_day", "left")),
        }
        if items is not None:
            bought = merge(self.read("purchases"), ["slot_item"], ["win"])
            built["mart_item_popularity"] = marts.popularity_of(bought, items)
        return built
