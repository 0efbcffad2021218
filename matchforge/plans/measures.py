"""Aggregate measures as mergeable totals.

Every averaged mart measure is a sum and a count of non-null values. Totals can
be taken at a fine grain once, merged to any coarser grain, and turned into the
published measures at the end, so several marts share one pass over the fact.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.functions.numeric import ratio, round_to

# Row-level quantities that are averaged somewhere, as SQL over the fact.
QUANTITIES: dict[str, str] = {
    "win": "CAST(win AS INT)",
    "kills": "kills",
    "deaths": "deaths",
    "assists": "assists",
    "takedowns": "kills + assists",
    "gold": "gold_earned",
    "damage": "damage_to_champions",
    "vision": "vision_score",
    "cs": "minions_killed + neutral_minions_killed",
    "duration": "game_duration",
}


def row_totals(quantities: Iterable[str]) -> list[Column]:
    """Aggregates over fact rows: the row count, and sum and count per quantity."""
    columns = [F.count(F.lit(1)).alias("rows")]
    for name in quantities:
        value = F.expr(QUANTITIES[name])
        columns.append(F.sum(value).alias(f"sum_{name}"))
        columns.append(F.count(value).alias(f"n_{name}"))
    return columns


def merged_totals(quantities: Iterable[str]) -> list[Column]:
    """The same aggregates over rows that already hold totals."""
    names = ["rows", *[f"{part}_{name}" for name in quantities for part in ("sum", "n")]]
    return [F.sum(name).alias(name) for name in names]


def totals(fact: DataFrame, keys: Sequence[str], quantities: Iterable[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(*row_totals(quantities))


def merge(cells: DataFrame, keys: Sequence[str], quantities: Iterable[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(*merged_totals(quantities))


def mean(name: str) -> Column:
    return ratio(F.col(f"sum_{name}"), F.col(f"n_{name}"))


def average(name: str, digits: int) -> Column:
    return round_to(mean(name), digits)


def winrate_pct() -> Column:
    return round_to(mean("win") * F.lit(100), 1)


def kda() -> Column:
    """Mean of kills plus assists over mean deaths; null without deaths."""
    return round_to(ratio(mean("takedowns"), mean("deaths")), 2)
