"""Data-quality checks of a processed table as one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.functions.numeric import round_to


@dataclass(frozen=True)
class Rules:
    """What is checked for one kind of table."""

    required: Sequence[str] = ()
    keys: Sequence[str] = ()
    non_negative: Sequence[str] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)


# Rules per processed table, and the null-rate thresholds.
RULES: dict[str, Rules] = {
    "matches": Rules(
        required=("match_id", "puuid", "win", "kills", "deaths", "assists",
                  "gold_earned", "damage_to_champions", "champion_name", "team_position"),
        keys=("match_id", "puuid"),
        non_negative=("kills", "deaths", "assists", "gold_earned",
                      "damage_to_champions", "vision_score"),
        ranges={"kills": (0, 100), "deaths": (0, 100), "assists": (0, 100),
                "vision_score": (0, 500)},
    ),
    "players": Rules(
        required=("puuid", "wins", "losses"),
        keys=("puuid",),
        non_negative=("wins", "losses", "leaguePoints"),
        ranges={"winrate": (0.0, 1.0)},
    ),
    "champions": Rules(
        required=("champion_id", "champion_name"),
        keys=("champion_id",),
        non_negative=("hp", "attackdamage"),
    ),
    "items": Rules(
        required=("item_id", "item_name"),
        keys=("item_id",),
        non_negative=("gold_total",),
    ),
}
NULL_ERROR_ABOVE = 0.30
NULL_WARNING_ABOVE = 0.05


def _check(table: str, check: str, column: str, value: Column, severity: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        value.cast("double").alias("value"),
        severity.alias("severity"),
    )


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def quality_checks(
    df: DataFrame, table: str, *, rules: Rules | None = None, null_threshold: float = NULL_ERROR_ABOVE
) -> DataFrame:
    """Every check of ``table`` as (table_name, check_name, column_name, value, severity, passed).

    All counting checks share one pass that reduces to a single row per task;
    only the key columns are shuffled, for the duplicate count. An empty table
    fails at once and reports nothing else.
    """
    rules = rules or RULES.get(table, Rules())
    number = {
        c: F.col(c).try_cast("double")
        for c in {*rules.non_negative, *rules.ranges} if c in df.columns
    }
    totals = {"rows": F.count(F.lit(1))}
    checks: list[Column] = []

    rows = F.col("rows")
    ok = F.lit("ok")

    def fails_when(condition: Column) -> Column:
        return F.when(condition, F.lit("error")).otherwise(ok)

    for c in rules.required:
        if c not in df.columns:
            checks.append(_check(table, "missing_column", c, F.lit(1), F.lit("error")))
            continue
        totals[f"null_{c}"] = _count_if(F.col(c).isNull())
        rate = F.col(f"null_{c}") / rows
        severity = F.when(rate > null_threshold, F.lit("error")).otherwise(
            F.when(rate > NULL_WARNING_ABOVE, F.lit("warning")).otherwise(ok)
        )
        checks.append(_check(table, "null_rate", c, round_to(rate, 4), severity))
    for c in rules.non_negative:
        if c in number:
            totals[f"neg_{c}"] = _count_if(number[c] < 0)
            checks.append(_check(table, "negative", c, F.col(f"neg_{c}"), fails_when(F.col(f"neg_{c}") > 0)))
    for c, (low, high) in rules.ranges.items():
        if c in number:
            totals[f"out_{c}"] = _count_if((number[c] < low) | (number[c] > high))
            checks.append(_check(table, "out_of_range", c, F.col(f"out_{c}"), fails_when(F.col(f"out_{c}") > 0)))

    counted = df.agg(*[total.alias(name) for name, total in totals.items()])
    row_check = _check(table, "row_count", "", rows, fails_when(rows == 0))
    everything = F.array(row_check, *checks)
    result = counted.select(
        F.explode(F.when(rows == 0, F.array(row_check)).otherwise(everything)).alias("c")
    ).select("c.*")

    keys = [k for k in rules.keys if k in df.columns]
    if keys:
        copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("copies")
        )
        check = _check(table, "duplicates", ",".join(keys), F.col("copies"), fails_when(F.col("copies") > 0))
        result = result.unionByName(
            copies.filter(rows > 0).select(F.explode(F.array(check)).alias("c")).select("c.*")
        )
    return result.withColumn("passed", F.col("severity") != "error")


def quality_summary(df: DataFrame, table: str, *, null_threshold: float = NULL_ERROR_ABOVE) -> DataFrame:
    """The checks of a table in one row: its rows, and the codes of what failed and what is doubtful.

    A code is ``check:column`` (``null_rate:kills``); the measured values stay in ``quality_checks``.
    """
    checks = quality_checks(df, table, null_threshold=null_threshold)
    code = F.concat_ws(":", "check_name", "column_name")
    codes = lambda severity: F.sort_array(F.collect_list(F.when(F.col("severity") == severity, code)))
    return checks.groupBy("table_name").agg(
        F.max(F.when(F.col("check_name") == "row_count", F.col("value"))).cast("long").alias("n_rows"),
        codes("error").alias("failed"), codes("warning").alias("doubtful"))


def gate(df: DataFrame, table: str) -> DataFrame:
    """``df`` itself if its table has no failed check; a ``ValueError`` with the codes otherwise."""
    failed = quality_summary(df, table).first()["failed"]
    if failed:
        raise ValueError(f"{table}: {', '.join(failed)}")
    return df
