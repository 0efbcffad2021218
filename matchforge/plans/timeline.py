"""Reports over the daily mart, whose size is bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The metrics of a day that are looked at.
METRICS = ("avg_damage", "avg_duration_min", "avg_kills", "total_matches")


def _known(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")


def timeline_anomalies(timeline: DataFrame, metric: str = "avg_damage") -> DataFrame:
    """One metric by day with its centered seven-day mean and a two-sigma flag.

    The mean is null where the seven rows are not all there.
    """
    _known(metric)
    value = F.col(metric).cast("double")
    stats = timeline.agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    ).scalar()
    around = Window.orderBy("game_day").rowsBetween(-3, 3)
    far = F.abs(value - stats["mean"]) > F.lit(2) * stats["std"]
    return timeline.select(
        "game_day",
        value.alias("value"),
        F.when(F.count(value).over(around) == 7, F.avg(value).over(around)).alias("ma7"),
        F.coalesce(far, F.lit(False)).alias("anomaly"),
    )


def period_delta(timeline: DataFrame, metric: str = "avg_damage", *, rows: int = 7) -> DataFrame:
    """Means of the first and last ``rows`` days and the change between them in percent."""
    _known(metric)

    def edge(order, name: str) -> DataFrame:
        return timeline.orderBy(order).limit(rows).agg(F.avg(metric).alias(name))

    late = edge(F.col("game_day").desc(), "late").scalar()
    early = F.col("early")
    return edge(F.col("game_day").asc(), "early").select(
        F.lit(metric).alias("metric"),
        "early",
        late.alias("late"),
        ((late - early) / F.nullif(early, F.lit(0.0)) * F.lit(100)).alias("delta_pct"),
    )
