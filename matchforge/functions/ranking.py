"""Ranks over sets of any size.

A global window sorts the whole set in one task. Ranks depend only on how many
rows hold each value, so rows are counted per value first, the counts are summed
over coarse value buckets (a handful of rows, the only global window), and the
exact offset inside a bucket comes from a window partitioned by that bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class By:
    """One ordering column of a rank."""

    column: str
    descending: bool = True
    nulls_first: bool = False

    def order(self, column: str | None = None) -> Column:
        col = F.col(column or self.column)
        if self.descending:
            return col.desc_nulls_first() if self.nulls_first else col.desc_nulls_last()
        return col.asc_nulls_first() if self.nulls_first else col.asc_nulls_last()


def magnitude(value: Column) -> Column:
    """Bucket for counts: the power of two below them (at most 64 buckets)."""
    return F.floor(F.log2(value + F.lit(1)))




@dataclass(frozen=True)
class Rank:
    """A global rank: ties share the lowest place, or with ``average`` the mean of theirs.

    ``bucket`` must not decrease with the first key and should map it to few
    values; null keys form a bucket of their own.
    """

    keys: Sequence[By]
    average: bool = False
    bucket: Callable[[Column], Column] = F.floor


def _places(df: DataFrame, output: str, rank: Rank) -> DataFrame:
    """One row per distinct key value (as ``__k_<key>``) with its place."""
    names = [key.column for key in rank.keys]
    counts = (
        df.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__bucket", rank.bucket(F.col(names[0])))
    )
    ahead = Window.orderBy(rank.keys[0].order("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counts.groupBy("__bucket")
        .agg(F.sum("__n").alias("__size"))
        .select(F.col("__bucket").alias("__b"), F.sum("__size").over(ahead).alias("__ahead"))
    )
    inside = (
        Window.partitionBy("__bucket")
        .orderBy(*[key.order() for key in rank.keys])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.coalesce(F.col("__ahead"), F.lit(0)) + F.coalesce(F.col("__inside"), F.lit(0)) + F.lit(1)
    if rank.average:
        place = place + (F.col("__n") - F.lit(1)) / F.lit(2.0)
    return (
        counts.withColumn("__inside", F.sum("__n").over(inside))
        .join(buckets, F.col("__bucket").eqNullSafe(F.col("__b")))
        .select(*[F.col(n).alias(f"__k_{n}") for n in names], place.alias(output))
    )


def with_ranks(df: DataFrame, ranks: Mapping[str, Rank]) -> DataFrame:
    """Add the global ranks as columns of the given names; ``df`` is best a stored table."""
    result = df
    for output, rank in ranks.items():
        match = F.lit(True)
        for key in rank.keys:
            match = match & F.col(key.column).eqNullSafe(F.col(f"__k_{key.column}"))
        places = _places(df, output, rank)
        result = result.join(places, match, "left").drop(*[f"__k_{key.column}" for key in rank.keys])
    return result


def average_rank(value: Column, partition_by: Sequence[str], *, descending: bool = False) -> Column:
    """Mean-of-ties rank of the non-null values inside small, bounded groups."""
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    ranked = F.rank().over(Window.partitionBy(*partition_by).orderBy(order))
    ties = F.count(value).over(Window.partitionBy(*partition_by, value))
    return F.when(value.isNotNull(), ranked + (ties - F.lit(1)) / F.lit(2.0))


def percent_rank_of_mean(value: Column, partition_by: Sequence[str]) -> Column:
    """Average ascending rank over the number of non-null values in the group."""
    size = F.count(value).over(Window.partitionBy(*partition_by))
    return average_rank(value, partition_by) / size
