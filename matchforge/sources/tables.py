"""Processed tables and marts as Parquet datasets, and the readers of the marts."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.operators.flatten import normalize_position_columns
from matchforge.plans.views import VIEWS
from matchforge.session import hadoop_path
from matchforge.sources.raw import read_parquet_if_present

PROCESSED = ("matches", "players", "champions", "items")
MARTS = (
    "mart_player_stats", "mart_player_champion_stats", "mart_champion_stats",
    "mart_item_popularity", "mart_match_timeline", "mart_position_stats",
)


def replace_dataset(df: DataFrame, path: str, layout: Mapping[str, str] = MappingProxyType({})) -> None:
    """Write ``df`` beside ``path`` and put it in place once the job has succeeded.

    ``layout`` are options of the Parquet writer.

    The old dataset is moved aside before and deleted after the switch, so a failed job
    leaves it as it was, and ``df`` may read it. Between the two renames nothing is at
    ``path``; a writer that dies there leaves both versions under hidden names.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    version = uuid.uuid4().hex
    files, target = hadoop_path(spark, path)
    _, fresh = hadoop_path(spark, f"{parent}/.{name}-{version}-new")
    _, old = hadoop_path(spark, f"{parent}/.{name}-{version}-old")
    try:
        df.write.options(**layout).parquet(fresh.toString())
        if files.exists(target) and not files.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(fresh, target):
            files.rename(old, target)
            raise OSError(f"cannot put the new dataset at {path}")
        files.delete(old, True)
    finally:
        files.delete(fresh, True)


def overwrite_table(df: DataFrame, path: str, *, keep_if_empty: DataFrame | None = None) -> bool:
    """Replace the dataset at ``path``; with no rows the old one is left alone.

    ``keep_if_empty`` is a cheaper frame that is empty exactly when ``df`` is
    (the input of a deduplication, say); only its first row is looked for.
    """
    if (keep_if_empty if keep_if_empty is not None else df).isEmpty():
        return False
    replace_dataset(df, path)
    return True


def write_mart(df: DataFrame, marts_dir: str, name: str) -> None:
    """Replace one mart; an empty result replaces it too."""
    replace_dataset(df, f"{marts_dir}/{name}")


def read_processed(spark: SparkSession, processed_dir: str) -> dict[str, DataFrame]:
    """The processed tables that exist, each also as temp view ``raw_<table>``."""
    tables = {}
    for name in PROCESSED:
        df = read_parquet_if_present(spark, f"{processed_dir}/{name}.parquet")
        if df is not None:
            df.createOrReplaceTempView(f"raw_{name}")
            tables[name] = df
    return tables


def read_marts(spark: SparkSession, marts_dir: str) -> dict[str, DataFrame]:
    """The marts that exist, position names normalized."""
    marts = {}
    for name in MARTS:
        df = read_parquet_if_present(spark, f"{marts_dir}/{name}")
        if df is not None:
            marts[name] = normalize_position_columns(df)
    return marts


def publish_views(marts: Mapping[str, DataFrame]) -> list[str]:
    """Create or replace the temp views whose mart is there; returns their names."""
    published = []
    for view, (mart, plan) in VIEWS.items():
        if mart in marts:
            plan(marts[mart]).createOrReplaceTempView(view)
            published.append(view)
    return published


def with_refresh_time(df: DataFrame) -> DataFrame:
    """Stamp rows with the load time unless they carry one."""
    return df if "refreshed_at" in df.columns else df.withColumn("refreshed_at", F.current_timestamp())


def timeline_in_order(timeline: DataFrame) -> DataFrame:
    return timeline.orderBy("game_day")


def item_report(items: DataFrame, limit: int = 30) -> DataFrame:
    """The most bought items; ties fall to the smaller id, a missing id last."""
    return items.orderBy(F.col("total_purchases").desc(), F.col("item_id").asc_nulls_last()).limit(limit)
