"""Champion and item dictionaries: one JSON document holding a map of entries."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge import schema

log = logging.getLogger(__name__)


def read_documents(spark: SparkSession, path: str) -> DataFrame | None:
    """Whole JSON files as column ``document``; None with a warning if absent."""
    try:
        return spark.read.text(path, wholetext=True).select(F.col("value").alias("document"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no dictionary at %s", path)
        return None


def _entries(documents: DataFrame, ddl: str) -> DataFrame:
    parsed = F.from_json("document", ddl)
    return documents.select(parsed.alias("doc")).select(
        F.col("doc._version").alias("dd_version"), F.explode("doc.data").alias("key", "entry")
    )


def _joined(name: str) -> Column:
    return F.coalesce(F.array_join(F.col(f"entry.{name}"), ", "), F.lit(""))


def champions(documents: DataFrame) -> DataFrame:
    """One row per champion: identity, tags as text and seven base stats."""
    stats = ("hp", "mp", "armor", "spellblock", "attackdamage", "attackspeed", "movespeed")
    return _entries(documents, schema.CHAMPION_DOCUMENT).select(
        F.col("entry.key").alias("champion_id"),
        F.col("key").alias("champion_key"),
        F.col("entry.name").alias("champion_name"),
        F.col("entry.title").alias("title"),
        _joined("tags").alias("tags"),
        F.col("entry.partype").alias("resource"),
        F.coalesce("entry.blurb", F.lit("")).alias("blurb"),
        "dd_version",
        *[F.col(f"entry.stats.{s}").alias(s) for s in stats],
    )


def items(documents: DataFrame) -> DataFrame:
    """One row per item: identity, prices and the build lists as text."""
    return _entries(documents, schema.ITEM_DOCUMENT).select(
        F.col("key").alias("item_id"),
        F.col("entry.name").alias("item_name"),
        F.coalesce("entry.plaintext", F.lit("")).alias("description"),
        _joined("tags").alias("tags"),
        F.col("entry.gold.total").alias("gold_total"),
        F.col("entry.gold.sell").alias("gold_sell"),
        F.col("entry.gold.purchasable").alias("purchasable"),
        _joined("from").alias("from_items"),
        _joined("into").alias("into_items"),
        F.col("entry.depth").alias("depth"),
        "dd_version",
    )
