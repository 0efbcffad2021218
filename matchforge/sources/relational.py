"""Copies of processed tables and marts in a relational database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchforge.sources.players import relational_form
from matchforge.sources.tables import with_refresh_time


@dataclass(frozen=True)
class Database:
    """Connection of a JDBC target; ``properties`` holds driver, user, password."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_rows: int = 1000
    connections: int = 8

    def options(self, table: str) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": table,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
        }


def load_table(df: DataFrame, database: Database, table: str, *, truncate: bool = True) -> int:
    """Write ``df`` to ``table`` and return the row count.

    With ``truncate`` the rows replace the old ones and the table keeps its
    definition. An empty frame returns 0 and leaves the table as it is.
    """
    if df.isEmpty():
        return 0
    written = Observation(f"load {table}")
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.format("jdbc")
        .options(**database.options(table), truncate="true")
        .mode("overwrite" if truncate else "append")
        .save()
    )
    return written.get["rows"]


def load_processed(tables: Mapping[str, DataFrame], database: Database) -> dict[str, int]:
    """Processed tables as ``raw_<table>``."""
    return {
        f"raw_{name}": load_table(relational_form(df, name), database, f"raw_{name}")
        for name, df in tables.items()
    }


def load_marts(marts: Mapping[str, DataFrame], database: Database) -> dict[str, int]:
    """Marts under their own names, stamped with the load time."""
    return {name: load_table(with_refresh_time(df), database, name) for name, df in marts.items()}


def mart_tables(spark: SparkSession, database: Database) -> list[str]:
    """Names of the mart tables the database has (a handful)."""
    query = "(SELECT table_name FROM information_schema.tables WHERE table_name LIKE 'mart_%') t"
    rows = spark.read.format("jdbc").options(**database.options(query)).load().collect()
    return [row[0] for row in rows]


def read_options(database: Database, table: str, split: tuple[str, int, int] | None = None) -> dict[str, str]:
    """Read options; ``split`` is a whole-number column with its lowest and highest value."""
    options = database.options(table)
    if split:
        column, low, high = split
        return {**options, "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high)}
    return {**options, "numPartitions": "1"}


def read_table(
    spark: SparkSession, database: Database, table: str, split: tuple[str, int, int] | None = None
) -> DataFrame:
    """A table of the database, read through all connections in ranges of ``split``.

    Without ``split`` one task reads it all: for tables of mart size only.
    """
    return spark.read.format("jdbc").options(**read_options(database, table, split)).load()
