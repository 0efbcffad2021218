"""Marts and views in a database of the session's catalog, replaced without a gap.

What readers know is a view. Publishing writes the rows as a new versioned table, lets the view
point to it and drops the versions before: a reader sees the old rows or the new ones, and a
job that fails leaves the old ones. Ranked views are published as rows as well, since their
ranks come from several steps that keep any set out of a single task.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from matchforge.operators.flatten import normalize_position_columns
from matchforge.plans.views import VIEWS

_VERSION = "__v"


class Catalog:
    """A database; ``location`` is the folder of its tables, by default the session's warehouse."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark, self.database = spark, database
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def found(self, pattern: str = "%") -> list[str]:
        """Published names like ``pattern``, in which % stands for any text."""
        listed = self.spark.catalog.listTables(self.database, pattern.replace("%", "*"))
        return sorted(t.name for t in listed if _VERSION not in t.name and not t.isTemporary)

    def versions(self, name: str) -> list[str]:
        listed = self.spark.catalog.listTables(self.database, f"{name}{_VERSION}*")
        return [t.name for t in listed if not t.isTemporary]

    def publish(self, name: str, df: DataFrame) -> None:
        """Put the rows of ``df``, which may read what it replaces, behind the view ``name``."""
        before, fresh = self.versions(name), f"{name}{_VERSION}{uuid.uuid4().hex}"
        df.write.saveAsTable(self._name(fresh))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(name)} AS SELECT * FROM {self._name(fresh)}")
        for table in before:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")

    def publish_marts(self, marts: Mapping[str, DataFrame]) -> list[str]:
        """The marts, then the views over those that are there; returns the names of the views."""
        for name, mart in marts.items():
            self.publish(name, mart)
        views = [view for view, (mart, _) in VIEWS.items() if mart in marts]
        for view in views:
            mart, plan = VIEWS[view]
            self.publish(view, plan(self.read(mart)))
        return views

    def read(self, name: str) -> DataFrame:
        return normalize_position_columns(self.spark.table(self._name(name)))

    def marts(self) -> dict[str, DataFrame]:
        """All marts the catalog knows."""
        return {name: self.read(name) for name in self.found("mart_%")}
