import uuid

import pytest
from pyspark.sql import functions as F

from matchforge.sources.catalog import Catalog


@pytest.fixture
def catalog(spark, tmp_path):
    name = f"marts_{uuid.uuid4().hex}"
    yield Catalog(spark, name, str(tmp_path / "db"))
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


POSITIONS = [("TOP", 4, 50.0, 2.0, 0.0, 1.0, 9.0, 8.0, 7.0, 6.0), ("MIDDLE", 6, 40.0, 2.0, 1.0, 1.0, 9.0, 8.0, 7.0, 6.0)]
COLUMNS = ("team_position STRING, total_games LONG, winrate_pct DOUBLE, avg_kills DOUBLE, avg_deaths DOUBLE, avg_assists DOUBLE, "
           "avg_damage DOUBLE, avg_gold DOUBLE, avg_vision DOUBLE, avg_cs DOUBLE")


def test_published_marts_are_found_and_read(spark, catalog):
    assert catalog.found() == [] and catalog.marts() == {}
    mart = spark.createDataFrame(POSITIONS, COLUMNS)
    assert catalog.publish_marts({"mart_position_stats": mart}) == ["vw_position_overview"]
    assert catalog.found("mart_%") == ["mart_position_stats"] and catalog.found("vw_%") == ["vw_position_overview"]
    assert {(r.team_position, r.avg_kda) for r in catalog.read("vw_position_overview").collect()} == {("TOP", None), ("MID", 3.0)}
    catalog.publish_marts({"mart_position_stats": mart.limit(1)})
    assert catalog.marts()["mart_position_stats"].count() == 1 and catalog.read("vw_position_overview").count() == 1
    assert len(catalog.versions("mart_position_stats")) == 1


def test_a_failed_publication_leaves_the_old_rows(spark, catalog):
    catalog.publish("mart_x", spark.range(3))
    with pytest.raises(Exception):
        catalog.publish("mart_x", spark.range(3).select(F.raise_error(F.lit("no")).alias("id")))
    assert catalog.read("mart_x").count() == 3
    catalog.publish("mart_x", catalog.read("mart_x").filter("id > 0"))  # may read what it replaces
    assert catalog.read("mart_x").count() == 2
