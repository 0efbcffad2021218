import pytest
from pyspark.sql import functions as F

from matchforge.operators.quality import Rules, gate, quality_checks, quality_summary
from test_marts import frame, row


@pytest.fixture(scope="module")
def good(spark):
    return frame(spark, [row(f"M{m}", n) for m in range(10) for n in range(10)])


def summary(df, table="matches"):
    return quality_summary(df, table).first()


def test_valid_table_passes(good):
    row = summary(good)
    assert (row.n_rows, row.failed, row.doubtful) == (100, [], [])


def test_null_rate_levels(good):
    without = lambda *ids: good.withColumn("kills", F.when(~F.col("match_id").isin(*ids), F.col("kills")))
    assert (summary(without("M0")).failed, summary(without("M0")).doubtful) == ([], ["null_rate:kills"])
    assert summary(without("M0", "M1", "M2")).failed == []  # exactly 30 %
    assert summary(without("M0", "M1", "M2", "M3")).failed == ["null_rate:kills"]


def test_duplicates_count_null_keys(spark):
    df = frame(spark, [row("A"), row("A"), row("A", puuid=None), row("A", puuid=None), row("B")])
    assert "duplicates:match_id,puuid" in summary(df).failed
    checks = {r.check_name: r.value for r in quality_checks(df, "matches").where("check_name = 'duplicates'").collect()}
    assert checks == {"duplicates": 2.0}


def test_negative_and_out_of_range(spark):
    df = frame(spark, [row("A", kills=-1), row("B", deaths=101), row("C", vision_score=500)])
    assert [code.split(":")[1] for code in summary(df).failed] == ["kills", "deaths", "kills"]


def test_empty_and_missing_columns(spark, good):
    empty = summary(good.limit(0))
    assert empty.n_rows == 0 and [code.split(":")[0] for code in empty.failed] == ["row_count"]
    assert {c for c in summary(good.drop("win", "puuid")).failed if c.startswith("missing")} == {
        "missing_column:win", "missing_column:puuid"}


def test_text_numbers_are_coerced(spark):
    df = spark.createDataFrame([("a", "1", "-2", "x"), ("b", "q", "3", "1.5")], "puuid STRING, wins STRING, losses STRING, winrate STRING")
    assert {code.split(":")[1] for code in summary(df, "players").failed} == {"losses", "winrate"}


def test_gate_raises(spark, good):
    assert gate(good, "matches") is good
    with pytest.raises(ValueError, match="row_count"):
        gate(good.limit(0), "matches")


def test_rules_can_be_given(spark):
    checks = quality_checks(spark.range(3), "numbers", rules=Rules(required=("id",), keys=("id",), ranges={"id": (0, 1)}))
    assert {(r.check_name, r.value, r.passed) for r in checks.collect()} == {
        ("row_count", 3.0, True), ("null_rate", 0.0, True), ("duplicates", 0.0, True), ("out_of_range", 1.0, False)}
