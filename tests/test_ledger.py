"""The ledger of landed matches: what a lookup finds, and how little of it is read."""

import re

from pyspark.sql import functions as F

from conftest import document, participant, raw_frame
from matchforge.operators.incremental import landed_matches, new_matches
from matchforge.session import spread_in_order
from matchforge.sources import raw
from matchforge.sources.ledger import LISTED_KEYS, Ledger, equals_any


def landed(spark, folder, *loads):
    keys = Ledger(spark, f"{folder}/keys")
    for load in loads:
        path = raw.append_raw_matches(raw_frame(spark, *load), folder)
        keys.grow(raw.read_raw_matches(spark, folder, path))
    return keys


def one(kills):
    return document([participant(0, kills=kills)])


def test_first_record_wins(spark, tmp_path):
    keys = landed(spark, str(tmp_path), [("A", one(1)), ("B", one(2)), (None, one(0))], [("A", one(3)), ("C", one(4))])
    chunks = raw.read_raw_matches(spark, str(tmp_path))
    wanted = spark.createDataFrame([("A",), ("C",), ("A",), ("Z",), (None,)], "match_id STRING")
    found = {r.match_id: r._raw_json for r in keys.first_records(chunks, wanted).collect()}
    assert found == {"A": one(1), "C": one(4)}
    assert keys.first_records(chunks, wanted.limit(0)).count() == 0
    plain = landed_matches(chunks, wanted, first_by=raw.FILE_ORDER)
    assert {r.match_id: r._raw_json for r in plain.collect()} == found
    fetched = raw_frame(spark, ("A", "1"), ("D", "2"), ("D", "2"), (None, "3"))
    assert [r.match_id for r in keys.new_matches(fetched).collect()] == ["D"]
    assert keys.new_matches(fetched).count() == new_matches(fetched, chunks).count()
    keys.compact()
    assert keys.rows().count() == 4
    assert {r.match_id: r._raw_json for r in keys.first_records(chunks, wanted).collect()} == found


def test_nothing_landed(spark, tmp_path):
    keys = Ledger(spark, str(tmp_path / "keys"))
    assert keys.rows() is None and keys.locate(spark.createDataFrame([("A",)], "match_id STRING")).count() == 0


def scanned_rows(df):
    """Rows that the scans of a plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_a_share(spark, tmp_path):
    ids = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("match_id"))
    rows = ids.withColumns({"source_file": F.lit("file:/x/part"), "source_row": F.monotonically_increasing_id()})
    keys = Ledger(spark, str(tmp_path / "keys"))
    keys.grow(rows)
    wanted = ids.orderBy("match_id").limit(100 * 4000).filter(F.expr("conv(substring(match_id, 1, 4), 16, 10) % 800 = 1")).limit(100)
    found = keys.locate(wanted)
    assert found.count() == 100 and found.select("match_id").distinct().count() == 100
    assert scanned_rows(found) < 400_000 / 2
    absent = spark.createDataFrame([("not there",), ("0" * 32,)], "match_id STRING")
    assert keys.locate(absent).count() == 0 and scanned_rows(keys.locate(absent)) < 400_000 / 4
    many = ids.limit(LISTED_KEYS + 50)
    assert keys.locate(many).count() == LISTED_KEYS + 50


def test_equalities(spark):
    df = spark.range(10)
    assert df.filter(equals_any(F.col("id"), [])).count() == 0
    assert df.filter(equals_any(F.col("id"), [3, 5, 7, 99, 1])).count() == 4


def test_chunks_are_read_in_shares(spark, tmp_path):
    """Of a chunk that holds a hit only the row groups that may have it are read."""
    numbers = spark.range(150_000).repartition(1).select(
        F.md5(F.col("id").cast("string")).alias("match_id"), F.sha2(F.col("id").cast("string"), 512).alias("_raw_json"),
        F.lit("euw1").alias("_region"))
    keys = Ledger(spark, f"{tmp_path}/keys")
    keys.grow(raw.read_raw_matches(spark, str(tmp_path), raw.append_raw_matches(numbers, str(tmp_path))))
    wanted = numbers.filter(F.col("match_id") == F.md5(F.lit("77777")))
    chunks = raw.read_raw_matches(spark, str(tmp_path))
    found = keys.first_records(chunks, wanted)
    assert [r._raw_json for r in found.collect()] == [wanted.first()._raw_json]
    assert re.search(r"match_id#\d+ = ", found._jdf.queryExecution().optimizedPlan().toString())
    assert scanned_rows(chunks.filter(equals_any(F.col("match_id"), [wanted.first().match_id]))) < 150_000 / 2


def test_order_keeps_its_tasks(spark, tmp_path):
    """A sort before long rows are made has as many tasks as asked for, and files in order."""
    numbers = spark.range(1000).select((F.col("id") * 7 % 500).alias("id"))
    spread_in_order(numbers, 5, "id").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).select("id", F.col("_metadata.file_path").alias("f"))
    spans = [(r.low, r.high) for r in rows.groupBy("f").agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy("f").collect()]
    assert len(spans) == 5 and rows.count() == 1000
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
