"""Session settings and the shared work folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Sub-folder of the staged tables of the run that is going on.
_run: ContextVar[str] = ContextVar("run", default="unscoped")

# Nothing here fixes a partition count: adaptive execution starts from the
# cluster's own value and coalesces or splits by the sizes it measures.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Writer options of tables that are read again by the run or kept as landed: fewer bytes than the default codec's.
# Documents are all different, so a dictionary of them would be made only to be thrown away.
COMPACT = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": "1",
    "parquet.enable.dictionary#_raw_json": "false",
}


def sought_by(key: str, *, rows: int, block: int) -> dict[str, str]:
    """Writer options of tables in which a few keys are sought: small row groups with a Bloom filter on the key.

    ``rows`` is about what a row group of ``block`` (compressed) bytes holds; with more the filters only let more pass.
    There is no dictionary of the keys, which a lookup would take apart anew for every key.
    """
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.expected.ndv#{key}": str(rows),
        f"parquet.enable.dictionary#{key}": "false",
        "parquet.block.size": str(block),
    }


def build_session(app_name: str = "matchforge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tested under; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master with the setting absent (tests) gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="matchforge-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Used for results that several later branches read (marts, BFS frontiers):
    the lineage ends at the files, a lost executor never recomputes the input,
    and the file sizes let Spark judge what is small enough to broadcast.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, name: str, key: str) -> Iterator[DataFrame]:
    """``df`` as a table of the session's catalog, dealt to buckets by ``key``, for as long as the block lasts.

    Joins on the key read it as it lies: no later exchange or sort of its rows, however
    often it is joined. There are as many buckets as the session has shuffle partitions.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows are dealt as the buckets are, so that a bucket is one file
    dealt = df.repartition(count, key).write.bucketBy(count, key).sortBy(key)
    dealt.option("path", work_folder(spark, name)).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


# Columns of a table staged with places: the task that wrote a row, and a number of the row with the task in its upper bits.
TASK, PLACE = "__task", "__row"
_ROW_BITS = 33


@contextmanager
def open_files(spark: SparkSession, count: int) -> Iterator[None]:
    """Inside, a task that writes to partitions or buckets has up to ``count`` files open before it sorts its rows by file."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, count)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def stage_with_places(df: DataFrame, name: str) -> DataFrame:
    """``df`` staged with the columns ``TASK`` and ``PLACE``, for ``at_places``.

    The table is dealt to buckets by the task, as the rows lie anyway, so a join on the task reads
    it without an exchange or a sort. Its name in the catalog goes at once, its files go with the run.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    placed = df.withColumns({TASK: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()})
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with open_files(spark, 2):  # a task has one bucket
        placed.write.options(**COMPACT).bucketBy(buckets, TASK).option("path", work_folder(spark, name)).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def at_places(rows: DataFrame, places: DataFrame, *, inside: bool = True) -> DataFrame:
    """The rows of a table staged with places that are at one of ``places`` (``PLACE``, repeats allowed), or all others.

    The places become one list of bits per task, a word for every 64 rows up to the last place. The
    lists are dealt to where the rows of their task lie: no row of the table is shuffled, however many places there are.
    """
    word = F.shiftright(F.col(PLACE).bitwiseAND((1 << _ROW_BITS) - 1), 6).cast("int")
    bit = f"CAST({PLACE} & 63 AS INT)"
    words = places.groupBy(F.shiftright(PLACE, _ROW_BITS).cast("int").alias(TASK), word.alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits"))
    gaps = words.groupBy(TASK).agg(F.max("word").alias("last")).select(
        TASK, F.explode(F.sequence(F.lit(0), "last")).alias("word"), F.lit(0).cast("bigint").alias("bits"))
    whole = words.unionByName(gaps).groupBy(TASK, "word").agg(F.bit_or("bits").alias("bits"))
    lists = whole.groupBy(TASK).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("__bits"))
    # the lists of a partition's tasks are looked up by hash, so that the table need not be sorted
    joined = rows.join(stage(lists, "places").hint("shuffle_hash"), TASK, "inner" if inside else "left")
    marked = F.coalesce(F.getbit(F.get("__bits", word), F.expr(bit)).cast("int"), F.lit(0)) == 1
    return joined.filter(marked if inside else ~marked).select(*rows.columns)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder, deleted with the staged tables of the run."""
    return f"{_staged_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _staged_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/staged/{_run.get()}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it wants it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, also after a failure.

    Results must be written or collected before: their plans may read those tables.
    """
    token = _run.set(f"run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        files, folder = hadoop_path(spark, _staged_folder(spark))
        _run.reset(token)
        files.delete(folder, True)


def spread_in_order(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """``df`` sorted by ``keys`` in ``partitions`` tasks, for costly per-row work or long rows made behind the sort.

    The partitions of ``orderBy`` are merged by the bytes that were shuffled, which says nothing of either.
    """
    return df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)


def spread(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Rows dealt to ``partitions`` tasks, for costly per-row work on input known to come in few splits.

    Dealt by ``keys``, a join on them that shuffles finds the rows where it wants them.
    """
    return df.repartition(partitions, *keys)
