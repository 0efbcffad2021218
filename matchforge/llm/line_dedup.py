"""Line deduplication by a deletion-neighbourhood join, in SQL functions only.

Lines are sequences of words; an edit inserts, deletes or replaces one word, so any
change of characters inside one word is one edit. A line is dropped if an equal line,
or one within one edit, stands earlier (by ``doc_id``, then line number); the earliest
line of its neighbourhood is kept.

1. Equal lines are grouped by a 128-bit hash; only the earliest goes on.
2. Two lines within one edit share their first or their last half (of the shorter).
   Lines that share neither half with any other line have no neighbour and emit nothing.
3. Every other line emits all its variants with one word deleted, as hashed keys. For a
   replacement the key holds the place of the deleted word; for an insertion or deletion
   a variant meets the key of a whole line. The hash of a variant is a sum over words
   and places, so running sums give all variants of a line in one pass.
4. Lines under one replacement key are all neighbours of each other, and lines under
   one insertion key are neighbours of the whole line, so each line is joined with the
   earliest only: a key shared by n lines gives n pairs.
5. The edit distance of the pairs is verified on the words.

Cases: a line without words is kept and compared with nothing; lines under
``LEAST_WORDS`` words are compared for equality only; null texts have no lines; lines
without ``doc_id`` count as later than all others; lines at the same id and number (rows
that repeat an id) are equally early, so none drops the other; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import pick, stage

LEAST_WORDS = 8
# Lines whose texts are fetched are broadcast up to this number (about 40 MB), else joined by shuffling.
BROADCAST_LINES = 1_000_000
# Kinds of keys.
REPLACED, DELETED, WHOLE = 0, 1, 2
_LAST = (1 << 63) - 1


def text_lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0), ``line``, its words in ``plain``, one space apart, and hashes ``k1``, ``k2``."""
    rows = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    line = F.col("line")
    # most lines are plain already, which a search for single characters shows faster than a pattern
    odd = line.startswith(" ") | line.endswith(" ")
    for gap in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd |= line.contains(gap)
    plain = F.when(odd, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.col("line_no").alias("no"))
    return rows.withColumns({"plain": plain, "place": place}).withColumns(
        {"k1": F.xxhash64("plain"), "k2": F.xxhash64(F.lit(1), "plain")})


def _halves(words: Column, n: Column, least: int) -> Column:
    """Keys of the first and last half, as the shorter line of a pair and as the longer one."""
    keys = []
    for size in (n, n - 1):
        half = F.floor(size / 2).cast("int")
        first = F.xxhash64(F.lit(1), size, F.slice(words, F.lit(1), half))
        last = F.xxhash64(F.lit(2), size, F.slice(words, n - (size - half) + 1, size - half))
        keys += [F.when(size >= least, k) for k in (first, last)]
    return F.when(n >= least, F.array_compact(F.array(*keys)))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one edit."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    differ = F.zip_with(F.slice(long, F.lit(1), F.size(short)), short, lambda x, y: x != y)
    at = F.array_position(differ, True).cast("int")
    cut = F.concat(F.slice(long, F.lit(1), at - 1), F.slice(long, at + 1, F.size(long)))
    return F.when(F.size(long) == F.size(short), F.size(F.filter(differ, lambda d: d)) <= 1).when(
        F.size(long) == F.size(short) + 1, (at == 0) | (cut == short)).otherwise(False)


def _variants(lines: DataFrame) -> DataFrame:
    """Keys of all variants of ``lines`` (``lid``, ``plain``) and of the lines themselves, by ``kind``."""
    # 40 bits a word, so that sums of 8 million words fit; two sums make 80 bits
    bits = lambda *parts: F.shiftrightunsigned(F.xxhash64(*parts), 24)
    at, word = F.col("at"), F.col("word")
    words = F.split("plain", " ")
    # dealt by line before the words are taken apart, so the running sums need no further shuffle
    rows = lines.repartition("lid").select("lid", F.size(words).alias("n"), F.posexplode(words).alias("at", "word")).select(
        "lid", "n", "at", *(
            bits(F.lit(seed), word, at + shift).alias(f"g{seed}{name}")
            for seed in (1, 2) for shift, name in ((0, "own"), (-1, "left"))))
    line = Window.partitionBy("lid")
    upto = line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {}
    for seed in (1, 2):
        own, left = F.col(f"g{seed}own"), F.col(f"g{seed}left")
        sums[f"whole{seed}"] = F.sum(own).over(line)
        # words before the deleted one keep their places, those after it move up
        sums[f"cut{seed}"] = F.sum(own).over(upto) - own + F.sum(left).over(line) - F.sum(left).over(upto)
    rows = rows.withColumns(sums)
    keys = {
        REPLACED: F.xxhash64(F.lit(1), "n", "at", F.col("whole1") - F.col("g1own"), F.col("whole2") - F.col("g2own")),
        DELETED: F.xxhash64(F.lit(2), F.col("n") - 1, "cut1", "cut2"),
        WHOLE: F.when(at == 0, F.xxhash64(F.lit(2), "n", "whole1", "whole2")),
    }
    emitted = F.explode(F.array(*(F.struct(F.lit(kind).cast("byte").alias("kind"), key.alias("key")) for kind, key in keys.items())))
    return rows.select("lid", emitted.alias("v")).select("lid", "v.kind", "v.key").where("key is not null")


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """``k1``, ``k2`` and the ``place`` of the earliest other line within one edit, if that is earlier."""
    halves = distinct.select("place", "k1", "k2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).where("a <> b").select("half")
    close = stage(halves.join(shared, "half").select("place", "k1", "k2").distinct(), "close_lines")
    if close.count() <= BROADCAST_LINES:
        close = F.broadcast(close)
    texts = lines.select("place", "k1", "k2", "plain").join(close, ["place", "k1", "k2"], "left_semi")
    # numbers in the order of places, so that the smallest number is the earliest line
    texts = texts.dropDuplicates(["k1", "k2"]).orderBy("place").withColumn("lid", F.monotonically_increasing_id())
    texts = stage(texts, "line_words")

    variants = stage(_variants(texts.select("lid", "plain")), "variants")
    first = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("lid")))
    groups = variants.groupBy("key").agg(
        F.min("lid").alias("least"), F.max("lid").alias("most"), first(REPLACED).alias("replaced"),
        first(DELETED).alias("deleted"), first(WHOLE).alias("whole")).where("least < most").drop("least", "most")
    met = F.when(F.col("kind") == REPLACED, F.col("replaced")).when(F.col("kind") == DELETED, F.col("whole")).otherwise(F.col("deleted"))
    pairs = variants.join(groups, "key").select("lid", met.alias("other")).where("other < lid").distinct()
    a = texts.select("lid", "k1", "k2", F.col("plain").alias("a"))
    b = texts.select(F.col("lid").alias("other"), F.col("place").alias("near"), F.col("plain").alias("b"))
    verified = pairs.join(a, "lid").join(b, "other").where(_within_one(F.split("a", " "), F.split("b", " ")))
    return verified.groupBy("k1", "k2").agg(F.min("near").alias("near"))


def dedup_lines(docs: DataFrame, max_edits: int = 1, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row per line: ``doc_id``, ``line_no``, ``kept``, ``first_doc_id``, ``first_line_no`` and ``edits``.

    ``first_*`` name the earliest line of the neighbourhood (the line itself if kept);
    ``edits`` is 0 if that is an equal line, 1 if it is within one edit. ``max_edits``
    is 0 (equal lines only) or 1.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    lines = text_lines(docs)
    words = F.when(F.col("plain") != "", F.split("plain", " ")).otherwise(F.array().cast("array<string>"))
    narrow = lines.select("doc_id", "line_no", "place", "k1", "k2", words.alias("words")).withColumn("n", F.size("words"))
    narrow = stage(narrow.select(
        "doc_id", "line_no", "place", "k1", "k2", "n", _halves(F.col("words"), F.col("n"), least_words).alias("halves")), "lines")
    worded = narrow.where("n > 0")
    distinct = stage(worded.groupBy("k1", "k2").agg(F.min("place").alias("place"), F.first("halves").alias("halves")), "distinct_lines")
    if max_edits:
        near = near_lines(lines, distinct)
        firsts = distinct.select("k1", "k2", "place").withColumnRenamed("place", "equal").join(near, ["k1", "k2"], "left")
    else:
        firsts = distinct.select("k1", "k2", F.col("place").alias("equal"), F.lit(None).cast(distinct.schema["place"].dataType).alias("near"))
    found = worded.select("doc_id", "line_no", "place", "k1", "k2").join(firsts, ["k1", "k2"])
    first = F.least("equal", F.coalesce("near", "equal"))
    judged = found.select(
        "doc_id", "line_no", (first == F.col("place")).alias("kept"), first.alias("first"), (first < F.col("equal")).cast("int").alias("edits"))
    blank = narrow.where("n = 0").select("doc_id", "line_no", F.lit(True).alias("kept"), F.col("place").alias("first"), F.lit(0).alias("edits"))
    no_id = F.when(F.col("first.doc") < _LAST, F.col("first.doc"))
    return judged.unionByName(blank).select(
        "doc_id", "line_no", "kept", no_id.alias("first_doc_id"), F.col("first.no").alias("first_line_no"), "edits")


def deduplicated_texts(docs: DataFrame, **options) -> DataFrame:
    """``doc_id`` and the ``text`` left of each document that has lines, dropped lines taken out."""
    kept = dedup_lines(docs, **options).where("kept").select("doc_id", "line_no").distinct()
    lines = text_lines(docs).select("doc_id", "line_no", "line")
    left = lines.join(kept.withColumnsRenamed({"doc_id": "_d", "line_no": "_l"}),
                      lines["doc_id"].eqNullSafe(F.col("_d")) & (lines["line_no"] == F.col("_l")))
    rows = left.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("lines"))
    return rows.select("doc_id", F.concat_ws("\n", F.transform("lines", lambda x: x["line"])).alias("text"))
