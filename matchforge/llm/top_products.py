"""Exact top-k inner products of a query set against all vectors, in buckets of like length.

Vectors are sorted by length, longest first, and cut into buckets of equal rows; a
bucket is one row of a written table: its ids, its vectors and its largest length.
Queries are packed into blocks in the same way. Two passes:

1. Every query block meets the bucket of the longest vectors and gets, per query, a
   first k-th best score: a lower bound of the final one.
2. Every query block meets each bucket that can still hold a result. With the bound,
   the bucket's length and the query's length follow the least cosine a candidate
   needs: over 1, the query skips the bucket; high, candidates are cut by the
   coordinates in which the query is largest (the cosine bounds the range a
   candidate's coordinate may have); else by length alone, as a prefix of the bucket.
   What is left is verified by its exact integer product.

Bounds are only used to leave candidates out that cannot be among the k best, ties
included, so the result is exact. Per bucket and query k rows at most go on.

Components are kept as doubles that hold whole numbers, so none is too large to be exact.
A product is taken in doubles or longs where a bound says that they hold it, else in
whole numbers of any size; a score beyond the longs is given as their end, and ties there.

Cases: vectors that are null or hold a null or non-finite component take no part (a component
counts as non-finite from 2^1000 on); a null id takes no part; vectors meet those of their
own dimension only, empty ones each other with score 0; rows that repeat an id are
candidates each; a query is not its own candidate, by id; fewer than k candidates are all
returned; equal scores go to the smaller id; no vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import column, in_tasks, pick, stage

SCALE = 256
BUCKET_ROWS = 4096
QUERY_ROWS = 4096
# Above this cosine, coordinates cut more than lengths.
COORDINATE_COSINE = 0.6
FOCUS = 4
SALTS = 16
_BLOCK = "block long, n long, ids binary, vectors binary, longest double"
_FOUND = "query_id long, vec_id long, score long"


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Runs of ``rows`` vectors of a sorted partition as one row each."""
    part, number = TaskContext.get().partitionId(), 0
    ids, vectors, held = [], [], 0

    def block(n):
        nonlocal ids, vectors, held, number
        all_ids, all_vectors = np.concatenate(ids), np.concatenate(vectors)
        own, values = all_ids[:n], all_vectors[:n]
        ids, vectors, held = [all_ids[n:]], [all_vectors[n:]], held - n
        longest = float(lengths(values).max())
        number += 1
        return pa.RecordBatch.from_arrays([
            pa.array([(part << 32) + number - 1], pa.int64()), pa.array([n], pa.int64()), pa.array([own.tobytes()]),
            pa.array([values.tobytes()]), pa.array([longest])], names=["block", "n", "ids", "vectors", "longest"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lists = column(batch, "vector")
        values = lists.flatten().to_numpy().reshape(batch.num_rows, -1)
        ids.append(column(batch, "id").to_numpy())
        vectors.append(values)
        held += len(values)
        while held >= rows:
            yield block(rows)
    if held:
        yield block(held)


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id``, ``vector`` (floor(scale * x), x as double) and ``length`` of the rows that take part."""
    rows = pick(vectors, id=vec_id, vector=vector).where("id is not null and vector is not null")
    scaled = F.transform("vector", lambda x: x.cast("double") * scale)
    # beyond 2^52 a double is whole, and floor() would go through a long
    whole = F.transform("scaled", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x))
    finite = F.forall("scaled", lambda x: F.coalesce(F.abs(x) < 2.0**1000, F.lit(False)))
    rows = rows.select(F.col("id").cast("long"), scaled.alias("scaled")).where(finite).select("id", whole.alias("vector"))
    largest = F.coalesce(F.array_max(F.transform("vector", lambda x: F.abs(x))), F.lit(0.0))
    rows = rows.withColumn("largest", largest)
    shares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) * (x / F.col("largest")))
    return rows.withColumn("length", F.when(F.col("largest") > 0, F.col("largest") * F.sqrt(shares)).otherwise(0.0)).drop("largest")


def lengths(values: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, also of those whose squares no double holds."""
    largest = np.abs(values).max(axis=1, initial=0.0)
    unit = values / np.where(largest > 0, largest, 1.0)[:, None]
    return largest * np.sqrt((unit ** 2).sum(axis=1))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, the smaller id first among equals."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _products(queries: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Exact integer products, at the ends of the longs where they lie beyond.

    No sum of some components' products exceeds the product of the lengths.
    """
    longest = lengths(queries).max(initial=0.0), lengths(values).max(initial=0.0)
    bound = longest[0] * longest[1]
    if bound * np.sqrt(values.shape[1]) < 2**52:
        return (queries @ values.T).astype(np.int64)
    if bound < 2**62 and max(longest) < 2**62:
        return queries.astype(np.int64) @ values.astype(np.int64).T
    whole = [[list(map(int, row)) for row in side.tolist()] for side in (queries, values)]
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    products = [[min(max(sum(map(mul, a, b)), low), high) for b in whole[1]] for a in whole[0]]
    return np.array(products, np.int64).reshape(len(queries), len(values))


def _seek(row: dict, k: int) -> tuple[list, list, list]:
    """The k best of one bucket for each query of one block that can use it."""
    q_ids, c_ids = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids"))
    queries = np.frombuffer(row["q_vectors"]).reshape(len(q_ids), -1)
    values = np.frombuffer(row["vectors"]).reshape(len(c_ids), -1)
    # the bound as a double may lie a little above the score it stands for
    least = np.full(len(q_ids), -np.inf) if row["q_least"] is None else np.array(row["q_least"], float)
    least = np.where(np.abs(least) >= 2**53, least - np.abs(least) * 2.0**-50, least)
    q_len, c_len = lengths(queries), lengths(values)
    out_q, out_c, out_s = [], [], []

    def put(q, places, scores):
        own = places[c_ids[places] != q_ids[q]]
        scores = scores[c_ids[places] != q_ids[q]]
        at = _best(scores, c_ids[own], k)
        at = at[scores[at] >= least[q]]
        out_q.append(np.full(len(at), q_ids[q]))
        out_c.append(c_ids[own[at]])
        out_s.append(scores[at])

    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(least > 0, least / (q_len * row["longest"]), -1.0)
    slack = 1e-9
    for at in np.array_split(np.arange(len(q_ids)), max(1, len(q_ids) // 256)):
        # length: candidates of a bucket are sorted, the longest first, so what remains is a prefix
        plain = at[cosine[at] < COORDINATE_COSINE]
        if len(plain):
            with np.errstate(divide="ignore", invalid="ignore"):
                shortest = np.where(least[plain] > 0, least[plain] / q_len[plain], 0).min()
            n = int(np.searchsorted(-c_len, -shortest * (1 - slack), "right"))
            if n:
                products = _products(queries[plain], values[:n])
                for q, scores in zip(plain, products):
                    put(q, np.arange(n), scores)
        for q in at[(cosine[at] >= COORDINATE_COSINE) & (cosine[at] <= 1 + slack)]:
            # coordinates: the angles of query and candidate to an axis differ by the angle between them at most
            places = np.flatnonzero(c_len * q_len[q] >= least[q] * (1 - slack))
            widest = np.arccos(np.clip(least[q] / (q_len[q] * c_len[places]), -1, 1)) + 1e-6
            for f in np.argsort(-np.abs(queries[q]))[:FOCUS]:
                own = np.arccos(np.clip(queries[q, f] / q_len[q], -1, 1))
                theirs = np.arccos(np.clip(values[places, f] / c_len[places], -1, 1))
                near = np.abs(own - theirs) <= widest
                places, widest = places[near], widest[near]
            if len(places):
                put(q, places, _products(queries[q:q + 1], values[places])[0])
    return out_q, out_c, out_s


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _seek({n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for x in found],
                    names=["query_id", "vec_id", "score"])

    return search


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, dimension: int | None = None, bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the k best for every row with ``is_query``.

    ``is_query`` is a condition on the column ``id``. Vectors are searched dimension by
    dimension, or in ``dimension`` alone.
    """
    rows = stage(integer_vectors(vectors, vec_id, vector, scale), "vectors")
    sizes = rows.select(F.size("vector").alias("n")).distinct()
    dimensions = sorted(r.n for r in sizes.collect() if dimension in (None, r.n))  # one number per dimension
    if not dimensions:
        return rows.limit(0).select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score"))
    found = [
        _search_dimension(rows.where(F.size("vector") == n), is_query, k, bucket_rows, query_rows) if n else _empty(rows, is_query, k)
        for n in dimensions]
    return reduce(DataFrame.unionByName, found)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _empty(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """Vectors without components: all products are 0, so the smallest ids are best.

    Whatever the query, they are among the first k rows of the first k + 1 ids.
    """
    empty = rows.where(F.size("vector") == 0).select("id")
    first = empty.distinct().orderBy("id").limit(k + 1)
    copies = empty.join(F.broadcast(first), "id").withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    best = copies.where(F.col("nth") <= k).select(F.col("id").alias("vec_id"))
    asked = empty.where(is_query).select(F.col("id").alias("query_id"))
    pairs = asked.join(F.broadcast(best), F.col("query_id") != F.col("vec_id"))
    return _ranked(pairs.withColumn("score", F.lit(0).cast("long")), k)


def _search_dimension(rows: DataFrame, is_query: Column, k: int, bucket_rows: int, query_rows: int) -> DataFrame:
    """The k best for the queries among vectors of one dimension."""

    def packed(some: DataFrame, n: int) -> DataFrame:
        by_length = some.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
        return stage(in_tasks(by_length, lambda batches: _pack(batches, n), _BLOCK), "blocks")

    buckets, asked = packed(rows, bucket_rows), packed(rows.where(is_query), query_rows)
    longest = buckets.select(F.min("block")).first()[0]
    blocks = asked.select(
        F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    tile = ["q_ids", "q_vectors", "q_least", "ids", "vectors", "longest"]

    first = blocks.withColumns({"block": F.lit(longest).cast("long"), "q_least": F.lit(None).cast("array<double>")})
    tried = in_tasks(first.join(buckets, "block").select(*tile), _search(k), _FOUND)
    bounds = tried.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    # blocks with their bounds; the join is on the block's own ids
    held = in_tasks(asked.select("block", "ids", "vectors"), _unpack, "q_block long, place int, query_id long, length double")
    held = held.join(bounds.where(F.col("n") >= k), "query_id", "left").withColumn(
        "least", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))))
    need = F.when(F.col("least") > 0, F.col("least") / F.col("length")).otherwise(0.0)
    bounded = held.groupBy("q_block").agg(
        F.min(need).alias("shortest"),
        F.transform(F.sort_array(F.collect_list(F.struct("place", "least"))), lambda x: x["least"]).alias("least"))
    bounded = stage(bounded, "bounds")

    # numbers of blocks and buckets that can meet: buckets in SALTS parts, each block once per part
    numbers = buckets.select("block", F.col("longest").alias("reach"), (F.col("block") % SALTS).alias("salt"))
    wanted = bounded.select("q_block", "shortest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    tiles = wanted.join(numbers, "salt").where(F.col("reach") * (1 + 1e-9) >= F.col("shortest")).select("q_block", "block")
    with_blocks = tiles.join(blocks.join(bounded.select("q_block", "least"), "q_block"), "q_block")
    full = with_blocks.join(buckets, "block").withColumnRenamed("least", "q_least")
    found = in_tasks(full.select(*tile), _search(k), _FOUND)

    return _ranked(found, k)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id and length of every query of a block."""
    for batch in batches:
        for block, ids, vectors in zip(*(column(batch, c).to_pylist() for c in ("block", "ids", "vectors"))):
            ids = np.frombuffer(ids, np.int64)
            values = np.frombuffer(vectors).reshape(len(ids), -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids),
                pa.array(lengths(values))], names=["q_block", "place", "query_id", "length"])
