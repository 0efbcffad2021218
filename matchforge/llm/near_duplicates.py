"""Near-duplicate documents by SetSketch registers, band joins and exact verification.

A document's set is its distinct 5-word shingles, each a 64-bit hash. Its sketch has
``REGISTERS`` registers: per register the smallest of the exponential values that its
hash function gives the elements, truncated to an integer power of ``BASE``. Sketches
of parts merge by the largest register, and registers of two sets agree about as
often as their Jaccard similarity says, so they are locality-sensitive.

Plan:

1. One pass over the texts gives set size, a 128-bit key of the whole set and the
   registers. Equal keys are exact copies: one row per different set goes on.
2. The registers are cut into bands; sets that agree on a whole band share a bucket.
3. First each member of a bucket is compared with the bucket's smallest id only: a
   bucket of n near copies costs n comparisons. A pair is rated by the likelihood of its
   registers, given the two set sizes, which are known; what is clearly under the
   threshold is dropped and the rest is verified on the full sets.
4. What the links leave open are buckets whose members are in several components. There
   every member outside the bucket's largest component is compared with all members of
   other components, on the registers: members are packed in blocks of bounded size, a
   tile of two blocks is a row of its own, and only members of a pair whose registers agree
   often enough and whose likelihood allows the threshold leave it, each pair in the
   first bucket it shares. These members meet again, in the same way, on their full sets, as products of
   small incidence matrices, and only the components that turn out linked are written, never
   the pairs. So no pair in a bucket that could join two components is left out.
5. Links are contracted to the smallest id by distributed hooking and jumping. Every
   step is a written table in the shared folder.

Bands are as wide as the threshold allows (``banding``): 28 bands of 6 registers at 0.85,
33 of 5 at 0.80. A pair at the threshold shares no bucket with probability (1 - 0.85**6)**28
or (1 - 0.8**5)**33, both 2e-6.

Cases: a text without words has an empty set and stands alone; fewer than five words
are one shingle; null ids are never linked, their component is null and ``kept`` is
false; rows that repeat an id keep their own set size and are one node of the links with
the sets of all its texts; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import byte_values, column, in_tasks, mix, pick, slices, stage, text_bytes, unit_hashes

SHINGLE = 5
THRESHOLD = 0.85
REGISTERS = 168
# Largest chance that a pair at the threshold shares no bucket.
MISSED = 2.5e-6
# Fixed values of the sketch: base, rate and largest register.
BASE = 1.001
RATE = 20.0
TOP = 65535
# Members of an open bucket in a block of sketches, shingles in a block of full sets, and members multiplied at a time.
BLOCK_MEMBERS = 512
BLOCK_ELEMENTS = 1 << 16
MULTIPLIED = 256
# Ids of documents whose sets are needed are broadcast up to this number (16 MB), else joined by shuffling.
BROADCAST_IDS = 2_000_000
_GAPS = b" \t\n\r\x0b\x0c"
_VALUES = byte_values(True, _GAPS)
_SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_ODD = mix(np.arange(1001, REGISTERS + 1001, dtype=np.uint64)) | np.uint64(1)
_PLACES = mix(np.arange(5001, SHINGLE + 5001, dtype=np.uint64)) | np.uint64(1)


def banding(threshold: float) -> tuple[int, int]:
    """Number of bands and registers a band: the widest bands that miss a pair at the threshold seldom enough."""
    fitting = [(REGISTERS // rows, rows) for rows in range(1, REGISTERS + 1)]
    fitting = [(bands, rows) for bands, rows in fitting if (1 - threshold**rows) ** bands <= MISSED]
    if not fitting:
        raise ValueError(f"a threshold of {threshold} needs more than {REGISTERS} registers")
    return fitting[-1]


def margin(threshold: float) -> float:
    """Estimates this far under the threshold are dropped: five standard deviations, 0.14 at 0.85."""
    return math.ceil(500 * math.sqrt(threshold * (1 - threshold) / REGISTERS)) / 100


def shingle_sets(raw: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, starts = unit_hashes(raw, at, _VALUES)
    first = np.searchsorted(starts, at)
    n = max(0, len(hashes) - size + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(size):
        runs += hashes[k:k + n] * _PLACES[k]
    runs = mix(runs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a:b - size + 1])
        elif b > a:
            whole = (hashes[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def registers(elements: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes; larger means a smaller minimum."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), 1024):
        block = (elements[None, i:i + 1024] ^ _SEEDS[:, None]) * _ODD[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype("<u2")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = text_bytes(column(batch, "text"))
        sizes, keys, sketches = [], [], []
        for a, b in slices(at):
            for found in shingle_sets(raw[at[a]:at[b]], at[a:b + 1] - at[a]):
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sketches.append(registers(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "key", "sketch"])


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band of each row of registers."""
    weights = mix(np.arange(9001, 9001 + REGISTERS, dtype=np.uint64)) | np.uint64(1)
    spread = mix(values[:, :bands * rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) * weights[:bands * rows]
    return mix(spread.reshape(len(values), bands, rows).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = np.frombuffer(b"".join(column(batch, "sketch").to_pylist()), "<u2").reshape(n, REGISTERS)
        keys = band_keys(values, bands, rows)
        ids = column(batch, "id").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat(ids, bands))], names=["bucket", "id"])


def likely_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketched sets of known sizes, row by row."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    level = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    best, found = np.full(len(u), -np.inf), np.zeros(len(u))
    for share in np.linspace(0, 1, 129):
        j = share * most
        up, down = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            value = (
                np.where(above > 0, above * np.log(up), 0) + np.where(below > 0, below * np.log(down), 0)
                + np.where(level > 0, level * np.log(np.maximum(1 - up - down, 1e-300)), 0)
            )
        better = value > best
        best, found = np.where(better, value, best), np.where(better, j, found)
    return found


def _rate(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(column(batch, c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("s_a", "s_b"))
        n_a, n_b = (column(batch, c).to_numpy().astype(float) for c in ("n_a", "n_b"))
        keep = np.concatenate([
            likely_jaccard(a[i:i + 4096], b[i:i + 4096], n_a[i:i + 4096], n_b[i:i + 4096]) >= least
            for i in range(0, len(a), 4096)])
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at, done = *text_bytes(column(batch, "text")), 0
        for a, b in slices(at):
            found = [s.tobytes() for s in shingle_sets(raw[at[a]:at[b]], at[a:b + 1] - at[a])]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").slice(done, len(found)), pa.array(found, pa.binary())], names=["id", "elements"])
            done += len(found)


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(column(batch, "e_a"), column(batch, "e_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def contract(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): ``id`` and its smallest reachable ``label``.

    Every node hooks onto its smallest neighbour, hooks are followed a few steps, and
    the edges are carried over to the labels until none joins two of them. Only nodes
    that change label are listed.
    """
    labels = None
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        hooks = stage(edges.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "id"), "hooks")
        for _ in range(2):
            hooks = follow(hooks, hooks)
        hooks = stage(hooks, "hooks")
        labels = hooks if labels is None else follow(labels, hooks).unionByName(
            hooks.join(labels.select("id"), "id", "left_anti"))
        labels = stage(labels, "labels")
        edges = stage(_carry(edges, hooks).distinct(), "edges")
        if edges.isEmpty():
            return labels


def follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """``labels`` with each label replaced by the label it hooks onto, if any."""
    step = hooks.select(F.col("id").alias("label"), F.col("label").alias("_next"))
    return labels.join(step, "label", "left").select("id", F.coalesce("_next", "label").alias("label"))


def _carry(edges: DataFrame, hooks: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        step = hooks.select(F.col("id").alias(end), F.col("label").alias("_next"))
        edges = edges.join(step, end, "left").withColumn(end, F.coalesce("_next", end)).drop("_next")
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    percent = round(100 * threshold)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = stage(in_tasks(rows, _sketch, "doc_id long, n_shingles long, key binary, sketch binary"), "sketches")
    listed = sketched.where("doc_id is not null and key is not null")
    # one row per different set, under its smallest id
    reps = stage(listed.groupBy("key").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "sets")
    bands, width = banding(threshold)
    buckets = in_tasks(reps.select("id", "sketch"), partial(_bands, bands=bands, rows=width), "bucket long, id long")
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    members = stage(buckets.join(shared.select("bucket", "least"), "bucket").distinct(), "buckets")

    stars = members.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    labels = contract(_linked(stage(_likely(stars, reps, percent), "likely"), rows, percent))
    live = stage(_live(follow_ids(members.select("bucket", "id"), labels), reps, percent), "open_members")
    hooks = contract(_open_links(live, rows, percent))
    # nodes met before follow the new hooks, others enter with theirs
    labels = stage(follow(labels, hooks).unionByName(hooks.join(labels.select("id"), "id", "left_anti")), "labels")

    component = F.coalesce("label", "id")
    placed = reps.join(labels, "id", "left").select("key", component.alias("component_id"))
    out = sketched.select("doc_id", "n_shingles", "key").join(placed, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def follow_ids(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket members with the label of their component so far."""
    return members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    of = lambda end: reps.select(
        F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}"))
    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    sized = sized.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return in_tasks(sized, partial(_rate, least=percent / 100 - margin(percent / 100)), "a long, b long").distinct()


def _linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) that are linked, by their full sets."""
    elements = _elements(rows, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))))
    of = lambda end: elements.select(F.col("id").alias(end), F.col("elements").alias(f"e_{end}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return in_tasks(both, partial(_verify, percent=percent), "a long, b long").distinct()


def _elements(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id`` and the full set of the documents in ``wanted`` (``doc_id``), from the texts."""
    needed = stage(wanted.distinct(), "needed")
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    return stage(in_tasks(rows.join(needed, "doc_id", "left_semi"), _sets, "id long, elements binary"), "elements")


def _tiles(held: DataFrame, weight: Column, block: int, *fields: str) -> DataFrame:
    """Blocks of the members of a bucket that are ``out``, as ``x``, against blocks of all of them, as ``y``.

    Blocks hold members of about ``block`` times ``weight`` together. A block is a row for each
    block that it meets, and the join is on the bucket and both block numbers.
    """
    blocks = held.groupBy("bucket").agg(
        F.ceil(F.sum(weight) / block).alias("y_blocks"), F.ceil(F.sum(F.when(F.col("out"), weight)) / block).alias("x_blocks"))
    placed = held.join(blocks.where("x_blocks > 0"), "bucket")

    def packed(some: DataFrame, side: str, other: str) -> DataFrame:
        own = F.pmod(F.xxhash64("id"), F.col(f"{side}_blocks")).alias(f"{side}_block")
        rows = some.groupBy("bucket", f"{other}_blocks", own).agg(F.collect_list(F.struct(*fields)).alias(side))
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return rows.select("bucket", f"{side}_block", side, met)

    tiles = packed(placed.where("out"), "x", "y").join(packed(placed, "y", "x"), ["bucket", "x_block", "y_block"])
    # the work grows faster than the bytes, which tasks are cut by
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiles.repartition(parts, "bucket", "x_block", "y_block").select("bucket", "x", "y")


def _live(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Members (``bucket``, ``id``, ``label``, ``out``) of a pair of different components that may be linked.

    ``out`` says that a member is outside the largest component of its bucket.
    """
    sizes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
    open_ = open_.where("labels > 1").select("bucket", F.col("top.label").alias("top"))
    held = members.join(open_, "bucket").withColumn("out", F.col("label") != F.col("top")).join(reps.select("id", "n", "sketch"), "id")
    tiles = _tiles(held, F.lit(1), BLOCK_MEMBERS, "id", "label", "out", "n", "sketch")
    return in_tasks(tiles, partial(_compare, percent=percent), "bucket long, id long, label long, out boolean").distinct()


def _open_links(live: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Linked components (a, b) among the members of open buckets, on full sets."""
    held = live.join(_elements(rows, live.select(F.col("id").alias("doc_id"))), "id")
    tiles = _tiles(held, F.length("elements") / 8, BLOCK_ELEMENTS, "label", "elements")
    return in_tasks(tiles.select("x", "y"), partial(_multiply, percent=percent), "a long, b long").distinct()


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many registers agree, for each row of ``x`` and each of ``y``."""
    if len(x) * len(y) < 1024:
        return (x[:, None] == y[None]).sum(axis=2)
    counts = np.zeros((len(x), len(y)), np.uint8)  # there are under 256 registers
    for a, b in zip(np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)):
        counts += a[:, None] == b[None, :]
    return counts


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Members of a tile that may be linked, in the first bucket that a pair shares."""
    least = percent / 100 - margin(percent / 100)
    bands, width = banding(percent / 100)
    for batch in batches:
        for bucket, x, y in zip(column(batch, "bucket").to_pylist(), column(batch, "x"), column(batch, "y")):
            (id_x, label_x, _, n_x, s_x), (id_y, label_y, out_y, n_y, s_y) = map(_members, (x.values, y.values))
            fits = (_agreeing(s_x, s_y) >= math.floor(least * REGISTERS)) & (label_x[:, None] != label_y[None, :])
            fits &= 100 * np.minimum(n_x[:, None], n_y[None, :]) >= percent * np.maximum(n_x[:, None], n_y[None, :])
            at, to = np.nonzero(fits)
            found = []
            # by parts, so that a tile of like members stays within bounds
            for k in range(0, len(at), 1 << 13):
                p, q = at[k:k + (1 << 13)], to[k:k + (1 << 13)]
                a, b = s_x[p], s_y[q]
                shared = (a == b)[:, :bands * width].reshape(-1, bands, width).all(axis=2)
                first = band_keys(a, bands, width)[np.arange(len(p)), shared.argmax(axis=1)] == bucket
                p, q, a, b = p[first], q[first], a[first], b[first]
                if len(p):
                    likely = likely_jaccard(a, b, n_x[p].astype(float), n_y[q].astype(float)) >= least
                    found.append((np.unique(p[likely]), np.unique(q[likely])))
            if any(len(p) for p, _ in found):
                p, q = (np.unique(np.concatenate(side)) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(p) + len(q), bucket)), pa.array(np.concatenate([id_x[p], id_y[q]])),
                    pa.array(np.concatenate([label_x[p], label_y[q]])),
                    pa.array(np.concatenate([np.ones(len(p), bool), out_y[q]])),
                ], names=["bucket", "id", "label", "out"])


def _members(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
    sketches = np.frombuffer(b"".join(rows.field("sketch").to_pylist()), "<u2").reshape(-1, REGISTERS)
    return (*(rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "out", "n")), sketches)


def _multiply(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of labels that have linked sets in the two blocks of a tile."""
    for batch in batches:
        for x, y in zip(column(batch, "x"), column(batch, "y")):
            sides = []
            for rows in (x.values, y.values):
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows.field("elements")]
                sides.append((rows.field("label").to_numpy(), sets))
            found = set()
            for a in range(0, len(sides[0][0]), MULTIPLIED):
                for b in range(0, len(sides[1][0]), MULTIPLIED):
                    found |= _tile(*(s[k][c:c + MULTIPLIED] for s, c in zip(sides, (a, b)) for k in (0, 1)), percent)
            if found:
                ends = np.array(sorted(found), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


def _tile(labels_x, sets_x, labels_y, sets_y, percent: int) -> set[tuple[int, int]]:
    n_x, n_y = (np.array([len(s) for s in sets]) for sets in (sets_x, sets_y))
    flat_x, flat_y = np.concatenate(sets_x), np.concatenate(sets_y)
    common = np.intersect1d(flat_x, flat_y)
    sides = []
    for flat, n in ((flat_x, n_x), (flat_y, n_y)):
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        hit = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        matrix = np.zeros((len(n), len(common)), np.float32)
        matrix[np.repeat(np.arange(len(n)), n)[hit], at[hit]] = 1
        sides.append(matrix)
    both = (sides[0] @ sides[1].T).astype(np.int64)
    linked = 100 * both >= percent * (n_x[:, None] + n_y[None, :] - both)
    linked &= labels_x[:, None] != labels_y[None, :]
    i, j = np.nonzero(linked)
    return set(zip(np.maximum(labels_x[i], labels_y[j]).tolist(), np.minimum(labels_x[i], labels_y[j]).tolist()))
