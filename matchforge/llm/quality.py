"""Document quality by hierarchical empirical Bayes over sites.

1. A logistic regression over hashed words and word shapes is fitted to a bounded sample
   of the labelled rows (``TRAIN_LABELS``): tasks count the features by label, the
   ``SELECTED`` most telling buckets are kept, and only their places are gathered.
2. It gives every document its evidence: the log-likelihood ratio of the label.
3. Hosts and paths of hosts get counts by grouped aggregation: labels where known, else
   the document's probability under the global rate. The spread between hosts, and
   between paths of a host, beyond what their sizes explain (method of moments) sets how
   strongly a rate is drawn to the rate above it; sparse sites fall back to that.
4. A document's probability joins its evidence with the rate of its path, both rates
   taken without the document itself.

Cases: a null or empty text has the evidence of a text without any feature; null hosts
and paths are a site of their own; rows without label count by probability; a label row
of an unknown document, or with a null label, teaches nothing; if a document has several
labels the largest is used; if a label has one value only, its rate decides; repeated
rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchforge.llm.common import byte_values, column, in_tasks, mix, pick, slices, stage, text_bytes, unit_hashes

BUCKET_BITS = 18
LEAST_DOCS = 5
# Features of the classifier per label, steps and penalty of its fit.
SELECTED = 4096
STEPS = 200
PENALTY = 1e-4
# The classifier's sample of labelled documents.
TRAIN_LABELS = 20_000
LABELS = ("quality", "toxic")
_GAPS = b" \t\n\r\x0b\x0c"
_WORDS = byte_values(True, _GAPS + b".,;:!?\"'()")
# Kinds of bytes for shapes: lower, upper, digit, other letters, marks each on their own.
_SHAPE = byte_values(False, _GAPS)
_SHAPE[97:123] = _SHAPE[97]
_SHAPE[65:91] = _SHAPE[65]
_SHAPE[48:58] = _SHAPE[48]
_SHAPE[128:] = _SHAPE[97]


def features(raw: np.ndarray, at: np.ndarray, bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs of the words and word shapes of some texts, in text order."""
    words, starts = unit_hashes(raw, at, _WORDS)
    text_of = np.searchsorted(at, starts, "right") - 1
    # a shape is a word's bytes by kind, runs of one kind as one
    kinds = _SHAPE[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 0)
    kept_at = np.concatenate([[0], np.cumsum(keep)])[at]
    shapes, shape_starts = unit_hashes(raw[keep], kept_at, _SHAPE)
    shape_of = np.searchsorted(kept_at, shape_starts, "right") - 1
    hashes = np.concatenate([words, mix(shapes + np.uint64(1))])
    owners = np.concatenate([text_of, shape_of]).astype(np.int64)
    pairs = np.unique((owners << bits) | (hashes >> np.uint64(64 - bits)).astype(np.int64))
    return pairs >> bits, pairs & ((1 << bits) - 1)


def _labels(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[np.ndarray]:
    return [column(batch, name).fill_null(-1).to_numpy().astype(np.int64) for name in names]


def _counts(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], bits: int) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by name and value of the label; bucket -1 counts the documents."""
    size = 1 << bits
    docs = np.zeros((len(names), 2, size + 1), np.int64)
    for batch in batches:
        raw, at = text_bytes(column(batch, "text"))
        labels = _labels(batch, names)
        for a, b in slices(at):
            owners, buckets = features(raw[at[a]:at[b]], at[a:b + 1] - at[a], bits)
            for own, found in zip(labels, docs):
                for value in (0, 1):
                    found[value, :size] += np.bincount(buckets[own[a:b][owners] == value], minlength=size)
                    found[value, size] += int((own[a:b] == value).sum())
    for k, value in np.ndindex(len(names), 2):
        at = np.flatnonzero(docs[k, value])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(at), k, np.int32)), pa.array(np.full(len(at), value, np.int32)),
            pa.array(np.where(at == size, -1, at)), pa.array(docs[k, value, at])], names=["model", "value", "bucket", "n"])


def telling(table: pa.Table, models: int, bits: int) -> np.ndarray:
    """The buckets that tell most about any label, by standard errors of their log-odds."""
    model, value, bucket, n = (table.column(c).to_numpy() for c in ("model", "value", "bucket", "n"))
    chosen = [np.zeros(0, np.int64)]
    for k in range(models):
        seen, docs = np.zeros((2, 1 << bits)), np.zeros(2)
        cell, row = (model == k) & (bucket >= 0), (model == k) & (bucket < 0)
        seen[value[cell], bucket[cell]], docs[value[row]] = n[cell], n[row]
        rates = (seen + 0.5) / (docs[:, None] + 1)
        errors = np.abs(np.log(rates[1] / rates[0])) / np.sqrt((1 / (seen + 0.5)).sum(0))
        errors[seen.sum(0) < LEAST_DOCS] = 0
        best = np.argsort(-errors, kind="stable")[:SELECTED]
        chosen.append(best[errors[best] > 1])
    return np.unique(np.concatenate(chosen))


def logistic(owners: np.ndarray, places: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and offset of a regularised logistic regression on present features."""
    n, weights, offset = len(y), np.zeros(size), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    moment, spread = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        margin = offset + np.bincount(owners, weights[places], minlength=n)
        miss = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y
        slope = np.append(np.bincount(places, miss[owners], minlength=size) / n + PENALTY * weights, miss.mean())
        moment, spread = 0.9 * moment + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        move = 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
        weights, offset = weights - move[:-1], offset - move[-1]
    return weights, offset


def fit(labelled: DataFrame, names: tuple[str, ...], bits: int = BUCKET_BITS) -> dict[str, tuple[float, np.ndarray, float]]:
    """For each label column (0, 1 or null) beside ``text``: evidence of no feature, weight per bucket, rate of 1.

    ``labelled`` must be bounded: its features, not its texts, are gathered. Equal texts count once.
    """
    rows = labelled.select("text", *(F.col(n).cast("int").alias(n) for n in names))
    parts = in_tasks(rows, lambda batches: _counts(batches, names, bits), "model int, value int, bucket long, n long")
    # two numbers per label and bucket, however many rows were counted
    chosen = telling(parts.groupBy("model", "value", "bucket").agg(F.sum("n").alias("n")).toArrow(), len(names), bits)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(column(batch, "text"))
            for a, b in slices(at):
                owners, buckets = features(raw[at[a]:at[b]], at[a:b + 1] - at[a], bits)
                place = np.minimum(np.searchsorted(chosen, buckets), max(0, len(chosen) - 1))
                used = chosen[place] == buckets if len(chosen) else np.zeros(len(buckets), bool)
                ends = np.concatenate([[0], np.cumsum(np.bincount(owners[used], minlength=b - a))])
                yield pa.RecordBatch.from_arrays([
                    *(column(batch, n).slice(a, b - a) for n in ("key", *names)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[used], pa.int32()))],
                    names=["key", *names, "places"])

    keyed = rows.withColumn("key", F.xxhash64("text"))
    schema = "key long, " + "".join(f"{n} int, " for n in names) + "places array<int>"
    table = in_tasks(keyed, gather, schema).dropDuplicates(["key"]).toArrow().combine_chunks().sort_by("key")
    lists = table.column("places").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = np.array([len(x) for x in lists.to_pylist()], np.int64)
    places, owners = lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    models = {}
    for name in names:
        label = table.column(name).fill_null(-1).to_numpy()
        known = label >= 0
        rate = float(label[known].mean()) if known.any() else 0.0
        weights = np.zeros(1 << bits)
        if not 0 < rate < 1:
            models[name] = 0.0, weights, rate
            continue
        number, inside = np.cumsum(known) - 1, known[owners]
        found, offset = logistic(number[owners[inside]], places[inside], label[known].astype(float), len(chosen))
        weights[chosen] = found
        models[name] = offset - float(np.log(rate / (1 - rate))), weights, rate
    return models


def evidence(docs: DataFrame, models: dict[str, tuple]) -> DataFrame:
    """``docs`` (with ``text``) with a log-likelihood ratio column per model, the text taken out."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rest = [c for c in docs.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = text_bytes(column(batch, "text"))
            out = {name: np.full(batch.num_rows, model[0]) for name, model in shared.value.items()}
            for a, b in slices(at):
                owners, buckets = features(raw[at[a]:at[b]], at[a:b + 1] - at[a])
                for name, model in shared.value.items():
                    out[name][a:b] += np.bincount(owners, model[1][buckets], minlength=b - a)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in rest), *(pa.array(x) for x in out.values())], names=[*rest, *out])

    schema = docs.select(*rest).schema
    for name in models:
        schema = schema.add(name, "double")
    return in_tasks(docs.select(*rest, "text"), score, schema)


def _logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x))))


def _strength(groups: DataFrame, n: str, s: str, above: Column) -> float:
    """How many documents the rate above is worth, from the spread of the groups' rates around it."""
    rate = F.col(s) / F.col(n)
    r = groups.agg(
        F.sum(F.col(n) * (rate - above) ** 2), F.sum(above * (1 - above)), F.sum(F.col(n) * above * (1 - above)),
        F.sum(n), F.sum(F.col(n).cast("double") ** 2)).first()
    spread, expected, noise, whole, squares = (float(x or 0) for x in r)
    room = whole - squares / whole if whole else 0
    if room <= 0 or noise <= 0:
        return 1e9
    between = max(0.0, (spread - expected) / room)
    return 1e9 if between <= 0 else max(1e-3, noise / whole / between - 1)


def site_posterior(rows: DataFrame, llr: str, label: str, rate: float, into: str) -> DataFrame:
    """``rows`` (``host``, ``path``) with the probability ``into`` from evidence, path, host and global rate."""
    own = F.coalesce(F.col(label).cast("double"), _sigmoid(_logit(F.lit(rate)) + F.col(llr)))
    rows = rows.withColumn("_own", own)
    paths = rows.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_n_path"), F.sum("_own").alias("_s_path"))
    hosts = paths.groupBy("_host").agg(F.sum("_n_path").alias("_n_host"), F.sum("_s_path").alias("_s_host"))
    whole = hosts.agg(F.sum("_n_host"), F.sum("_s_host")).first()
    if not whole[0]:
        return rows.withColumn(into, F.lit(rate)).drop("_own")
    overall = whole[1] / whole[0]
    k_host = _strength(hosts, "_n_host", "_s_host", F.lit(overall))
    both = paths.join(hosts, "_host")
    k_path = _strength(both, "_n_path", "_s_path", F.col("_s_host") / F.col("_n_host"))
    joined = rows.join(both, ["_host", "_path"])
    host_rate = (F.col("_s_host") - F.col("_own") + k_host * overall) / (F.col("_n_host") - 1 + k_host)
    path_rate = (F.col("_s_path") - F.col("_own") + k_path * host_rate) / (F.col("_n_path") - 1 + k_path)
    return joined.withColumn(into, _sigmoid(_logit(path_rate) + F.col(llr))).drop(
        "_own", "_n_path", "_s_path", "_n_host", "_s_host")


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, train_labels: int = TRAIN_LABELS,
) -> DataFrame:
    """``doc_id``, ``p_quality``, ``p_toxic`` and ``kept`` (good and not toxic) per row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; ``labels`` has ``doc_id``, ``quality``, ``toxic``. The
    classifier learns from about ``train_labels`` labelled documents, all if there are fewer,
    chosen by a hash of their id; site counts use all documents and all labels.
    """
    none = F.lit("\u0000")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.coalesce(host.cast("string"), none).alias("_host"),
        F.coalesce(path.cast("string"), none).alias("_path"))
    known = pick(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(
        *(F.max(F.when(F.col(n).isin(0, 1), F.col(n))).alias(n) for n in LABELS))
    known = stage(known, "labels")
    # the sample is bounded, so it can be broadcast at any size of the table
    share = min(1.0, train_labels / max(1, known.count()))
    taught = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    models = fit(rows.select("doc_id", "text").join(F.broadcast(taught), "doc_id"), LABELS)
    models = {f"_{name}": model for name, model in models.items()}
    scored = stage(evidence(rows, models), "evidence").join(known, "doc_id", "left")
    for name in LABELS:
        scored = site_posterior(scored, f"_{name}", name, models[f"_{name}"][2], f"p_{name}")
    return scored.select("doc_id", "p_quality", "p_toxic", ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("kept"))
