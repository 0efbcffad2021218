"""Queries over given tables against plain Python versions, and held-out accuracy on given labels."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from matchforge.llm import quality
from matchforge.llm.oracle import ORACLE
from matchforge.llm.queries import QUERIES

LARGER, LARGEST = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def table(spark, folder, name):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]


def test_sql_names():
    assert set(ORACLE) <= set(QUERIES)


def test_preferences_by_hand(spark):
    turns = {}
    for r in table(spark, LARGER, "conversations"):
        turns.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"] or ""))
    last = {}
    for conv, said in turns.items():
        said.sort()
        replies = [(n, text) for n, role, text in said if role == "assistant"]
        if replies:
            last[conv] = max(replies)
    want = {}
    for conv, (end, reply) in last.items():
        a = [(role, text) for n, role, text in turns[conv] if n <= end]
        other = last.get(conv ^ 1, (0, ""))[1]
        b = [(role, other if n == end and role == "assistant" else text) for n, role, text in turns[conv] if n <= end]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        shown = lambda some: "".join(f"<|turn|>{role}\n{text}<|end|>\n" for role, text in some)

        def mask(some):
            at, spans = 0, []
            for role, text in some:
                at += len(f"<|turn|>{role}\n")
                if role == "assistant":
                    spans.append(f"{at}-{at + len(text) + 8}")
                at += len(text) + 8
            return ",".join(spans)

        want[conv] = (shared, shown(a[:shared]), shown(a[shared:]), mask(a[shared:]), shown(b[shared:]), mask(b[shared:]), a == b)
    got = QUERIES["op1_preference_format"](spark, LARGER).collect()
    assert {r.conv_id: (r.prompt_turns, r.prompt, r.chosen, r.chosen_mask, r.rejected, r.rejected_mask, r.identical) for r in got} == want


def grams(text):
    said = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(said[i:i + 8]) for i in range(len(said) - 7)]


def test_leaks_by_hand(spark):
    """Items of the given benchmark stand in the given documents word by word, so 8-grams find every leak."""
    items = {r["item_id"]: grams(r["text"]) for r in table(spark, LARGER, "benchmark")}
    holders = {}
    for item, said in items.items():
        for gram in said:
            holders.setdefault(gram, set()).add(item)
    want = set()
    for r in table(spark, LARGER, "documents"):
        own = set(grams(r["text"]))
        for item in {i for gram in own for i in holders.get(gram, ())}:
            if 2 * sum(gram in own for gram in items[item]) >= len(items[item]):
                want.add(r["doc_id"])
    got = QUERIES["op7_decontamination"](spark, LARGER).where("contaminated").collect()
    assert {r.doc_id for r in got} == want and len(want) > 10


@pytest.mark.parametrize("fold", [0, 2])
def test_quality_of_given_labels_held_out(spark, fold):
    """A quarter of the labels is kept from the fit; both classes are told apart on it."""
    docs = spark.read.parquet(f"{LARGEST}/documents.parquet").select("doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{LARGEST}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == fold
    got = {r.doc_id: r for r in quality.classify(docs, labels.where(~out), F.col("source"), F.col("lang")).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == fold]
    right = {n: sum((got[r.doc_id][f"p_{n}"] >= 0.5) == bool(r[n]) for r in held) / len(held) for n in ("quality", "toxic")}
    print("held out", fold, len(held), right)
    assert right["quality"] > 0.9 and right["toxic"] > 0.9
