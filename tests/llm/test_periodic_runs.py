"""Runs of words against brute force, and op11 against its definition, row by row."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest

from matchforge.llm import periodic_runs
from matchforge.llm.queries import QUERIES


def runs_of(w, least=12):
    """Every maximal stretch of every period, of equal stretches the smallest period."""
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def found(texts, least=2):
    w = np.concatenate([np.array(t, np.uint64) for t in texts]) * np.uint64(0x9E3779B97F4A7C15)
    return [tuple(r) for r in periodic_runs.find_runs(w, np.repeat(np.arange(len(texts)), [len(t) for t in texts]), least).tolist()]


def wanted(texts, least=2):
    at = np.cumsum([0] + [len(t) for t in texts]).tolist()
    return [(s + o, e + o, q) for t, o in zip(texts, at) for s, e, q in runs_of(t, least)]


@pytest.mark.parametrize("letters,most", [(2, 13), (3, 8)])
def test_all_short_texts(letters, most):
    for n in range(1, most + 1):
        texts = list(itertools.product(range(letters), repeat=n))
        assert found(texts) == wanted(texts)


def test_nested_and_touching_progressions():
    rng = np.random.default_rng(4)
    for _ in range(300):
        inner = [x for _ in range(rng.integers(1, 5)) for x in np.tile(rng.integers(0, 3, rng.integers(1, 12)), 9)[:rng.integers(1, 30)]]
        text = [*rng.integers(0, 3, rng.integers(0, 4)), *inner, *inner, *inner[:rng.integers(0, len(inner) + 1)]]
        assert found([text]) == wanted([text])
    # a square whose halves are the only far pair of two long progressions
    text = [int(c) for c in "101010101" * 2]
    assert (2, 16, 7) in found([text]) and found([text]) == wanted([text])


def digest(doc_id, text):
    w = [] if text is None else text.encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < e for s, e, q in runs)]
    top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    best = (None,) * 4 if top is None else (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2])
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else v for v in row)


def test_query(spark, tmp_path):
    rng = np.random.default_rng(6)
    said = [" ".join(rng.choice(["a", "b", "é中", "d e", "Über\x1cx", "\x00"], 40)) for _ in range(150)]
    said += ["x " * 30, "\t\n" + "go on " * 9 + "\x0b\x0cstop", "", None, " \n ", "one", "a b a b " * 8, "p q r " * 4 + "P Q R " * 4]
    rows = [(i, t, "clash") for i, t in enumerate(said)] + [(None, "go on " * 9, "x"), (None, None, "x"), (3, said[5], "x"), (3, said[5], "x")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, runs STRING").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(key, got)) == sorted(key(digest(i, t)) for i, t, _ in rows)
    assert sum(r.n_runs > 0 for r in got) > 10
    tens = [i for i in range(150) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert sum(r.n_runs > 0 for r in got if r.doc_id in tens) > len(tens) / 2


def test_given_documents(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").where("length(text) < 4000").select("doc_id", "text").collect()
    want = {r.doc_id: digest(*r) for r in rows}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, path).collect()}
    assert {i: got[i] for i in want} == want
