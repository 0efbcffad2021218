"""Alignment and pair counts against whole-text encoding by both libraries, token by token."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from matchforge.llm import cross_tokens, pair_counts
from matchforge.llm.queries import A_TOKENS, B_TOKENS, QUERIES
from matchforge.llm.tokens import public_path

T = cross_tokens.Tokenizers(A_TOKENS, B_TOKENS)
B = sentencepiece.SentencePieceProcessor(model_file=public_path(B_TOKENS))


def spelled(text):
    """Ids, and byte ends of the tokens, of both tokenizers over the whole text; None if they do not spell it."""
    if not text:
        return None
    a = T.a.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    bytes_a = [T.a_bytes[i] for i in a]
    bytes_b = [bytes([int(p[3:-1], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(B.id_to_piece, b)]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    return a, b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def aligned(text):
    found = spelled(text)
    if found is None:
        return [], [], [], []
    a, b, ends_a, ends_b = found
    cuts = sorted(set(ends_a) & set(ends_b))
    groups, low = [], 0
    for cut in cuts:
        groups.append(([i for i, e in zip(a, ends_a) if low < e <= cut], [i for i, e in zip(b, ends_b) if low < e <= cut]))
        low = cut
    links = [(i, j) for i, x in zip(a, ends_a) for j, y in zip(b, ends_b) if x == y] if len(a) < 300 else [(x[-1], y[-1]) for x, y in groups]
    return a, b, groups, links


def brute(rows):
    every = [(i, *aligned(t)) for i, t in rows]
    counts = Counter(link for *_, links in every for link in links)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for i, a, b, groups, links in every:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


ODD = [
    None, "", " ", "  ", "\n", " \n\t x", "a", "a b", "a  b   c ", "don't you're I'LL", "x\r\ny\r z;\r\n\r\n  q", "tab\tand\n\nlines\n  in",
    "é中文　字   nb", "a   b", "zero​width ﻿", "▁ literal ▁▁x", "<s> </s> <unk> <|endoftext|> <0x41>", "\x00 \x1c \x0b\x0c \x85",
    "12345 67 8.9 １２", "\U0001F600 \U0001F468‍\U0001F469", "ﬁ ﬀ Å Å", "()[]{} ;;; ''' \"\"\"", "word " * 3000, "x" * 5000, "tail  ", "\ttail\n", "a\x1fb c d e",
]


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000").select("doc_id", "text").collect()
    return [*enumerate(ODD), (None, "a b"), (None, None), (3, "a  b"), (3, "a  b"), *((1000 + r.doc_id, r.text) for r in given)]


def test_query(spark, rows, tmp_path):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id LONG, text STRING, n_best STRING")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_cross_tokens"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_rounds_give_the_same(spark, rows):
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    whole, cut = (
        sorted(map(tuple, cross_tokens.align_tokenizers(df, A_TOKENS, B_TOKENS, *sizes).collect()), key=str)
        for sizes in ((1 << 18, 1 << 21), (500, 2000)))
    assert whole == cut and len(whole) == len(rows)


def test_units_by_random_texts():
    rng = np.random.default_rng(7)
    letters = ["a", "B", "é", "中", " ", " ", "\n", "\t", "\r", "'s", ".", ";", "9", "the", "ing", "▁", "　", "\x00", "-"]
    import pyarrow as pa

    texts = ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(4000)]
    work = cross_tokens.Aligner((A_TOKENS, B_TOKENS), spelled=True)
    got = []
    for numbers, first in work.align(pa.array(texts)):
        got += [";".join(work.groups[i] for i in numbers[a:b]) for a, b in zip(first[:-1], first[1:])]
    want = [";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in aligned(t)[2]) for t in texts]
    assert got == want


def test_minimal_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 65, 5000):
        keys = np.unique(rng.integers(0, 1 << 62, n))
        hashed = pair_counts.MinimalHash(keys)
        assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))
    hashed = pair_counts.MinimalHash(keys)
    by_slot = np.empty_like(keys)
    by_slot[hashed.slots(keys)] = keys
    lookup = pair_counts.Lookup(1, [(0, hashed, by_slot, np.arange(len(keys)))])
    assert (lookup.counts(keys[:9]) == hashed.slots(keys[:9])).all()
    with pytest.raises(KeyError):
        lookup.counts(np.array([-5]))
    with pytest.raises(ValueError):
        pair_counts.MinimalHash(np.array([7, 7]))
