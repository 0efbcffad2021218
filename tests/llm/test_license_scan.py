"""License detections against plain matching of every rule, and op12 against its definition."""

import re

import numpy as np
import pytest

from matchforge.llm import license_rules, license_scan
from matchforge.llm.queries import QUERIES

SCANNER = license_scan.Scanner()
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
EXAMPLES = {
    "SPDX-License-Identifier: Apache-2.0 OR MIT": {"apache-2.0"},
    "Licensed under the Apache License, Version 2.0 (the \"License\")": {"apache-2.0"},
    "see http://www.apache.org/licenses/LICENSE-2.0 for details": {"apache-2.0"},
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": {"mit"},
    "GNU General Public License v3.0 or later": {"gpl", "gpl-3.0"},
    "the GNU Lesser General Public License, version 2.1": {"gpl", "lgpl-2.1"},
    "GNU Affero General Public License": {"gpl", "agpl-3.0"},
    "This text is CC BY-NC-SA 4.0. All rights reserved.": {"cc-by", "cc-by-nc-sa-4.0", "reserved"},
    "Creative Commons Attribution-ShareAlike 3.0 Unported": {"cc-by-sa-3.0"},
    "Redistribution and use in source and binary forms, with or without modification, are permitted": {"bsd"},
    "Copyright (c) 2019 Someone": {"copyright"},
    "a plain sentence on permission, sources and rights": set(),
}


def simple_resolve(priority, rule, start, end):
    kept = []
    for i in sorted(range(len(rule)), key=lambda i: (priority[i], start[i] - end[i], start[i], rule[i])):
        inside = lambda a, b: start[b] <= start[a] and end[a] <= end[b]
        if not any(inside(i, k) or (priority[k] < priority[i] and inside(k, i)) for k in kept):
            kept.append(i)
    return sorted(kept)


def test_resolution():
    rng = np.random.default_rng(2)
    for _ in range(500):
        n = rng.integers(0, 25)
        start = rng.integers(0, 20, n)
        parts = rng.integers(0, 3, n), rng.integers(0, 6, n), start, start + rng.integers(1, 9, n)
        got = license_scan.resolve(*parts)
        # rows equal in all parts stand for each other
        of = lambda kept: sorted(tuple(int(p[i]) for p in parts) for i in kept)
        assert of(got) == of(simple_resolve(*parts))


@pytest.mark.parametrize("text", EXAMPLES)
def test_examples(text):
    n, found = SCANNER.scan(text.encode())
    assert n == len(WORD.findall(text.lower().encode()))
    assert {SCANNER.rules[i].label for i, _, _ in found} == EXAMPLES[text]


def test_rules():
    rules = SCANNER.rules
    assert len(rules) > 300 and len({r.pattern.pattern for r in rules if r.kind == "="}) > 100
    assert all(r.keyword.startswith(" ") and len(r.keyword) > 2 for r in rules)
    assert {r.label for r in rules if r.base} == {"cc-by", "gpl", "reserved"}


def spell(pattern, rng):
    """A text that a pattern matches: options taken at random."""
    text = pattern.removeprefix("(?<= )(?:").removesuffix(")(?= )")
    text = re.sub(r"\[\^ \]\{\d,\d\}", "xy", text).replace("(?:[^ ]+ ){1,", "(?:odd ){1,")
    while True:
        new = re.sub(r"\(\?:([^()]*)\)(\?|\{\d+,\d+\})?",
                     lambda m: "" if m[2] == "?" and rng.random() < 0.5 else rng.choice(m[1].split("|")) * (2 if m[2] and m[2] != "?" else 1), text)
        if new == text:
            break
        text = new
    text = re.sub(r"\[(.)[^\]]*\]", r"\1", text).replace("\\+", "")
    text = re.sub(r"(.)\?", lambda m: rng.choice(["", m[1]]), text)
    return re.sub(" +", " ", text).strip()


def test_keywords_hide_no_match(spark):
    """With and without the gate every rule matches the same places."""
    rng = np.random.default_rng(3)
    texts = [f" {spell(r.pattern.pattern, rng)} " for r in SCANNER.rules for _ in range(4)]
    texts += [" " + b" ".join(WORD.findall(t.text.lower().encode())).decode("latin-1") + " "
              for t in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    hit, everything = set(), list(range(len(SCANNER.rules)))
    for text in texts:
        every = SCANNER.matches(text, everything)
        gated = SCANNER.matches(text, SCANNER.gated(text))
        assert all((x == y).all() for x, y in zip(every, gated)), text
        hit |= set(every[0].tolist())
    assert hit == set(everything), [SCANNER.rules[i].pattern.pattern for i in set(everything) - hit]


def base_row(text):
    """Number of words and places of the base phrases, by looking at every word."""
    said = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    places = [(i, label) for phrase, label in license_rules.BASE.items() for i in range(len(said))
              if said[i:i + len(phrase.split())] == phrase.encode().split()]
    at = [i for i, _ in places]
    return len(said), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, got):
    want = sorted(((i, *base_row(t)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == want
    for r in got:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_query(spark, tmp_path):
    texts = [*EXAMPLES, None, "", " \n", "cc by cc  BY\tcc-by cc bye", "ALL RIGHTS RESERVED " * 5000, "Éall rights reservedÉ", "all\x00rights\x7freserved",
             "general public license general public licence", "cc by-sa", "中cc by中"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[0], "x"), (None, None, "x"), (1, texts[1], "x"), (1, texts[1], "x")]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, labels STRING").write.parquet(f"{tmp_path}/documents.parquet")
    check([r[:2] for r in rows], QUERIES["op12_license_scan"](spark, str(tmp_path)).collect())


def test_given_documents(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_license_scan"](spark, path).collect()
    check(rows, got)
    assert sum(r.n_base for r in got) > 0
