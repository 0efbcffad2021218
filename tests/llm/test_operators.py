"""The operators against brute force on small frames with nulls, empty texts, ties and repeated rows."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchforge.llm import (
    decontamination, language, line_dedup, mixing, near_duplicates, preferences, quality, token_counts, token_files,
    top_products,
)
from matchforge.llm.tokens import public_path

TOKENIZER = public_path("word_bpe_49k.json")
WORDS = [f"w{i}" for i in range(400)]


def texts():
    rng = np.random.default_rng(3)
    base = [" ".join(rng.choice(WORDS, 60)) for _ in range(6)]
    out = [(i, t) for i, t in enumerate(base)]
    for k in range(8):  # near copies of the first text, one word changed
        w = base[0].split()
        w[5 * k] = "new"
        out.append((10 + k, " ".join(w)))
    out += [(30, base[1].upper()), (31, ""), (32, None), (33, "a b"), (34, "A  b"), (None, base[2]), (2, base[2]),
            (35, " \n\t"), (36, "x " * 30_000)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s", i, "clash") for i, t in texts()]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, component_id STRING, n_tokens LONG, kept STRING")


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates(docs):
    got = near_duplicates.near_duplicates(docs).collect()
    sets = {i: shingles(t) for i, t in texts() if i is not None}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    assert len(got) == len(texts())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)


def test_pipeline_drops_near_copies_from_080(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(104)]  # 100 shingles
    rows = []
    for k, changes in enumerate(((), (20, 60), (10, 50, 90))):  # 5 shingles a change: 90/110 and 85/115
        w = list(base)
        for at in changes:
            w[at] = f"new{k}"
        rows.append((k, " ".join(w), "en", "s", 1))
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == {0, 2}
    assert {r.doc_id for r in near_duplicates.near_duplicates(df).where("kept").collect()} == {0, 1, 2}
    assert near_duplicates.banding(0.85) == (28, 6) and near_duplicates.margin(0.85) == 0.14
    for threshold in (0.5, 0.8, 0.85, 0.9):
        bands, width = near_duplicates.banding(threshold)
        assert bands * width <= near_duplicates.REGISTERS and (1 - threshold**width) ** bands < 3e-6


def test_pipeline_keeps_one_row_of_each_text_under_one_id_or_none(spark):
    import corpus_pipeline

    text, other = " ".join(WORDS[:40]), " ".join(WORDS[100:140])
    rows = [(1, text), (1, text), (1, other), (None, text), (None, text), (None, None), (None, None), (2, other + " end"), (3, None), (4, ""), (5, "")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    left = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, df, "").collect()), key=str)
    assert left == sorted([(1, text), (1, other), (None, None), (3, None), (4, ""), (5, "")], key=str)


def test_open_buckets_lose_no_link(spark, monkeypatch):
    """Components with near members in a shared bucket are linked, whatever the blocks, and no others."""
    monkeypatch.setattr(near_duplicates, "BLOCK_MEMBERS", 5)
    monkeypatch.setattr(near_duplicates, "BLOCK_ELEMENTS", 700)
    rng = np.random.default_rng(8)
    base = [rng.choice(WORDS, 120) for _ in range(3)]
    said = {}
    for i in range(45):
        w = base[i % 3].copy()
        w[rng.integers(0, 120, rng.integers(0, 4))] = rng.choice(WORDS)
        said[i] = " ".join(w)
    rows = spark.createDataFrame(list(said.items()), "doc_id LONG, text STRING")
    raw, at = near_duplicates.text_bytes(__import__("pyarrow").array(list(said.values())))
    sets = dict(enumerate(near_duplicates.shingle_sets(raw, at)))
    sketches = {i: near_duplicates.registers(x) for i, x in sets.items()}
    keys = near_duplicates.band_keys(np.stack(list(sketches.values())), *near_duplicates.banding(0.85))
    label = {i: int(rng.integers(100, 106)) for i in sets}
    reps = spark.createDataFrame([(i, len(x), bytearray(sketches[i].tobytes())) for i, x in sets.items()], "id LONG, n LONG, sketch BINARY")
    members = spark.createDataFrame([(int(k), i, label[i]) for i in sets for k in set(keys[i].tolist())], "bucket LONG, id LONG, label LONG")
    live = near_duplicates._live(members, reps, 85)
    assert live.count() > 20
    got = {tuple(r) for r in near_duplicates._open_links(live, rows, 85).collect()}
    want = set()
    for a, b in itertools.combinations(sets, 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if label[a] != label[b] and 100 * both >= 85 * len(np.union1d(sets[a], sets[b])):
            want.add((max(label[a], label[b]), min(label[a], label[b])))
    assert got == want and len(want) > 5


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    a, b = x[:800], x[100:]
    merged = np.maximum(near_duplicates.registers(a), near_duplicates.registers(b))
    assert (merged == near_duplicates.registers(x)).all()
    rate = near_duplicates.likely_jaccard(*(near_duplicates.registers(s)[None] for s in (a, b)), np.array([800.0]), np.array([800.0]))
    assert abs(rate[0] - 700 / 900) < 0.12


def test_top_products(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * np.exp(rng.normal(size=(400, 1)))
    x[300:320] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [float("nan")] * 8), (902, [None] * 8), (None, [9.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = top_products.top_products(df, F.col("id") % 50 == 0, bucket_rows=64, query_rows=3).collect()
    whole, ids, want = np.floor(256 * x).astype(np.int64), np.arange(400), []
    for q in range(0, 400, 50):
        s = whole @ whole[q]
        best = [i for i in np.lexsort((ids, -s)) if i != q][:5]
        want += [(q, k + 1, i, s[i]) for k, i in enumerate(best)]
    assert sorted(map(tuple, got)) == want
    assert top_products.top_products(df.limit(0), F.col("id") % 50 == 0).count() == 0


def products_by_hand(rows, k=5):
    """Scores in whole numbers of any size, at the ends of the longs beyond; vectors of one dimension meet."""
    import math

    fit = [(i, [math.floor(x * 256) if abs(x) < 2.0**44 else int(x) * 256 for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2.0**992 for x in v)]
    out = []
    for q, a in fit:
        if q % 50 == 0:
            scores = [(max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in fit if i != q and len(b) == len(a)]
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda t: (-t[0], t[1]))[:k])]
    return sorted(out)


def test_top_products_of_huge_and_mixed_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    rows += [(150 + i, (rng.normal(size=4) * 10.0 ** rng.integers(6, 30)).tolist()) for i in range(101)]
    rows += [(300 + i, rng.normal(size=1 + i % 3).tolist()) for i in range(60)] + [(400, []), (401, []), (401, []), (450, [])]
    rows += [(500, [1e308] * 4), (501, [1e250, 0.0, 0.0, -1e250]), (550, [1e8, -1e8, 0.5, 3.0]), (600, [float("inf")] * 4), (650, [1.0, None]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = top_products.top_products(df, F.col("id") % 50 == 0, bucket_rows=32, query_rows=3).collect()
    assert sorted(map(tuple, got)) == products_by_hand(rows)


def encoded(rows):
    from tokenizers import Tokenizer

    return [x.ids for x in Tokenizer.from_file(TOKENIZER).encode_batch([t or "" for t in rows], add_special_tokens=False)]


def test_token_files_round_trip(spark, docs):
    more = spark.createDataFrame([(50, "don't <|endoftext|> é, Éa… x! 4.5 b"), (51, "A.B!'s")], "doc_id LONG, text STRING")
    some = docs.where("doc_id is not null").select("doc_id", "text").unionByName(more)
    rows = sorted(some.collect(), key=lambda r: r.doc_id)
    want = [(r.doc_id, ids + [2]) for r, ids in zip(rows, encoded([r.text for r in rows]))]
    for encoding in ("dictionary", "delta"):
        path = token_files.new_folder(spark, "test")
        token_files.write_token_files(some, path, TOKENIZER, 2, encoding)
        got = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.file_digest(spark, path).collect()}
        starts = np.cumsum([0] + [len(ids) for _, ids in want])
        assert got == {(i, int(s), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for (i, ids), s in zip(want, starts)}
        assert token_files.document_starts(spark, path).count() == len(want)


def test_separator_scan_over_any_blocks(spark, docs):
    path = token_files.new_folder(spark, "flat")
    token_counts.write_flat_files(docs, path, TOKENIZER)
    whole, cut = (
        sorted(map(tuple, token_counts.count_tokens(spark, path, block_bytes=n, span_blocks=3).collect())) for n in (1 << 20, 4096))
    assert whole == cut and len(whole) == len(texts())
    counts = token_counts.count_document_tokens(docs, TOKENIZER).collect()
    rows = texts()
    want = sorted((i if i is not None else -1, len(ids)) for (i, _), ids in zip(rows, encoded([t for _, t in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in counts) == want


def test_language(spark):
    rows = [("the cat and the dog and the house", "en"), ("der hund und die katze und das haus", "de")] * 20
    model = language.fit(spark.createDataFrame([*rows, (None, "en"), ("x", None)], "text STRING, lang STRING"))
    asked = spark.createDataFrame([("the dog",), ("die katze",), (None,), ("",), ("12 !?",)], "text STRING")
    assert [r.lang_pred for r in language.predict(asked, model).collect()] == ["en", "de", "und", "und", "und"]
    assert language.fit(spark.createDataFrame([], "text STRING, lang STRING")) is None


def test_decontamination_catches_other_numbers_and_names(spark):
    item = "A farmer called Anna has 12 apples and gives 5 of them to Peter before Anna walks 3 km home again"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id LONG, text STRING")
    moved = item.replace("Anna", "Maria").replace("Peter", "Paul").replace("12", "40").replace("3 km", "8 miles")
    mixed = item.replace("called Anna", "called Maria").replace("before Anna", "before Kate")
    rows = [(1, f"some words before. {item} and after"), (2, moved), (3, "nothing of that sort is said here at all today"),
            (4, None), (5, ""), (None, item), (1, "another text of the same id with many plain words in it")]
    df = spark.createDataFrame([*rows, (6, mixed)], "doc_id LONG, text STRING")
    got = {(r.doc_id, r.text): r.contaminated for r in decontamination.decontaminate(df, bench).collect()}
    assert [got[r] for r in rows] == [True, True, False, False, False, True, False]
    pairs = decontamination.contaminated_pairs(df, bench).collect()
    assert {(r.doc_id, r.verbatim) for r in pairs} >= {(1, True), (2, False)}
    assert decontamination.decontaminate(df, bench.limit(0)).where("contaminated").count() == 0


ITEM = "A farmer called Anna has 12 apples and gives 5 of them to Peter before Anna walks 3 km home again"


def contaminated(spark, item, texts):
    bench = spark.createDataFrame([(1, item)], "item_id LONG, text STRING")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    return [r.contaminated for r in sorted(decontamination.decontaminate(df, bench).collect())]


def test_decontamination_whatever_case_and_layout(spark):
    told = ("Anna has 12 red apples in a basket and a friend named Peter who likes fruit. Anna gives 5 apples to him. "
            "Peter eats 2 of them. Anna then meets Peter at the market.")
    changed = told.replace("Anna", "Maria").replace("Peter", "Paul")
    wrapped = ITEM.replace(" Anna", "\nMaria").replace(" Peter", "  Paul").replace("3 km", "7\n km")
    assert contaminated(spark, ITEM, [ITEM.lower(), ITEM.upper(), ITEM.title(), wrapped, "nothing like it " * 9]) == [True] * 4 + [False]
    assert contaminated(spark, told, [changed, told.upper()]) == [True, True]
    assert contaminated(spark, ITEM.title(), [ITEM, ITEM.title()]) == [True, True]


def test_decontamination_by_a_long_run_of_a_long_item(spark):
    w = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    other = lambda n: [f"other{chr(97 + i)}" for i in range(n)]
    parts = [[*other(5), *w[20:20 + n], *other(5)] for n in (25, 13, 12)]
    assert contaminated(spark, " ".join(w), [" ".join(p) for p in parts]) == [True, True, False]


def test_decontamination_of_short_and_number_heavy_items(spark):
    sums = "What is 12 * 7 + 3 - 9 / 4 + 15 - 6 ?"
    table = "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"
    texts = [f"as asked: {sums} and so on", sums.replace("15", "16"), sums.upper(), "", None, "3 - 9 / 4"]
    assert contaminated(spark, sums, texts) == [True, False, True, False, False, False]
    assert contaminated(spark, table, [f"see {table} there", table.replace(" 8 ", " 9 "), "1 2 3 4 5 6 7 8"]) == [True, False, False]
    bench = spark.createDataFrame([(1, "photosynthesis makes oxygen"), (2, "Oxygen"), (3, "42"), (4, " ? "), (5, None)], "item_id LONG, text STRING")
    rows = [(1, "they say Photosynthesis makes oxygen, 42 times"), (2, "photosynthesis makes no oxygen"), (None, "nothing"), (3, None)]
    got = decontamination.decontaminate(spark.createDataFrame(rows, "doc_id LONG, text STRING"), bench).collect()
    assert {r.doc_id: (r.contaminated, r.n_short_items) for r in got} == {1: (False, 3), 2: (False, 1), None: (False, 0), 3: (False, 0)}


def test_decontamination_with_one_inconsistent_slot(spark):
    item = ("There are 12 red boxes on the long table near the door of the old house and every one of them holds 12 "
            "green pens that were bought in the small shop around the corner last summer")
    copy = item.replace("holds 12", "holds 13")
    table = ITEM.replace("called Anna", "called Maria").replace("before Anna", "before Kate")
    assert contaminated(spark, item, [copy]) == [True] and contaminated(spark, ITEM, [table]) == [False]


def test_lines_by_brute_force(spark):
    base = [f"line number {i} of the text with some more words behind it" for i in range(3)]
    edits = [base[0].replace("some", "few"), base[0] + " end", base[0].replace("more ", ""), base[0].replace("text with", "book of")]
    rows = [(1, "\n".join([base[0], "", "short line"])), (2, "\n".join([*edits, base[1], "short line"])), (3, base[0] + "\n\n" + base[2]),
            (4, None), (5, ""), (3, base[0]), (None, base[2])]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    lines = [(i if i is not None else 1 << 62, k, x.split()) for i, t in rows if t is not None for k, x in enumerate(t.split("\n"))]

    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < 8:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:p] + long[p + 1:] == short for p in range(len(long)))

    want = sorted((i, k, not w or not any((j, m) < (i, k) and near(w, v) for j, m, v in lines if v)) for i, k, w in lines)
    assert sorted((r.doc_id if r.doc_id is not None else 1 << 62, r.line_no, r.kept) for r in got) == want


def test_mixture_meets_budgets(spark):
    rows = [(i, "big" if i % 10 < 8 else "small" if i % 10 == 8 else None, 10 + i % 7) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9000, "big", 0)], "doc_id LONG, source STRING, n LONG")
    whole = sum(r[2] for r in rows)
    got = mixing.mix_sources(df, F.col("n"), max_repeat=1.5, block_rows=64).collect()
    per = {}
    for r in got:
        per[r.source] = per.get(r.source, 0) + r.n_tokens
    own = {s: sum(n for _, x, n in rows if x == s) for s in ("big", "small", None)}
    assert 1.45 < per["small"] / own["small"] <= 1.5 and per["small"] + per[None] + per["big"] <= whole
    assert sum(per.values()) > whole - 60 and 9000 in {r.doc_id for r in got}
    assert len({(r.doc_id, r.epoch) for r in got}) == len(got)
    assert mixing.mix_sources(df.limit(0), F.col("n"), max_repeat=2.0).count() == 0


def test_every_epoch_is_a_permutation_of_blocks(spark):
    rows = [(i, "big" if i % 10 < 8 else "small", 10 + i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id LONG, source STRING, n LONG")
    got = mixing.mix_sources(df, F.col("n"), max_repeat=4.0, budget=3 * sum(r[2] for r in rows), block_rows=64).collect()
    order = sorted(got, key=lambda r: (r.epoch, r.block, r.place))
    blocks = [k for k, _ in itertools.groupby((r.epoch, r.block) for r in order)]
    assert len(set(blocks)) == len(blocks) and {len({r.source for r in g}) for _, g in itertools.groupby(order, key=lambda r: (r.epoch, r.block))} == {1}
    epochs = {e: [r.doc_id for r in order if r.epoch == e and r.source == "big"] for e in (0, 1, 2, 3)}
    assert sorted(epochs[0]) == sorted(epochs[1]) and epochs[0] != epochs[1] and len(epochs[0]) == 2400
    assert len(epochs[2]) > 0 and len({(r.doc_id, r.epoch) for r in got}) == len(got)
    starts = [r.source for r in order if r.epoch == 0]
    assert sum(a != b for a, b in zip(starts, starts[1:])) > 10


def test_quality_on_held_out_documents(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        words = list(rng.choice(WORDS, 40))
        if bad := i % 4 == 0:
            words[:4] = ["worthless", "trash", "idiot", "stupid"]
        rows.append((i, " ".join(words) if i < 598 else None, f"h{i % 5}" if i % 50 else None, "p"))
        if i < 400:
            labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, host STRING, path STRING")
    got = quality.classify(docs, spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT"), F.col("host"), F.col("path")).collect()
    held = [(r.p_toxic >= 0.5) == (r.doc_id % 4 == 0) for r in got if 400 <= r.doc_id < 598]
    assert len(got) == 600 and np.mean(held) > 0.95


def test_preferences(spark):
    turns = [(1, s, t, r, x) for s, last in (("chosen", "good"), ("rejected", "bad")) for t, r, x in
             ((0, "user", "hi"), (1, "assistant", "yes"), (2, "user", None), (3, "assistant", last))]
    turns += [(2, "chosen", 0, "user", "a"), (3, "chosen", 0, "user", "q"), (3, "rejected", 0, "user", "q"), (None, "chosen", 0, "user", "q")]
    df = spark.createDataFrame(turns, "pair_id LONG, side STRING, turn LONG, role STRING, text STRING")
    rows = {r.pair_id: r for r in preferences.format_preferences(df).collect()}
    assert set(rows) == {1, 3} and rows[3].identical and rows[3].chosen == ""
    one = rows[1]
    assert one.prompt_turns == 3 and one.prompt.count("<|turn|>") == 3
    (span,) = one.chosen_mask
    assert one.chosen[span.start:span.end] == "good<|end|>\n" and one.rejected[one.rejected_mask[0].start:].startswith("bad")
