"""The operators applied to whole given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.llm import (
    cross_tokens, decontamination, language, license_scan, line_dedup, mixing, near_duplicates, periodic_runs, preferences, quality,
    token_counts, token_files, top_products,
)
from matchforge.llm.common import pick, read, words
from matchforge.llm.tokens import public_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
A_TOKENS, B_TOKENS = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Production parameters of the mixture.
ENTROPY_SHARE = 0.97
MAX_REPEAT = 2.0


def register(query):
    QUERIES[query.__name__] = query
    return query


def word_count(text):
    """Words of a text, the cost of a document where no tokenizer is asked for."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


@register
def op1_preference_format(spark, sf_dir):
    pairs = preferences.format_preferences(preferences.neighbour_pairs(read(spark, sf_dir, "conversations")))
    spans = lambda m: F.concat_ws(",", F.transform(m, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))))
    return pairs.withColumns({c: spans(F.col(c)) for c in ("chosen_mask", "rejected_mask")}).withColumnRenamed("pair_id", "conv_id")


@register
def op2_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"))


@register
def op3_temperature_mixture(spark, sf_dir):
    docs = pick(read(spark, sf_dir, "documents"), "doc_id", "text", "source")
    costed = docs.select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed = mixing.mix_sources(costed, F.col("words"), entropy_share=ENTROPY_SHARE, max_repeat=MAX_REPEAT)
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "place")


@register
def op4_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents"))


@register
def op5_top_products(spark, sf_dir):
    return top_products.top_products(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@register
def op6_token_counts(spark, sf_dir):
    counted = token_counts.count_document_tokens(read(spark, sf_dir, "documents"), public_path(TOKENIZER))
    return counted.select("doc_id", "n_tokens")


@register
def op7_decontamination(spark, sf_dir):
    docs = pick(read(spark, sf_dir, "documents"), "doc_id", "text")
    judged = decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "contaminated", "n_items", "first_item", "best_cover", "n_short_items")


@register
def op8_token_files(spark, sf_dir):
    path = token_files.new_folder(spark, "token_files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path, public_path(TOKENIZER), END_ID)
    return token_files.file_digest(spark, path)


@register
def op9_site_quality(spark, sf_dir):
    docs = pick(read(spark, sf_dir, "documents"), "doc_id", "text", "source", "lang")
    return quality.classify(docs, read(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@register
def op10_language(spark, sf_dir):
    docs = pick(read(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    taught = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    model = language.fit(taught.select("text", "lang"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def repeated_tails(docs):
    """Of a tenth of the documents the words from one on are replaced by repetitions of those behind it.

    With h the checksum of the id, g = h / 10 and n words: from word a = g % n on, word i
    becomes word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8). Texts without id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    once = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))

    def repeated(w):
        n = F.size(w)
        return once(F.struct((g % n).cast("int").alias("a"), n.alias("n")), lambda at: once(
            (1 + F.floor((at["n"] - at["a"]) / (3 + g % 8))).cast("int"), lambda p: F.array_join(F.concat(
                F.slice(w, F.lit(1), at["a"]),
                F.transform(F.sequence(F.lit(0), at["n"] - at["a"] - 1), lambda i: w[at["a"] + i % p])), " ")))

    # texts are cut into words only where they change
    changed = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(changed, once(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


@register
def op11_periodic_runs(spark, sf_dir):
    docs = pick(read(spark, sf_dir, "documents"), "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = periodic_runs.detect_runs(repeated_tails(docs))
    # the longest run, of equal ones the first, then the shortest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("rest").cast("binary"), 256).alias("collapsed_sha256"),
    )


@register
def op12_license_scan(spark, sf_dir):
    scanned = license_scan.scan_licenses(read(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d["base"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    starts = F.transform(base, lambda d: d["start"])
    return scanned.select(
        "doc_id", "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        "score",
    )


@register
def op13_cross_tokens(spark, sf_dir):
    aligned = cross_tokens.align_tokenizers(read(spark, sf_dir, "documents"), A_TOKENS, B_TOKENS)
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return aligned.withColumn("groups_sha256", digest).drop("groups")
