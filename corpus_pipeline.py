"""A training corpus from ``documents``: five stages, each one operator of ``matchforge.llm``.

Every stage reads what the one before kept, as a written table, and returns documents
with their columns; the last one returns a digest of the token files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchforge.llm import decontamination, language, mixing, near_duplicates, token_files
from matchforge.llm.common import pick, read, stage
from matchforge.llm.queries import END_ID, ENTROPY_SHARE, MAX_REPEAT, TOKENIZER, word_count
from matchforge.llm.tokens import public_path
from matchforge.operators.flatten import keep_first
from matchforge.session import staged_run

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text is rejected if it has no letter or no language gets more than this.
LEAST_SCORE = 0.5
# Similarity of word shingles from which on documents are near copies (op2 keeps its own).
NEAR = 0.8

# Training models and drawing permutations is beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: null and empty texts and those without a letter go, repeated rows stay."""
    docs = pick(docs, *COLUMNS)
    model = language.fit(docs.select("text", "lang"))
    judged = language.predict(docs, model)
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") > LEAST_SCORE)
    return judged.where(clear).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Rows that share an id are one document of several texts and stay or go together; of those
    and of rows without an id, which cannot be grouped, each text stays once, with the smallest
    id. Texts without words are no copies of each other.
    """
    docs = pick(docs, *COLUMNS)
    judged = near_duplicates.near_duplicates(docs, threshold=NEAR)
    dropped = stage(judged.where("doc_id is not null and not kept").select("doc_id").distinct(), "copies")
    left = docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    again = stage(again.select(F.col("doc_id").alias("again")), "repeated_ids")
    if again.isEmpty():
        return left
    shared = F.col("doc_id").eqNullSafe(F.col("again"))
    return left.join(again, shared, "left_anti").unionByName(_each_text_once(left.join(again, shared, "left_semi")))


def _each_text_once(rows: DataFrame) -> DataFrame:
    return keep_first(rows, ["text"], [F.col("doc_id").asc_nulls_last()])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; null and empty texts are clean, repeated rows are judged each."""
    judged = decontamination.decontaminate(pick(docs, *COLUMNS), read(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, within a budget of their own size.

    Rows without words cost nothing and are taken once; a null source is a source of its own.
    """
    rows = mixing.mix_sources(
        pick(docs, *COLUMNS), word_count(F.col("text")), entropy_share=ENTROPY_SHARE, max_repeat=MAX_REPEAT)
    return rows.select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, as read back: a row per row of ``docs``, null and empty texts with the end id only."""
    path = token_files.new_folder(spark, "corpus", kept=True)
    token_files.write_token_files(docs, path, public_path(TOKENIZER), END_ID)
    return token_files.file_digest(spark, path)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the token files stay in the shared folder, the tables of the stages before are deleted."""
    with staged_run(spark):
        docs = read(spark, sf_dir, "documents")
        for name, step in STAGES[:-1]:
            docs = stage(step(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
