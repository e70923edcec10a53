"""Corpus pipeline: five stages over the documents, each written to the shared folder and read by the next.

Every stage takes all that the one before has kept, and its decisions take effect: documents go, or their text is
cut. All but the last return the columns of the documents. A null or empty text has no language and goes at once, so
that later stages see texts with letters only; rows that repeat are one document from the second stage on. Extra
columns pass through to the last stage. An empty table passes through all stages.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import chosen_path, decontaminate, language, pieces_codec, suffix_dedup
from tablewright.llm.common import cut

MODEL = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told from their text; the others (no letter, or null) go."""
    model = language.fit(language.with_hold_out(docs).filter("NOT held_out"))
    return language.identify(docs, model).filter(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least doc_id."""
    names = docs.columns
    chosen = chosen_path.similarity_join(docs).filter("kept").select(
        F.col("doc_id").alias("_key"), F.col("mark").alias("_mark")).distinct()
    own = docs.withColumn("_own", F.xxhash64("text"))
    kept = own.join(chosen, F.col("doc_id").eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_mark")), "left_semi")
    # rows that repeat: one of them stays; they lie together already, by the keys of the join
    others = [F.first(F.col(f"`{c}`")).alias(c) for c in names if c != "doc_id"]
    return kept.groupBy("doc_id", "_own").agg(*others).select(*names)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 200 bytes that occur twice; a document of which nothing is left goes.

    Parts of a character that a cut leaves are dropped. n_chars, where present, is that of the new text.
    """
    names = docs.columns
    cleaned = suffix_dedup.remove_repeats(docs, as_text=True)
    cleaned = cleaned.filter("n_removed = 0 OR kept <> ''").withColumn(
        "text", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))
    if "n_chars" in names:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*names)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    names = docs.columns
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.withColumnsRenamed({"doc_id": "_key", "mark": "_mark"})
    same = F.col("doc_id").eqNullSafe(F.col("_key")) & (F.xxhash64("text") == F.col("_mark"))
    return docs.join(found, same, "left_anti").select(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip of every document."""
    return pieces_codec.encode_and_check(docs, MODEL)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_overlap),
    ("SentencePiece encoding", tokens),
]
ORACLE_SQL = None  # language ID and tokenizing have no SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage")
    return docs


QUERIES = {"pipeline": run}
