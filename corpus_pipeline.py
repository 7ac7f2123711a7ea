"""Corpus preparation in five stages; each reads what the one before it wrote.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return the
columns of ``documents``. A stage that shortens a text also sets ``n_chars`` to its new length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import byte_bpe, fm_decontam, group_matrix_join, language_id, run_length_dedup
from feira.llm.components import written
from feira.session import tune


# Bytes of a passage that counts as repeated: some forty words, so that passages of more than fifty are found
# however short their words are.
REPEATED = 200


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any language: null texts and texts without a letter, whatever was learned."""
    model = language_id.learn(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns}), model, "own_text")
    return found.where("has_letters").select(*(F.col(f"own_{c}").alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that with the smallest id."""
    return group_matrix_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every string of ``REPEATED`` bytes that also stands elsewhere in the corpus.

    All rows stay: null and empty texts as they are, a text that is cut as a whole as an empty one.
    """
    return _measured(run_length_dedup.remove_repeats(docs, length=REPEATED))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out every passage of ten words that a benchmark item holds.

    All rows stay: null and empty texts as they are, a text that is cut as a whole as an empty one.
    """
    return _measured(fm_decontam.remove_phrases(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text that is left, as digest, with what they decode to; null and empty texts have none."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages),
    ("byte_level_bpe", tokens),
]

# Training and hashing in the stages have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
