"""The corpus pipeline: five stages, each on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it as the next stage's docs.  All stages but the last keep the columns of ``docs``, extra ones and any of
clashing names included.  Null texts have no language and go in the first stage; an empty table stays empty throughout.  Of repeated rows
and of ties the near-duplicate stage keeps one; very long texts are read whole in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from raretide.llm import op3_decontamination, op5_mixing, op7_token_files, op8_near_duplicates, op10_language
from raretide.llm.common import scratch_path, small_batches, table, without, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter at all) go; the others stay as they are."""
    training = op10_language.learn(docs) or (("any", ""),)  # nothing learned: one language that every letter fits
    small_batches(spark)
    return without(docs, written(op10_language.rejected(docs, training), "no-language"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, likeness 0.8 or more) stays."""
    small_batches(spark)
    return op8_near_duplicates.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a whole shorter item) go."""
    return op3_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as its source's target asks (0, 1 or 2 times; ids repeat)."""
    return op5_mixing.repeat(docs, op5_mixing.cycle_weight())


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus as token files, read back: doc_id, start, n_tokens, ids_crc32 of each document."""
    small_batches(spark)
    folder = scratch_path(spark, "tokens")
    op7_token_files.write_tokens(docs, folder, op7_token_files.vocabulary_path())
    return op7_token_files.read_tokens(spark, folder)


STAGES = [("language_id", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_files", token_files)]

# Suffix automata, MinHash and byte-pair ids are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
