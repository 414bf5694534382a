"""The corpus pipeline: quality rules, line dedup, near duplicates, substring dedup, packing.

Each stage reads all that its predecessor kept and returns the columns of
``documents``; the last one returns the packed pieces. A document that loses its
last word in a stage goes; one that had none before is the quality rules' affair.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import host_rules, line_dedup, ngram_join, substring_dedup, vector_packing
from tallyloom.llm.common import WORD, materialize

#: No SQL can tell tokens; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def _edited(docs: DataFrame, edited: DataFrame, has_words: Column) -> DataFrame:
    """``edited`` with the columns of ``docs``, without those that lost all words, and with their new lengths."""
    left = edited.filter((F.col("n_removed") == 0) | has_words)

    def column(c: str) -> Column:
        if c != "n_chars":
            return F.col(f"`{c}`")
        return F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema[c].dataType).alias(c)

    return left.select(*[column(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, on hosts that pass."""
    return host_rules.judge_documents(docs).filter("kept").select(*docs.columns)


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    # told from the counts, so that no text is put together to be looked at
    return _edited(docs, line_dedup.drop_repeated_lines(docs), F.col("n_lines") > F.col("n_removed"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.keep_first(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of earlier ones."""
    return _edited(docs, substring_dedup.remove_repeats(docs), F.col("text").rlike(WORD))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    return vector_packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, end_id=2
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_runs),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", passages),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` after all stages; each stage's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{n + 1}")
    return docs
