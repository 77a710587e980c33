"""A corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing, tokens.

Every stage works on all rows that the stage before it left and is written as Parquet and
read again before the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.llm import bpe, linededup, mixing, probminhash, quality
from chartmart.llm import text as T
from chartmart.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or a certified cutoff go."""
    T.small_batches(spark)  # for this stage and those after it
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; ``n_chars`` follows the text. A document that has no word left
    but had some goes too: all of it stands in earlier ones."""
    rows = linededup.cut(docs).where("n_removed = 0 or n_removed < n_lines").select("row.*")
    return rows.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, that with the smallest id."""
    found = probminhash.classes(docs)
    gone = found.where("node <> component").select(F.col("node").alias("doc_id"))
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document; where only its first words are used, the text ends there."""
    return mixing.mixed_rows(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row, with digests of the ids and of what they decode to."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", tokens),
]

#: SQL has no weighted near-dedup with exact classes and no byte-pair encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"stage{k}")
    return docs
