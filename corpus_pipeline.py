"""A corpus pipeline: quality rules, line dedup, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs
of the next. All but the last return the columns of documents; n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, line_dedup, quality, simhash
from tidemark.llm.registry import RANK_FILE
from tidemark.llm.tables import read
from tidemark.llm.token_files import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def fuzzy_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar lines the first stays; a document may be left with an empty text, and stays."""
    return line_dedup.without_lines(docs, keep=True).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays, that with the smallest doc_id."""
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return bpe.with_token_columns(docs, RANK_FILE, public_tokenizers.PATTERN)


STAGES = [("quality", quality_rules), ("lines", fuzzy_lines), ("near_duplicates", near_duplicates), ("benchmark", decontaminated), ("tokens", tokens)]

#: SQL has no MinHash, XXH64 or BPE; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
