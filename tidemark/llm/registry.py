"""Queries of the subpackage, one for each operator, and the pipeline; and SQL for those that it can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, html_extract, line_dedup, packing, periodic_runs, pii, prefix_trie, quality, secrets, simhash, substring_dedup, token_files
from tidemark.llm.tables import cut, read

#: The vocabularies; another folder's can be given here.
RANK_FILE, WORD_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(read(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_token_columns(read(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(read(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.with_fingerprint(read(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.with_length(read(spark, sf_dir, "pages"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "op10-tokens")
    token_files.write_tokens(read(spark, sf_dir, "documents"), path, WORD_FILE)
    return token_files.read_tokens(spark, path)


def _echoed(doc_id: int | None, n: int) -> np.ndarray | None:
    """The words that the contract puts in the place of a tenth of all texts' own: from word a on, the p words from there again and again."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(read(spark, sf_dir, "documents"), layout=_echoed))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations that the contract puts in the place of those given: the first h turns of conversation c - c % 5, then c's own after its first h."""
    sizes = prefix_trie.sizes_of(turns)
    of = sizes.withColumn("h", F.crc32(F.col("conv").cast("string")) % 9).withColumn("base", F.col("conv") - F.pmod("conv", F.lit(5)))
    of = of.join(sizes.select(F.col("conv").alias("base"), F.col("n_turns").alias("n_base")), "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    of = cut(of.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))))
    heads = turns.where("at < 8").withColumnRenamed("conv", "base").join(of.select("base", "conv", "taken"), "base").where("at < taken").select(*turns.columns)
    own = turns.join(of.select("conv", "h", "taken"), "conv").where("at >= h").withColumn("at", F.col("at") - F.col("h") + F.col("taken")).select(*turns.columns)
    return heads.unionByName(own), of.select("conv", "n_turns")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut(prefix_trie.turns_of(read(spark, sf_dir, "conversations")))
    return prefix_trie.with_digests(prefix_trie.trie(*_rebuilt(turns)))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_path(spark, "op13-pieces")
    packing.write_pieces(read(spark, sf_dir, "documents"), path, WORD_FILE)
    pieces = packing.read_pieces(spark, path)
    return packing.placed(pieces.withColumn("ids_crc32", packing.crc32_of(F.col("ids"), packing.id_width(49408, 1))).drop("ids"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_byte_bpe, op3_secrets, op4_decontaminate, op5_simhash, op6_quality, op7_personal_data, op8_line_dedup, op9_html_extract, op10_token_files, op11_periodic_runs, op12_prefix_trie, op13_best_fit_packing, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_secrets": secrets.ORACLE_SQL}
