"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tileweave.llm import packing, quality_rules, secrets, simhash, toxicity, wordpiece
from tileweave.llm.common import crc_of_id, cut
from tileweave.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep: null, empty and short texts go; every column and repeated row stays; empty: empty."""
    return quality_rules.quality_filter(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold; the model learns from labelled documents of this stage's input.

    Null texts count as empty, so clean; rows without an id are judged like others; empty: empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train_from(docs, labels.where(crc_of_id(4) != 2)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, whatever ids are null or repeated; null and empty texts are one group; empty: empty."""
    return simhash.simhash_dedup(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with secrets masked, and their new length; null texts stay null; empty: empty."""
    return secrets.mask(docs, secrets.train_from(docs))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, start, length, bin_id, capacity, bin_offset.

    Documents without tokens have no piece; null ids and repeated rows are packed each; empty: empty.
    """
    return packing.pack(wordpiece.token_counts(docs, tokenizer_file("word_bpe_49k.json")).select("doc_id", "n_tokens"))


STAGES = [("quality rules", quality), ("toxicity", toxic), ("SimHash near-dedup", near_duplicates), ("secret scan", secret_scan), ("best-fit packing", best_fit)]

#: SQL has no counterpart of the first stages' models; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
