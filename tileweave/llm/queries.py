"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tileweave.llm import bpe, conversation_trie, licenses, oracles, packing, periodic_runs, quality_gam, quality_rules, secrets, sharding, simhash, toxicity, vector_dedup, wordpiece
from tileweave.llm.common import crc_of_id


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is: TILEWEAVE_TOKENIZERS, or else the installed package of such files."""
    if folder := os.environ.get("TILEWEAVE_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """How the byte-level vocabulary cuts texts."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rules and the divergence verdict of every document; nulls and empty texts fail the base rules.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its place, digest, score and verdict; a null text has none.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train_from(docs))
    return found.select("doc_id", "start", "length", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "is_secret")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document; null and empty texts count 0.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return wordpiece.token_counts(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op4_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and kept of every vector; null, empty, zero and non-finite ones link with nothing.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return vector_dedup.vector_groups(_table(spark, sf_dir, "embeddings"))


def op5_sampled_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of near equal bytes; null texts count one byte.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 8)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have fingerprint zero.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return simhash.simhash_groups(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence, capacity and offset of every piece of every document; documents without tokens have no piece.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return packing.pack(op3_token_counts(spark, sf_dir).select("doc_id", "n_tokens"))


def op8_toxicity_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out quarter; null texts count as empty.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train_from(docs, labels.where(crc_of_id(4) != 2))
    return toxicity.score(docs, model).select("doc_id", (crc_of_id(4) == 2).alias("held_out"), "score", "predicted", "n_windows", "most_saved")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document; a null text counts as empty.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), pattern())


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels outside the held-out fifth; null texts count as empty.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_gam.train_from(docs, labels.where(crc_of_id(5) != 0))
    return quality_gam.score(docs, model).select("doc_id", (crc_of_id(5) == 0).alias("held_out"), "score", "predicted")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations; null roles and texts count as empty, rows without conv_id for nothing.

    Repeated rows are turns each, an empty table gives an empty result.
    """
    seqs = conversation_trie.sequences(_table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_shared_heads(seqs))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates of every document; null and empty texts have none.

    Repeated rows each get their rows, a null id stays null, an empty table gives an empty result.
    """
    return licenses.license_scan(_table(spark, sf_dir, "documents")).drop("n_matches")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which is given one first; null and empty texts have none.

    Repeated rows each get their rows, a null id stays null and its text as it is, an empty table gives an empty result.
    """
    return periodic_runs.periodic_runs(_table(spark, sf_dir, "documents"), reword=periodic_runs.with_made_runs).drop("runs")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_divergence, op2_secret_scan, op3_token_counts, op4_embedding_graph, op5_sampled_shards, op6_simhash, op7_best_fit_packing, op8_toxicity_compression, op9_byte_bpe, op10_quality_gam, op11_conversation_trie, op12_license_scan, op13_periodic_runs)}

#: Queries that SQL can express; the others are held against brute force, an exact round trip or held-out labels in tests/llm.
ORACLES: dict[str, str] = {
    "op4_embedding_graph": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
     links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
               WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
     reach AS (SELECT vec_id AS a, vec_id AS b FROM v
               UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
     comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
     n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON comp.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
    "op11_conversation_trie": oracles.CONVERSATION_TRIE,
    "op12_license_scan": oracles.LICENSE_SCAN,
}
