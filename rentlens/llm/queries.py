"""The queries of the operators, one per operator and one for the pipeline, with their SQL.

Each callable takes (spark, folder) and runs its operator, with production
parameters, over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm_scoring, resampling, sql, toxicity
from .chunking import chunk_dedup
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_components
from .merkle import merkle_manifest
from .mixing import mix
from .prefix_trie import placed_turns, prefix_trie, with_shared_starts
from .suffix_dedup import suffix_dedup
from .token_files import token_round_trip
from .warc import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that are labelled to be of high quality: the target of the scoring operators."""
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op1_lm_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scoring.score(docs, lm_scoring.fit(docs, _good(spark, sf_dir))).withColumnRenamed("id", "doc_id")


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, _good(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op4_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), with_kept=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept_sha")).alias("kept_sha256"))


def op7_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup(table(spark, sf_dir, "documents"), with_kept=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept_sha")).alias("kept_sha256"))


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"), "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_merkle_midstates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, n = table(spark, sf_dir, "documents"), F.col("n_chars")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & n.isNotNull()
    return merkle_manifest(docs, "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "lang", tampered,
                           {"n_chars": n.cast("decimal(20,0)") + 1}).withColumnRenamed("id", "doc_id")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_starts(placed_turns(table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_cross_entropy": op1_lm_cross_entropy,
    "op2_importance_resampling": op2_importance_resampling,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_toxicity_pu": op4_toxicity_pu,
    "op5_mix_to_weights": op5_mix_to_weights,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_gear_chunks": op7_gear_chunks,
    "op8_warc_chunks": op8_warc_chunks,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_merkle_midstates": op11_merkle_midstates,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return sql.oracles()
