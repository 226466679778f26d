"""Registered queries of this package: each operator over its whole table.

oracle.py has SQL for five. The others have methods that SQL can't express (weights learned by EM or
from preference pairs, index scores, packing, merges, disclosure, fertility, a permutation) and are
tested by brute force or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.content_archive import from_records, read_archive, write_archive
from tallystar.llm.conversation_repair import ConversationRepair, damaged
from tallystar.llm.disclosure import Sanitiser, joined_spans
from tallystar.llm.feistel import sharded
from tallystar.llm.fertility import fitted_quality
from tallystar.llm.grouped_prefix_join import ngram_jaccard_components
from tallystar.llm.hard_negatives import hard_negatives
from tallystar.llm.interpolation import interpolated_scores
from tallystar.llm.license_index import scan
from tallystar.llm.merge_counts import token_counts
from tallystar.llm.packing import packed
from tallystar.llm.pairwise_quality import ranked
from tallystar.llm.winnowing import benchmark_overlap
from tallystar.session import scratch_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_interpolated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table is read from files as they lie, so both reads give the same blocks.
    return interpolated_scores(_table(spark, sf_dir, "documents"), fixed=True)


def op2_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents")).drop("places")


def op3_content_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark)
    write_archive(_table(spark, sf_dir, "pages"), path)
    return from_records(read_archive(spark, path))


def op4_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op5_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sanitiser(_table(spark, sf_dir, "documents")).documents().select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(joined_spans("base"), 256).alias("base_sha256"),
        joined_spans("spans").alias("spans"),
    )


def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fitted_quality(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "entropy", "script",
    )


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(_table(spark, sf_dir, "documents")).drop("position")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_overlap(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ConversationRepair(damaged(_table(spark, sf_dir, "conversations")), "copies").summary()


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_interpolated_scores,
        op2_license_index,
        op3_content_archive,
        op4_bin_slack_packing,
        op5_merge_counts,
        op6_disclosure,
        op7_fertility,
        op8_feistel_shards,
        op9_winnowing,
        op10_grouped_prefix_join,
        op11_conversation_repair,
        op12_hard_negatives,
        op13_pairwise_quality,
    )
}
