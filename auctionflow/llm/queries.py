"""The registered queries of the corpus operators: name -> fn(spark, sf_dir) -> DataFrame.

Each applies its operator to the whole table and derives the columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auctionflow.llm import bktree, chat, minhash, mixing, packing, quality, secrets, sharding, spelling, spotsigs, substring, toxicity, trie

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_bin_slack_packing(spark, sf):
    packed = packing.pack_documents(documents(spark, sf), TOKENIZER)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_crf_toxicity(spark, sf):
    scored = toxicity.scored_documents(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_toxic")


def op3_blob_ledger_secrets(spark, sf):
    found, _ = secrets.scan_documents(documents(spark, sf))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda x: x["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op4_curriculum_mix(spark, sf):
    mixed = mixing.mix_documents(documents(spark, sf))
    first = F.get(F.col("copies.position"), 0)
    return (mixed.withColumn("first", first).repartitionByRange(F.col("first").asc_nulls_last(), "h")
            .sortWithinPartitions(F.col("first").asc_nulls_last(), "h")
            .select("doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("long").alias("n_copies"),
                    F.round(first * 1_000_000).cast("long").alias("first_position")))


def op5_divergence_quality(spark, sf):
    return quality.judged(documents(spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_similarity_sketch_dedup(spark, sf):
    return minhash.near_duplicates(documents(spark, sf), width=3, percent=85, bands=25, band_rows=5)


def op7_hash_tree_shards(spark, sf):
    return sharding.shard_documents(documents(spark, sf))


def op8_offset_masks(spark, sf):
    own = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    words = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", words), (-7, 1, "assistant", words)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(own.unionByName(more), TOKENIZER))


def op9_lempel_ziv_substrings(spark, sf):
    kept = substring.deduplicated(documents(spark, sf))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_spot_signatures(spark, sf):
    rows = spotsigs.beside_next(documents(spark, sf))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_prefix_trie(spark, sf):
    return trie.conversation_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


def op12_spelling_variants(spark, sf):
    return spelling.variant_groups(documents(spark, sf))


def op13_bk_tree_dedup(spark, sf):
    return bktree.near_duplicates(documents(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_bin_slack_packing, op2_crf_toxicity, op3_blob_ledger_secrets, op4_curriculum_mix, op5_divergence_quality,
    op6_similarity_sketch_dedup, op7_hash_tree_shards, op8_offset_masks, op9_lempel_ziv_substrings, op10_spot_signatures,
    op11_prefix_trie, op12_spelling_variants, op13_bk_tree_dedup)}
