"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm import alignment, bpe, mixing, oracle, quality, secret_scan, token_store
from hindcast.llm.divergence import divergence
from hindcast.llm.near_vectors import near_duplicates
from hindcast.llm.neighbours import nearest_neighbours
from hindcast.llm.pitman_yor import language_model_scores
from hindcast.llm.shared import new_path, table
from hindcast.llm.sharding import assign_shards
from hindcast.llm.shingle_join import shingle_classes
from hindcast.llm.substring_dedup import remove_repeats


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through a written token store, read back."""
    path = new_path(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return token_store.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 20 words that occur earlier."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to ids and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_p_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with their near duplicates of the same label."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_rake_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their weight in a mix of tempered sources, languages and topics, and whether they are drawn."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens", "factor", "probability", "kept")


def op6_ivf_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest embeddings to each whose id is divisible by 50."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their near copies."""
    return shingle_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with log10 probabilities under a model of those that are not held out."""
    return language_model_scores(table(spark, sf_dir, "documents"))


def op9_shard_by_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards of near-equal bytes; equal texts have one key and stand side by side."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key"))
    out = assign_shards(docs, F.col("text_key"), F.col("size"), ["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the score of a model fitted on labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.score(docs, model, to="score").drop("text")
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_owner_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the groups and links of their tokens by two tokenizers, and how common the links are."""
    aligned = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.with_link_counts(aligned.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups"))


def op12_group_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of a language by their word use, and the terms that each source uses more than its language."""
    return divergence(table(spark, sf_dir, "documents"))


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda secret: secret["kind"] == kind


def op13_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their secrets: fixed patterns, and values in a credential's place that are hard to guess."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    count = {f"n_{k}": F.size(F.filter("secrets", _of_kind(k))).cast("bigint") for k in secret_scan.KINDS}
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *[c.alias(n) for n, c in count.items()], F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("secrets")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_store, op2_substring_dedup, op3_byte_bpe, op4_p_stable, op5_rake_mix, op6_ivf_pq, op7_shingle_join, op8_pitman_yor, op9_shard_by_splitters, op10_quality_gam, op11_owner_alignment, op12_group_tiles, op13_guess_cost)}
ORACLE_SQL: dict[str, str] = {"op2_substring_dedup": oracle.OP2, "op4_p_stable": oracle.OP4, "op7_shingle_join": oracle.OP7, "op12_group_tiles": oracle.OP12}
