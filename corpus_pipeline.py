"""The training-corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``. Empty and null texts, repeated rows and null ids pass through
as the operators define; extra columns are dropped by the first stage, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm import bpe, mixing, quality
from hindcast.llm.shared import table, written
from hindcast.llm.shingle_join import shingle_classes
from hindcast.llm.substring_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half go. Null and empty texts are scored like any other, by features of zero."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("quality_score >= 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays; those without words or id all stay.

    Rows of one doc_id go or stay each by its own text: several that are near copies of one another stay together, and
    of repeated rows (equal in doc_id and text) one stays."""
    gone = shingle_classes(docs).where("doc_id is not null and component_id <> doc_id").select(F.col("doc_id").alias("_gone"), "text_key").distinct()
    kept = docs.join(gone, (F.col("doc_id") == F.col("_gone")) & (F.xxhash64("text") == F.col("text_key")), "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that occur earlier go; texts without any stay as they are."""
    out = remove_repeats(docs.select(*COLUMNS))
    out = out.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have tempered shares of sources, languages and topics. Documents without words are kept; null
    sources and languages count as the empty string."""
    return mixing.mix(docs).where("kept").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether they decode to its text; null and empty texts have none and decode to nothing."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.round_trip(docs.select(*COLUMNS), path)
    whole = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return out.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: The classifier, the mixing by hash and the tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
