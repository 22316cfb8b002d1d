"""From raw documents to tokens: language, copies, near copies, benchmark leaks, encoding.

Every stage takes (spark, docs, sf_dir), works on all that the one before has kept, and is
written as Parquet and read again as the next one's documents. All but the last return the
columns of the documents. Rows may lack an id or share it; an id and its text tell rows
apart. An empty table goes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import byte_bpe, decontamination, exact_dedup, jaccard_join, language_id
from changelake.llm.columns import chosen, small_batches, stored, table


def _decisions(found: DataFrame, kept: Column) -> DataFrame:
    return found.select(F.col("doc_id").alias("id"), "text_hash", kept.alias("kept"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; texts without letters, and letters like no language, go."""
    small_batches(spark)
    return language_id.accepted(docs, language_id.learn(docs, "doc_id", "text", "lang"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest id of each group of equal texts."""
    small_batches(spark)
    return chosen(docs, _decisions(exact_dedup.deduplicate(docs), F.col("kept")))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of smallest id of each class of texts that similarity links."""
    small_batches(spark)
    return chosen(docs, _decisions(jaccard_join.jaccard_components(docs), F.col("kept")))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, nor one with other values."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return chosen(docs, _decisions(found, ~F.col("contaminated")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, and the token ids as little-endian unsigned 32-bit integers."""
    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", remove_copies),
    ("n-gram Jaccard join", remove_near_copies),
    ("benchmark decontamination", remove_leaks),
    ("byte-level BPE encoding and decoding", encode),
]

#: SQL can't express the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
