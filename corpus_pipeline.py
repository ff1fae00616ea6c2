"""The corpus pipeline: documents in, packed training sequences out.

Every stage reads what the stage before wrote, takes decisions that hold, and all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import decontaminate, jaccard, packing, quality, suffix_dedup
from corpusprep.llm.queries import TOKENIZER
from corpusprep.session import drop_scratch, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents whose shingle sets are alike, the smallest id stays. Three
    words and 90 %: with five words and 80 % the exact join does not end in time."""
    return jaccard.one_of_each(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier go from the texts."""
    return suffix_dedup.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.without_leaks(docs, benchmark)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token sequences, a row per piece."""
    return packing.pack_documents(docs.select("doc_id", "text"), *TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", packed_sequences),
]

#: The tokenizer has no counterpart in SQL; tests hold ``run`` against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each is written and read again, and dropped
    when the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_scratch(spark, before)
        before = path
    return docs
