"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import alignment, decontaminate, exact_dedup, jaccard, language_id, packing, quality, sharding, spelling, substring_dedup, suffix_dedup, toxicity, url_filter
from corpusprep.llm.common import read


#: The rules that op2 is asked to apply (fixed values).
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

SHARDS = 16

#: A tokenizer file, and the same vocabulary as ranks.
TOKENIZER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _fold(folds: int):
    """A document's fold: the crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    model = toxicity.fit(documents, read(spark, folder, "labels", "doc_id", "toxic"), _fold(3) != 1)
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_features")


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = ", ".join(f"('{r}', '{v}')" for r, v in URL_RULES.items())
    rules = spark.sql(f"select * from values {listed} as t(rule, verdict)")
    return url_filter.filter_urls(read(spark, folder, "pages", "page_id", "url"), rules)


def op3_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text", "lang")
    predicted = language_id.predict(documents, language_id.fit(documents, _fold(4) != 2), keep=["doc_id"])
    return predicted.select("doc_id", (_fold(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_recompression_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(read(spark, folder, "documents", "doc_id", "text")))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    classes = jaccard.jaccard_classes(read(spark, folder, "documents", "doc_id", "text"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op6_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    return sharding.assign_shards(documents, sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1))


def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read(spark, folder, "documents", "doc_id", "text")))


def op8_latent_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.apply_rules(read(spark, folder, "documents", "doc_id", "text"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents", "doc_id", "text"), *TOKENIZER)


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents", "doc_id", "text")
    return alignment.align(documents, TOKENIZER[0], public_tokenizers.path("piece_bpe_32k.model"), TOKENIZER[1]).documents


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, folder, "documents", "doc_id", "text"), edit_every=spelling.EDIT_EVERY)


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_copies(read(spark, folder, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filter": op2_url_filter,
    "op3_language_centroids": op3_language_centroids,
    "op4_recompression_dedup": op4_recompression_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_hash_tree_shards": op6_hash_tree_shards,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_latent_decontamination": op8_latent_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES: dict[str, str] = {
    "op2_url_filter": url_filter.filter_sql(URL_RULES),
    "op4_recompression_dedup": substring_dedup.digest_sql(),
    "op5_jaccard_join": jaccard.classes_sql(),
    "op6_hash_tree_shards": sharding.shards_sql(sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1)),
    "op7_suffix_array_dedup": suffix_dedup.digest_sql(),
    "op9_quality_rules": quality.rules_sql(),
    "op12_spelling_variants": spelling.variants_sql(),
    "op13_exact_dedup": exact_dedup.copies_sql(),
}
