"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import (
    anchors,
    decontaminate,
    lattice,
    licenses,
    oracles,
    packing,
    phrases,
    quality,
    rules,
    shards,
    simhash,
    suffixes,
    toxicity,
    tries,
)
from gaugeworks.llm.common import read

WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    """Where the installed vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bm25_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, directory, "documents"), read(spark, directory, "benchmark"))


def op2_additive_quality(spark: SparkSession, directory: str) -> DataFrame:
    return quality.quality_scores(read(spark, directory, "documents"), read(spark, directory, "labels"))


def op3_best_fit_shards(spark: SparkSession, directory: str) -> DataFrame:
    return shards.shard_documents(read(spark, directory, "documents"), shards=24)


def op4_license_join(spark: SparkSession, directory: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, directory, "documents"))


def op5_block_anchors(spark: SparkSession, directory: str) -> DataFrame:
    return anchors.repeated_words(read(spark, directory, "documents"))


def op6_vector_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack_documents(read(spark, directory, "documents"), tokenizer_path())


def op7_suffix_array(spark: SparkSession, directory: str) -> DataFrame:
    return suffixes.repeated_bytes(read(spark, directory, "documents"))


def op8_rule_cascade(spark: SparkSession, directory: str) -> DataFrame:
    return rules.quality_rules(read(spark, directory, "documents"))


def op9_simhash_covering(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.near_components(read(spark, directory, "documents"))


def op10_pu_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, directory, "documents"), read(spark, directory, "labels"))


def op11_lattice_embeddings(spark: SparkSession, directory: str) -> DataFrame:
    return lattice.similar_vectors(read(spark, directory, "embeddings"))


def op12_phrase_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return phrases.collocations(read(spark, directory, "documents"))


def op13_conversation_trie(spark: SparkSession, directory: str) -> DataFrame:
    return tries.conversation_trie(read(spark, directory, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bm25_decontamination": op1_bm25_decontamination,
    "op2_additive_quality": op2_additive_quality,
    "op3_best_fit_shards": op3_best_fit_shards,
    "op4_license_join": op4_license_join,
    "op5_block_anchors": op5_block_anchors,
    "op6_vector_packing": op6_vector_packing,
    "op9_simhash_covering": op9_simhash_covering,
    "op10_pu_toxicity": op10_pu_toxicity,
    "op7_suffix_array": op7_suffix_array,
    "op8_rule_cascade": op8_rule_cascade,
    "op11_lattice_embeddings": op11_lattice_embeddings,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_conversation_trie": op13_conversation_trie,
}

SQL: dict[str, str] = {
    "op4_license_join": oracles.LICENSE_JOIN,
    "op5_block_anchors": oracles.BLOCK_ANCHORS,
    "op8_rule_cascade": oracles.RULE_CASCADE,
    "op12_phrase_collocations": oracles.COLLOCATIONS,
    "op13_conversation_trie": oracles.CONVERSATION_TRIE,
}
