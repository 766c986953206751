"""Queries of the corpus operators on the given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pixelchange.llm import decision_list, decontaminate, dialogue_repair, edit_tokens, lang_id, lexical_rank, licences, ngram_jaccard, norm_search, relative_lz, sentencepiece_rounds, shards, warc
from pixelchange.llm.common import table


def piece_model() -> str:
    """Default tokenizer file of op7; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def rank_file() -> str:
    """Default vocabulary of op5."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.op1_ngram_jaccard(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.op2_quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.op3_substring_dedup(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op4_decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_tokens.op5_token_counts(table(spark, sf_dir, "documents"), rank_file())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.op6_language_id(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_rounds.encode_documents(table(spark, sf_dir, "documents"), piece_model(), with_ids=False)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op8_warc(table(spark, sf_dir, "pages"))


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op11_norm_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_search.op11_norm_search(table(spark, sf_dir, "embeddings"))


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.op12_dialogue_repair(table(spark, sf_dir, "conversations"))


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.op13_lexical_rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_quality_rules": op2_quality_rules,
    "op3_relative_lz": op3_relative_lz,
    "op4_decontaminate": op4_decontaminate,
    "op5_edit_token_counts": op5_edit_token_counts,
    "op6_language_id": op6_language_id,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_warc": op8_warc,
    "op9_extendible_shards": op9_extendible_shards,
    "op10_license_scan": op10_license_scan,
    "op11_norm_search": op11_norm_search,
    "op12_dialogue_repair": op12_dialogue_repair,
    "op13_lexical_rank": op13_lexical_rank,
}

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": ngram_jaccard.links_sql(),
    "op3_relative_lz": relative_lz.removal_sql(),
    "op8_warc": warc.WARC_SQL,
    "op9_extendible_shards": shards.shard_sql(),
    "op10_license_scan": licences.scan_sql(),
    "op11_norm_search": norm_search.search_sql(),
    "op12_dialogue_repair": dialogue_repair.repair_sql(),
    "op13_lexical_rank": lexical_rank.search_sql(),
}
