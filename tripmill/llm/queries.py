"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import (
    conversation_repair,
    corpus_score,
    decontaminate,
    jaccard_join,
    license_scan,
    line_quality,
    minmax_dedup,
    mixture_pack,
    phrase_mining,
    secret_scan,
    style_tree,
    suffix_dedup,
    warc,
)
from tripmill.llm.common import table


VOCABULARY = "byte_bpe_50k.json"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained_items(documents, benchmark)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_report(table(spark, sf_dir, "documents"))


def op4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_texts(table(spark, sf_dir, "pages"))


def op5_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("file")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_score.scores(table(spark, sf_dir, "documents"))


def op10_mixture_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path(VOCABULARY)
    return mixture_pack.pack(table(spark, sf_dir, "documents"), vocabulary)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def op12_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audited_after_damage(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_line_quality": op3_line_quality,
    "op4_style_tree": op4_style_tree,
    "op5_warc_shards": op5_warc_shards,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secret_scan": op8_secret_scan,
    "op9_context_mixing": op9_context_mixing,
    "op10_mixture_pack": op10_mixture_pack,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_minmax_dedup": op12_minmax_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}
