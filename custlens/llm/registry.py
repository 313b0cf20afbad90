"""Registered queries of the subpackage; each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from custlens.llm import (chat_format, cotrain, decontaminate, html_wrapper, jaccard_join,
                          language_id, ngram_trie, packing, quality_rules, secret_scan, source_audit,
                          spelling, token_files)
from custlens.llm.common import read_table


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score(read_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(read_table(spark, sf_dir, "documents"),
                                quality_rules.trusted_ids(read_table(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op4_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_text(read_table(spark, sf_dir, "pages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "benchmark"))


def op6_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_files(
        spark, token_files.write_files(read_table(spark, sf_dir, "documents")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return chat_format.digest(chat_format.format_turns(turns.unionByName(extra)))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).drop("blob")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(read_table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_trie": op1_ngram_trie,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_html_wrapper": op4_html_wrapper,
    "op5_decontaminate": op5_decontaminate,
    "op6_cotrain": op6_cotrain,
    "op7_token_files": op7_token_files,
    "op8_chat_format": op8_chat_format,
    "op9_secret_scan": op9_secret_scan,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_source_audit": op11_source_audit,
    "op12_language_id": op12_language_id,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = {"op11_source_audit": source_audit.SQL}
