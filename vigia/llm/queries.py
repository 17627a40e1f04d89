"""Registered queries of the text operators, over their whole tables.

Each calls its operator with production parameters and derives the digest
columns that the query returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from . import (conversation_repair, html_templates, lexical_search, pii_surrogates, quality_gbt, quality_rules, secret_battery,
               sentencepiece_bpe, simhash_variants, sql, substring_dedup, suffix_dedup, toxicity_fm)
from .decontaminate import mark_contamination


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_contamination(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                read_table(spark, sf_dir, "benchmark", "item_id", "text"), keep_text=False)
    found = F.col("contamination")
    return marked.select(
        "doc_id", found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        (found["n_hit"] > 0).alias("contaminated"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    forest = quality_gbt.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return (quality_gbt.score(docs, forest, keep_text=False)
            .select("doc_id", quality_gbt.held_out().alias("held_out"), "score", "predicted"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pii_surrogates.replace_entities(docs).select("doc_id", "text")


def tokenizer_path() -> str:
    """Where the public 32k SentencePiece model lies (a file of the driver)."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path(),
                                    keep_text=False, digests=True)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_rules.judge(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
            .drop("char_distance", "word_distance"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                          window=13, digests=True)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_battery.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"), digests=True, keep_text=False)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"), least=400, digests=True)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_variants.link_components(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                             shingle=3, max_distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    cut = conversation_repair.blocks(conversation_repair.damage(conversations))
    walked = conversation_repair.walk(cut)
    found = conversation_repair.report(conversations, cut, walked)
    return conversation_repair.with_digests(found, cut, walked)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    machine = toxicity_fm.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return (toxicity_fm.score(docs, machine, keep_text=False)
            .select("doc_id", toxicity_fm.held_out().alias("held_out"), "score", "predicted"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                 read_table(spark, sf_dir, "benchmark", "item_id", "text"), k=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_pii_surrogates": op2_pii_surrogates,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_html_extraction": op4_html_extraction,
        "op5_quality_rules": op5_quality_rules,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_secret_scan": op7_secret_scan,
        "op8_benchmark_decontamination": op8_benchmark_decontamination,
        "op9_suffix_array_dedup": op9_suffix_array_dedup,
        "op10_simhash_near_dedup": op10_simhash_near_dedup,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_toxicity": op12_toxicity,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": sql.quality_rules_sql(),
        "op6_substring_dedup": sql.SUBSTRING_DEDUP,
        "op8_benchmark_decontamination": sql.DECONTAMINATION,
        "op11_conversation_repair": sql.CONVERSATION_REPAIR,
        "op13_lexical_search": sql.LEXICAL_SEARCH,
    }
