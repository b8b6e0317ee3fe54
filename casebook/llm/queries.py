"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import bpe, conversations, jaccard, mixing, packing, pii, quality, suffix_dedup, topk, toxicity, url_filter, warc, whitening
from casebook.sources.tables import read_table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id", "text")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(BPE_RANKS)
    return bpe.digests(bpe.encode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_documents(spark, sf_dir), n=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    scored = toxicity.score_documents(documents, toxicity.train(documents, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return pii.find_personal_data(documents, pii.train(documents))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), PACKING_TOKENIZER)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages", "page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "lm_score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair_report(rows, conversations.damage(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_warc": op5_warc,
    "op6_toxicity": op6_toxicity,
    "op7_pii": op7_pii,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_url_filter": op10_url_filter,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {"op5_warc": warc.SQL, "op8_exact_top_k": topk.SQL, "op13_conversation_repair": conversations.SQL}
