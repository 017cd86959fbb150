"""Registered queries of the training-data operators: thin wrappers that give the contracts' columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bottom_k, decontaminate, hard_negatives, ngram_join, packing, phrase_dedup, pii, quality_rules, spelling, suffix_dedup, token_codes, url_filter, warc
from .common import read, scratch


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_pii_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.detect(docs, pii.fit(docs))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "shards")
    manifest = token_codes.write_shards(read(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"), "words", end_id=2)
    return token_codes.read_shards(spark, folder, manifest)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), "blanks", end_id=1, with_ids=False)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    files = warc.write_archives(read(spark, sf_dir, "pages"), folder)
    return warc.digests(warc.read_archives(spark, folder, files))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"), with_kept=False)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(read(spark, sf_dir, "documents"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.dedup(read(spark, sf_dir, "documents"), with_kept=False)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = quality_rules.learn_rules(docs, read(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), vec_id % 100 == 0, vec_id, moved, F.col("embedding"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_copies(read(spark, sf_dir, "documents"))


QUERIES = (op1_pii_segments, op2_token_codes, op3_packing, op4_warc, op5_suffix_dedup, op6_url_filter,
           op7_ngram_jaccard_join, op8_phrase_dedup, op9_benchmark_decontamination, op10_quality_rules, op11_hard_negatives,
           op12_spelling_variants, op13_minhash_near_dedup)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op9_benchmark_decontamination": decontaminate.ORACLE, "op11_hard_negatives": hard_negatives.ORACLE,
            "op13_minhash_near_dedup": bottom_k.ORACLE}
