"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import table
from ledgerlink.llm.decontaminate import contamination, contamination_sql
from ledgerlink.llm.hard_negatives import hard_negatives, hard_negatives_sql, relabelled
from ledgerlink.llm.licenses import license_scan, license_sql
from ledgerlink.llm.line_dedup import line_dedup, line_dedup_sql
from ledgerlink.llm.merkle import merkle_audit, merkle_sql
from ledgerlink.llm.pieces import round_trip
from ledgerlink.llm.ppm import ppm_scores
from ledgerlink.llm.rules import quality
from ledgerlink.llm.simhash import simhash_groups
from ledgerlink.llm.token_counts import token_counts
from ledgerlink.llm.token_files import token_files
from ledgerlink.llm.topk import top_k, top_k_sql
from ledgerlink.llm.url_filter import url_verdicts, url_verdicts_sql

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), size=4, distance_bits=4)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=2)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every_nth=100, k=10, scale=1024)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))
    return pieces.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2("ends", 256).alias("spans_sha256"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_audit(table(spark, sf_dir, "documents"), every_nth=3)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"), min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relabelled(table(spark, sf_dir, "embeddings"), every_nth=7, labels=10)
    return hard_negatives(rows, every_nth=100, positives=5, negatives=5, scale=256, share=(80, 100))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scans": op2_license_scans,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filters": op6_url_filters,
    "op7_token_files": op7_token_files,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_line_dedup": op12_line_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op2_license_scans": license_sql(),
    "op5_benchmark_decontamination": contamination_sql(),
    "op6_url_filters": url_verdicts_sql(),
    "op8_exact_top_k": top_k_sql(),
    "op11_merkle_manifest": merkle_sql(),
    "op12_line_dedup": line_dedup_sql(),
    "op13_hard_negatives": hard_negatives_sql(),
}
