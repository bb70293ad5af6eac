"""Documents to training tokens: quality, near copies, benchmark passages, encoding.

Each stage takes what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm.common import table
from ledgerlink.llm.decontaminate import keep_clean
from ledgerlink.llm.pieces import round_trip
from ledgerlink.llm.queries import PIECE_BPE
from ledgerlink.llm.rules import keep_good, learn_quality
from ledgerlink.llm.simhash import keep_one, simhash_groups
from ledgerlink.staging import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    return keep_good(docs, learn_quality(docs, table(spark, sf_dir, "labels")))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs, simhash_groups(docs, size=4, distance_bits=4), size=4, distance_bits=4)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ends, decoded) of every document that is left: its pieces, and the text they give."""
    return round_trip(docs, public_tokenizers.path(PIECE_BPE))


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", keep_distinct),
    ("benchmark decontamination", keep_uncontaminated),
    ("SentencePiece encoding and decoding", encode),
]

# Learned weights, XXH64 and merges have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "_").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
