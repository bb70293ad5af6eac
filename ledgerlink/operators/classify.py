"""Sorting records into unknown, special-id ("pseudo") and regular ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import is_blank

UNKNOWN, PSEUDO, REGULAR = "unknown", "pseudo", "regular"


def _sure(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def unknown_test() -> Column:
    nameless = (F.col("empr_addr_inp_ind_cd") == "X") & is_blank(F.col("qw_employer_name"))
    test_batch = (F.col("batch_number") == "999999") | (F.col("is_batch_999999") == "Y")
    return _sure(nameless) | _sure(test_batch)


def pseudo_test(cfg: MatchConfig) -> Column:
    sid = F.col(cfg.special_id)
    letter = F.substring(F.trim(sid), 1, 1) == "A"
    zeros = F.substring(F.lpad(F.trim(sid), 9, "0"), 3, 7) == "0" * 7
    listed = sid.isin(*cfg.exception_ids) if cfg.exception_ids else F.lit(False)
    return _sure(letter) | _sure(zeros) | _sure(listed)


def classify(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """One class per record, decided row by row: no join, and nothing falls between."""
    cls = F.when(unknown_test(), UNKNOWN).when(pseudo_test(cfg), PSEUDO).otherwise(REGULAR)
    return df.withColumn("cls", cls)


def unknown_outcome(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Unknown records keep pointer 0 and blank indicators."""
    return df.filter(F.col("cls") == UNKNOWN).select(
        cfg.record_id,
        "cls",
        *[F.lit(0).alias(c) for c in ("empr_name_pntr", "empr_addr_pntr", "empr_opt_addr_pntr")],
        *[
            F.lit(" ").alias(c)
            for c in ("empr_table_ind", "empr_name_ind", "empr_addr_ind", "empr_opt_addr_ind")
        ],
        "empr_addr_inp_ind_cd",
    )
