"""Numbering of special-id ("pseudo") addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.functions.normalize import norm
from ledgerlink.operators.keyed import shuffled_side
from ledgerlink.operators.numbering import allocate, last_numbers
from ledgerlink.staging import stage

# Incoming column and its name in the special-id master.
CONTENT = {
    "qw_employer_name": "empr_nm",
    "addr1": "empr_addrln40_1",
    "addr2": "empr_addrln40_2",
    "addr3": "empr_addrln40_3",
    "city": "empr_city25",
    "state": "empr_st",
    "zip5": "empr_zip5",
    "zip4": "empr_zip4",
}
ON = ["empr_idfr", *CONTENT]


def special_keys(records: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The nine columns that tell special-id entities apart, missing ones as blank."""
    return records.withColumn("empr_idfr", F.coalesce(cfg.special_id, F.lit(""))).withColumns(
        {c: F.coalesce(c, F.lit("")) for c in CONTENT}
    )


def special_inputs(records: DataFrame, cfg: MatchConfig) -> DataFrame:
    rows = special_keys(records, cfg).select(*ON, cfg.record_id)
    return rows.groupBy(*ON).agg(
        F.count(F.lit(1)).alias("n"), F.min(cfg.record_id).alias("first_id")
    )


def match_special(inputs: DataFrame, master: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Inputs with the number of an equal master address, where those are reused."""
    if not cfg.reuse_special:
        return inputs.withColumn("empr_snum", F.lit(None).cast("int"))
    known = (
        master.select(
            "empr_idfr", *[norm(F.col(m)).alias(f"_{c}") for c, m in CONTENT.items()], "empr_snum"
        )
        .groupBy("empr_idfr", *[f"_{c}" for c in CONTENT])
        .agg(F.min("empr_snum").alias("empr_snum"))
    )
    keyed = inputs.withColumns({f"_{c}": norm(F.col(c)) for c in CONTENT})
    return keyed.join(shuffled_side(known), ["empr_idfr", *[f"_{c}" for c in CONTENT]], "left").drop(
        *[f"_{c}" for c in CONTENT]
    )


def number_special(
    matched: DataFrame, master: DataFrame, cfg: MatchConfig, last: DataFrame | None = None
) -> DataFrame:
    """``matched`` (staged) with the next numbers of each special id, by first record.

    ``last`` holds the numbers in use where they are kept, here and below.
    """
    new = allocate(
        matched.filter(F.col("empr_snum").isNull()),
        [last_numbers(last, master, ["empr_idfr"], "empr_snum")],
        ["empr_idfr"],
        ["first_id"],
        "empr_snum",
        cfg.limits,
    )
    return matched.filter(F.col("empr_snum").isNotNull()).unionByName(new)


def special_table(
    records: DataFrame, master: DataFrame, cfg: MatchConfig, last: DataFrame | None = None
) -> DataFrame:
    matched = match_special(special_inputs(records, cfg), master, cfg)
    matched = stage(matched, "special_matched")
    return stage(number_special(matched, master, cfg, last), "special_table")
