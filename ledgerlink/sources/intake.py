"""Reading submissions: lines, rejects, fields, field rules and record ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.sources.layout import parse
from ledgerlink.staging import stage_noted

MIN_LENGTH = 2
REJECT_REASON = "EOF marker or empty record"
NO_SSN = "000000000"

# The reject text above, and the names below.
# Flag column, masked input column, name of the derived column.
FLAG_GUARDS = [
    ("qw_frgn_empr_flg_cc", "qw_empr_forgn_cc", "empr_forgn_cc"),
    ("qw_frgn_empr_flg_cname", "qw_empr_forgn_c_name", "empr_forgn_c_name"),
    ("qw_frgn_empr_flg_czip", "qw_empr_forgn_zip", "empr_forgn_zip"),
    ("qw_frgn_opt_flg_cc", "qw_er_opt_frn_cc", "opt_empr_forgn_cc"),
    ("qw_frgn_opt_flg_cname", "qw_er_opt_frn_c_name", "opt_empr_forgn_c_name"),
    ("qw_frgn_opt_flg_czip", "qw_er_opt_frn_zip", "opt_empr_forgn_zip"),
]

# Second name of a field, as the matching steps use it.
ALIASES = {
    "addr1": "qw_empr_address1",
    "addr2": "qw_empr_address2",
    "addr3": "qw_empr_address3",
    "city": "qw_empr_city",
    "state": "qw_empr_state",
    "zip5": "qw_empr_zip_5",
    "zip4": "qw_empr_zip_4",
    "opt_addr1": "qw_empr_opt_address1",
    "opt_addr2": "qw_empr_opt_address2",
    "opt_addr3": "qw_empr_opt_address3",
    "opt_city": "qw_empr_opt_city",
    "opt_state": "qw_empr_opt_state",
    "opt_zip5": "qw_empr_opt_zip_5",
    "opt_zip4": "qw_empr_opt_zip_4",
    "frgn_empr_flag_cc": "qw_frgn_empr_flg_cc",
    "frgn_empr_flag_cname": "qw_frgn_empr_flg_cname",
    "frgn_empr_flag_czip": "qw_frgn_empr_flg_czip",
    "frgn_opt_flag_cc": "qw_frgn_opt_flg_cc",
    "frgn_opt_flag_cname": "qw_frgn_opt_flg_cname",
    "frgn_opt_flag_czip": "qw_frgn_opt_flg_czip",
    "is_batch_999999": "is_batch_num_999999_test",
    "empr_addr_inp_ind_cd": "empr_addr_ind_input",
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the name of the file each came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("source_file"))


def split_valid(df: DataFrame, min_len: int = MIN_LENGTH) -> tuple[DataFrame, DataFrame]:
    """Records, and rejected lines with reason and length."""
    length = F.length("value")
    valid = df.filter(length >= min_len)
    rejects = df.filter(length < min_len).select(
        "value", F.lit(REJECT_REASON).alias("reject_reason"), length.alias("record_length")
    )
    return valid, rejects


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejected lines as CSV with a header."""
    rejects.write.mode("overwrite").option("header", True).csv(path)


def mask_invalid(df: DataFrame) -> DataFrame:
    """Zero both SSNs where validation failed."""
    bad = F.col("ssn_val_code") == "I"
    return df.withColumns(
        {c: F.when(bad, NO_SSN).otherwise(F.col(c)) for c in ("wrk_ssn", "final_ssn")}
    )


def _is_id(c: Column) -> Column:
    return (F.length(F.trim(c)) == 9) & c.rlike("^[0-9]{9}$")


def validate_id(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Code ``I`` for an id that is not nine digits; such records lose their names."""
    code = F.when(~_is_id(F.col(cfg.special_id)), "I").otherwise(F.col("vald_ein_cd"))
    coded = df.withColumn("vald_ein_cd", code)
    bad = F.col("vald_ein_cd") == "I"
    return coded.withColumns(
        {c: F.when(bad, "").otherwise(F.col(c)) for c in ("final_empr_nm", "wrk_empr_nm")}
    )


def flag_guard(df: DataFrame) -> DataFrame:
    """Foreign fields only where their flag is ``Y``, under both names."""
    out = {}
    for flag, field, derived in FLAG_GUARDS:
        value = F.when(F.col(flag) == "Y", F.col(field))
        out[derived] = value
        out[field] = value
    return df.withColumns(out)


def alias_project(df: DataFrame) -> DataFrame:
    return df.withColumns({a: F.col(c) for a, c in ALIASES.items()})


def validate(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    return alias_project(flag_guard(validate_id(mask_invalid(df), cfg)))


# What matching, the main temp table and the change-sets need of a record.
MATCH_COLUMNS = """
vald_ein_cd work_ein qw_employer_name addr1 addr2 addr3 city state zip5 zip4
empr_forgn_cc empr_forgn_c_name empr_forgn_zip
opt_addr1 opt_addr2 opt_addr3 opt_city opt_state opt_zip5 opt_zip4
opt_empr_forgn_cc opt_empr_forgn_c_name opt_empr_forgn_zip
batch_number is_batch_999999 state_key_code empr_addr_inp_ind_cd fnl_empr_err_tab
""".split()


def fields(lines: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Every field of a line, validated; fields nobody reads are never cut."""
    return validate(parse(lines), cfg)


def matchable(lines: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Id, whole line, and the fields matching needs.

    The other fields stay in the line until the output is written: cutting them again is
    cheaper than storing them one by one, and a step that needs no line does not read it.
    """
    return fields(lines, cfg).select(cfg.record_id, "value", cfg.special_id, *MATCH_COLUMNS)


@dataclass(frozen=True)
class Intake:
    """A batch after its one read: what was found in it, counted in the same pass."""

    records: DataFrame
    rejects: DataFrame
    lines: int
    rejected: int
    first_file: str | None


def take_in(lines: DataFrame, cfg: MatchConfig) -> Intake:
    """Records and rejected lines of a batch, staged apart in one pass over the lines.

    The record id holds from the stage on.
    """
    seen = Observation()
    short = F.length("value") < MIN_LENGTH
    watched = lines.observe(
        seen,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(short).alias("rejected"),
        F.min("source_file").alias("first_file"),
    )
    numbered = watched.select("value", F.monotonically_increasing_id().alias(cfg.record_id))
    marked = matchable(numbered, cfg).withColumn("_rejected", short)
    both, found = stage_noted(marked, "lines", lambda: dict(seen.get), by=["_rejected"])
    return Intake(
        records=both.filter(~F.col("_rejected")).drop("_rejected"),
        rejects=split_valid(both.filter("_rejected"))[1],
        **found,
    )
