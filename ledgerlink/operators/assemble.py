"""Putting the classes together again, checking that nothing got lost, and output shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INDICATORS = ["empr_table_ind", "empr_name_ind", "empr_addr_ind", "empr_opt_addr_ind"]
POINTERS = ["empr_name_pntr", "empr_addr_pntr", "empr_opt_addr_pntr"]
FOREIGN = [
    "qw_empr_forgn_cc",
    "qw_empr_forgn_c_name",
    "qw_empr_forgn_zip",
    "qw_er_opt_frn_cc",
    "qw_er_opt_frn_c_name",
    "qw_er_opt_frn_zip",
]

# The columns of the enriched file in order, "output=source" where renamed.
_OUTPUT = """
qw_employer_ein=work_ein file_name file_rec_num_id file_addr1_id file_addr2_id
connect_direct_node file_node_rdate file_node_ttime state_key_code=state_key_code_full
transmission_type dod_code sort_key_date sort_key_time batch_number ver_cntl
submitter_datestamp receipt_datestamp hdr_bypass_cd_on is_batch_num_999999_test
record_status cntl_fld_odc_or_filler out_err_cnt out_err_cd_1 out_err_cd_2 out_err_cd_3
out_err_cd_4 out_err_cd_5 ssn_val_code ssn_vrfd_cd ssn_vldtn_cd namesearch_score_11
namesearch_score_12 final_ssn final_first_nm final_middle_nm final_last_nm final_empr_nm
ssn_sequence_num submn_uid empr_ein empr_table_ind empr_name_ind empr_name_pntr
qw_frgn_empr_flg_cc qw_frgn_empr_flg_cname qw_frgn_empr_flg_czip qw_frgn_opt_flg_cc
qw_frgn_opt_flg_cname qw_frgn_opt_flg_czip vald_ssn_chg_cd vald_ein_cd vald_wage_amt_cd
vald_rpt_prd_cd wrk_ssn wrk_first_nm wrk_middle_nm wrk_last_nm wrk_empr_nm wrk_rpt_prd_qtr
wrk_rpt_prd_year wrk_wage_amt_x qw_identifier qw_employee_ssn qw_empe_first_name
qw_empe_middle_name qw_empe_last_name qw_empe_wage_amt qw_rpt_period_q qw_rpt_period_cc
qw_rpt_period_yy qw_employer_st_ein qw_employer_name qw_empr_address1 qw_empr_address2
qw_empr_address3 qw_empr_city qw_empr_state qw_empr_zip_5 qw_empr_zip_4 qw_empr_forgn_cc
qw_empr_forgn_c_name qw_empr_forgn_zip qw_empr_opt_address1 qw_empr_opt_address2
qw_empr_opt_address3 qw_empr_opt_city qw_empr_opt_state qw_empr_opt_zip_5
qw_empr_opt_zip_4 qw_er_opt_frn_cc qw_er_opt_frn_c_name qw_er_opt_frn_zip
fnl_empr_address1 fnl_empr_address2 fnl_empr_address3 fnl_empr_city fnl_empr_state
fnl_empr_zip_5 fnl_empr_zip_4 fnl_empr_err_tab fnl_frgn_cc fnl_frgn_c_name fnl_frgn_zip
fnl_opt_address1 fnl_opt_address2 fnl_opt_address3 fnl_opt_city fnl_opt_state
fnl_opt_zip_5 fnl_opt_zip_4 fnl_opt_err_tab fnl_opt_frgn_cc fnl_opt_frgn_c_name
fnl_opt_frgn_zip seq_num=file_rec_num_id empr_addr_pntr empr_opt_addr_pntr empr_addr_ind
empr_opt_addr_ind
"""
OUTPUT = [(o, s or o) for o, _, s in (item.partition("=") for item in _OUTPUT.split())]
UNTRIMMED = {"state_key_code"}
AS_INT = {"file_rec_num_id"}

# The columns of the main temp table in order.
MAIN_COLUMNS = """
work_ein qw_employer_name addr1 addr2 addr3 city state zip5 zip4
empr_forgn_cc empr_forgn_c_name empr_forgn_zip
opt_addr1 opt_addr2 opt_addr3 opt_city opt_state opt_zip5 opt_zip4
opt_empr_forgn_cc opt_empr_forgn_c_name opt_empr_forgn_zip
batch_number state_key_code empr_name_pntr empr_addr_pntr empr_opt_addr_pntr
empr_addr_inp_ind_cd
""".split()
# What the change-sets need beside those.
CHANGE_COLUMNS = [*INDICATORS, "fnl_empr_err_tab"]


def align_union(frames: Sequence[DataFrame], defaults: Mapping[str, Column]) -> DataFrame:
    """Union by name; a column missing somewhere gets its default, else NULL."""
    columns = list(dict.fromkeys(c for df in frames for c in df.columns))

    def filled(df: DataFrame) -> DataFrame:
        gaps = {c: defaults[c] for c in columns if c not in df.columns and c in defaults}
        return df.withColumns(gaps) if gaps else df

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [filled(df) for df in frames]
    )


def role_defaults() -> dict[str, Column]:
    """Blank indicators, pointer 0, no foreign text."""
    return {
        **{c: F.lit(" ") for c in INDICATORS},
        **{c: F.lit(0) for c in POINTERS},
        **{c: F.lit(None).cast("string") for c in FOREIGN},
    }


def check_conserved(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: ids in and out, and how many are missing, added or repeated."""

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            key, *[F.lit(int(s == side)).alias(s) for s in ("_before", "_after")]
        )

    per_id = (
        tagged(before, "_before")
        .unionByName(tagged(after, "_after"))
        .groupBy(key)
        .agg(F.sum("_before").alias("b"), F.sum("_after").alias("a"))
    )
    b, a = F.col("b"), F.col("a")

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)

    return per_id.agg(
        total(b, "rows_before"),
        total(a, "rows_after"),
        total(((b > 0) & (a == 0)).cast("int"), "missing"),
        total(((b == 0) & (a > 0)).cast("int"), "added"),
        total(((b > 1) | (a > 1)).cast("int"), "repeated"),
    )


class RecordsLost(ValueError):
    """The records that came out are not the records that went in."""


def fingerprint(df: DataFrame, key: str) -> tuple:
    """Count and two order-free sums over the hashed ids: one pass, no shuffle."""
    h = F.xxhash64(key)
    return tuple(
        df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    )


def require_conserved(before: DataFrame, after: DataFrame, key: str) -> None:
    """Stop the run if ids were lost, added or repeated; look closer only then."""
    if fingerprint(before, key) != fingerprint(after, key):
        found = check_conserved(before, after, key).first().asDict()
        raise RecordsLost(f"records not conserved: {found}")


def summary(df: DataFrame) -> DataFrame:
    """Records per class, counted in one pass."""
    return df.groupBy("cls").agg(F.count(F.lit(1)).alias("records"))


def run_summary(df: DataFrame, lines: int, rejected: int) -> DataFrame:
    """All lines, rejected lines, and the records of each class."""
    counts = df.sparkSession.createDataFrame([("lines", lines), ("rejected", rejected)], "cls string, records bigint")
    return counts.unionByName(summary(df))


def payload_rejoin(narrow: DataFrame, wide: DataFrame, key: str) -> DataFrame:
    """Bring the wide columns back, once, after all narrow work is done.

    The narrow rows are hashed, so the wide ones are not sorted.
    """
    return narrow.hint("shuffle_hash").join(wide, key, "left")


def enriched_output(df: DataFrame) -> DataFrame:
    """The enriched file: renamed, trimmed, no NULL in the foreign fields."""
    types = dict(df.dtypes)

    def shaped(out: str, src: str) -> Column:
        c = F.col(src)
        if out in AS_INT:
            return F.trim(c).try_cast("int").alias(out)
        if out in FOREIGN:
            c = F.coalesce(c, F.lit(""))
        if types[src] == "string" and out not in UNTRIMMED:
            c = F.trim(c)
        return c.alias(out)

    return df.select(*[shaped(o, s) for o, s in OUTPUT])


def padded_id() -> Column:
    """The id as the masters hold it."""
    return F.rpad("work_ein", 9, " ")


def main_tmp(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The main temp table; ids are padded to nine characters."""
    padded = padded_id().alias("work_ein")
    return df.select(*[padded if c == "work_ein" else F.col(c) for c in MAIN_COLUMNS], *extra)


def packed_outcome(outcome: DataFrame, key: str) -> DataFrame:
    return outcome.select(key, F.struct(*[c for c in outcome.columns if c != key]).alias("_out"))


def join_outcome(df: DataFrame, outcome: DataFrame, key: str) -> DataFrame:
    """Every row of ``df`` with its outcome, packed into one column. Outcomes are hashed, so the rows are not sorted."""
    return df.join(packed_outcome(outcome, key).hint("shuffle_hash"), key, "left")


def take_outcome(df: DataFrame) -> DataFrame:
    """Unpack the outcome: it replaces what the record said, where it says something."""
    taken = [*POINTERS, *INDICATORS, "cls"]
    return df.drop(*taken).withColumns(
        {
            **{c: F.col("_out")[c] for c in taken},
            "qw_employer_name": F.coalesce(F.col("_out.filled_name"), "qw_employer_name"),
            "empr_addr_inp_ind_cd": F.coalesce(
                F.col("_out.empr_addr_inp_ind_cd"), "empr_addr_inp_ind_cd"
            ),
        }
    ).drop("_out")
