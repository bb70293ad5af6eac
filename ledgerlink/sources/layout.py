"""The fixed-width record: where each field lies, how to cut it out and write it back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Field(NamedTuple):
    name: str
    start: int
    width: int


RECORD_WIDTH = 1604

# Fixed values of the record format: field, 1-based start, width.
_FIELDS = """
file_name 1 70
file_rec_num_id 71 10
file_addr1_id 81 10
file_addr2_id 91 10
connect_direct_node 121 3
file_node_rdate 124 10
file_node_ttime 134 10
state_key_code 144 2
state_key_code_full 144 9
transmission_type 153 2
dod_code 155 1
sort_key_date 156 8
sort_key_time 164 8
batch_number 172 6
ver_cntl 178 2
submitter_datestamp 180 8
receipt_datestamp 188 8
hdr_bypass_cd_on 196 1
is_batch_num_999999_test 197 1
record_status 198 1
cntl_fld_odc_or_filler 199 10
out_err_cnt 209 1
out_err_cd_1 210 4
out_err_cd_2 214 4
out_err_cd_3 218 4
out_err_cd_4 222 4
out_err_cd_5 226 4
ssn_val_code 230 1
ssn_vrfd_cd 231 1
ssn_vldtn_cd 232 1
namesearch_score_11 233 3
namesearch_score_12 236 3
final_ssn 239 9
final_first_nm 248 16
final_middle_nm 264 16
final_last_nm 280 30
final_empr_nm 310 45
ssn_sequence_num 355 10
submn_uid 365 10
empr_ein 375 9
empr_table_ind 384 1
empr_name_ind 385 1
empr_name_pntr_input 386 10
empr_addr_ind_input 396 1
empr_addr_pntr_input 397 10
empr_opt_addr_ind_input 407 1
empr_opt_addr_pntr_input 408 10
qw_frgn_empr_flg_cc 418 1
qw_frgn_empr_flg_cname 419 1
qw_frgn_empr_flg_czip 420 1
qw_frgn_opt_flg_cc 421 1
qw_frgn_opt_flg_cname 422 1
qw_frgn_opt_flg_czip 423 1
vald_ssn_chg_cd 424 1
vald_ein_cd 425 1
vald_wage_amt_cd 426 1
vald_rpt_prd_cd 427 1
wrk_ssn 439 9
wrk_first_nm 448 16
wrk_middle_nm 464 16
wrk_last_nm 480 30
wrk_empr_nm 510 45
wrk_rpt_prd_qtr 555 1
wrk_rpt_prd_year 556 4
wrk_wage_amt_x 560 11
qw_identifier 571 2
qw_employee_ssn 573 9
qw_empe_first_name 582 16
qw_empe_middle_name 598 16
qw_empe_last_name 614 30
qw_empe_wage_amt 644 11
qw_rpt_period_q 655 1
qw_rpt_period_cc 656 2
qw_rpt_period_yy 658 2
work_ein 660 9
qw_employer_st_ein 669 12
qw_employer_name 681 45
qw_empr_address1 726 40
qw_empr_address2 766 40
qw_empr_address3 806 40
qw_empr_city 846 25
qw_empr_state 871 2
qw_empr_zip_5 873 5
qw_empr_zip_4 878 4
qw_empr_forgn_cc 882 2
qw_empr_forgn_c_name 884 25
qw_empr_forgn_zip 909 15
qw_empr_opt_address1 924 40
qw_empr_opt_address2 964 40
qw_empr_opt_address3 1004 40
qw_empr_opt_city 1044 25
qw_empr_opt_state 1069 2
qw_empr_opt_zip_5 1071 5
qw_empr_opt_zip_4 1076 4
qw_er_opt_frn_cc 1080 2
qw_er_opt_frn_c_name 1082 25
qw_er_opt_frn_zip 1107 15
fnl_empr_address1 1172 40
fnl_empr_address2 1212 40
fnl_empr_address3 1252 40
fnl_empr_city 1292 25
fnl_empr_state 1317 2
fnl_empr_zip_5 1319 5
fnl_empr_zip_4 1324 4
fnl_empr_err_tab 1328 6
fnl_frgn_cc 1334 2
fnl_frgn_c_name 1336 25
fnl_frgn_zip 1361 15
fnl_opt_address1 1376 40
fnl_opt_address2 1416 40
fnl_opt_address3 1456 40
fnl_opt_city 1496 25
fnl_opt_state 1521 2
fnl_opt_zip_5 1523 5
fnl_opt_zip_4 1528 4
fnl_opt_err_tab 1532 6
fnl_opt_frgn_cc 1538 2
fnl_opt_frgn_c_name 1540 25
fnl_opt_frgn_zip 1565 15
"""

LAYOUT = [Field(n, int(s), int(w)) for n, s, w in (line.split() for line in _FIELDS.split("\n") if line)]

# The span that carries the results: three indicators and three numbers of ten digits.
PATCH_START = 384
POINTER_DIGITS = 10

# A line is cut into spans of at most so many characters before the fields are.
SPAN_CHARS = 128


def spans(layout: Sequence[Field], longest: int = SPAN_CHARS) -> list[tuple[int, int, list[Field]]]:
    """Start, end (past the last) and fields of neighbouring fields that lie within ``longest`` characters; a longer field is alone."""
    out: list[tuple[int, int, list[Field]]] = []
    for f in sorted(layout, key=lambda f: (f.start, -f.width)):
        end = f.start + f.width
        if out and max(end, out[-1][1]) - out[-1][0] <= longest:
            start, last, inside = out[-1]
            out[-1] = (start, max(last, end), [*inside, f])
        else:
            out.append((f.start, end, [f]))
    return out


def parse(df: DataFrame, layout: Sequence[Field] = LAYOUT, src: str = "value") -> DataFrame:
    """All fields in two projections; a field past the end of a line is blank.

    Finding a character position means walking the line from its start, once per field.
    A line of one-byte characters is cut by byte position instead, with the same result. Either way the text that is cut is
    copied each time, so a line is cut into spans first and the fields out of those.
    """
    def cut(text: str, start: int, width: int) -> Column:
        by_byte = F.substring(F.col(text).cast("binary"), start, width).cast("string")
        return F.when(F.col("_plain"), by_byte).otherwise(F.substring(text, start, width))

    parts = spans(layout)
    plain = F.octet_length(src) == F.char_length(src)
    wide = df.withColumn("_plain", plain).select(
        *df.columns, "_plain", *[cut(src, start, end - start).alias(f"_span{n}") for n, (start, end, _) in enumerate(parts)]
    )
    found = {f: cut(f"_span{n}", f.start - start + 1, f.width) for n, (start, _, inside) in enumerate(parts) for f in inside}
    return wide.select(*df.columns, *[found[f].alias(f.name) for f in layout])


def build(values: Mapping[str, Column], layout: Sequence[Field] = LAYOUT) -> Column:
    """A line holding ``values``, blank elsewhere. Fields inside another are left out."""
    parts, blanks, at = [], "", 1
    for f in sorted(layout, key=lambda f: (f.start, -f.width)):
        if f.start < at:
            continue
        blanks += " " * (f.start - at)
        at = f.start + f.width
        if f.name not in values:
            blanks += " " * f.width
            continue
        parts += [F.lit(blanks)] if blanks else []
        parts.append(F.rpad(F.coalesce(values[f.name], F.lit("")), f.width, " "))
        blanks = ""
    return F.concat(*parts, F.lit(blanks + " " * (RECORD_WIDTH + 1 - at)))


def result_span() -> list[Column]:
    """Indicators and zero-padded pointers in record order."""

    def flag(c: str) -> Column:
        return F.rpad(F.coalesce(c, F.lit(" ")), 1, " ")

    def pointer(c: str) -> Column:
        return F.lpad(F.coalesce(F.col(c), F.lit(0)).cast("string"), POINTER_DIGITS, "0")

    return [
        flag("empr_table_ind"),
        flag("empr_name_ind"),
        pointer("empr_name_pntr"),
        flag("empr_addr_ind"),
        pointer("empr_addr_pntr"),
        flag("empr_opt_addr_ind"),
        pointer("empr_opt_addr_pntr"),
    ]


def patch(
    df: DataFrame, parts: Sequence[Column], start: int = PATCH_START, src: str = "value"
) -> DataFrame:
    """Overwrite the line from ``start`` on with ``parts``; its length stays the same.

    A line shorter than the span is first filled with blanks up to the full width.
    """
    line = F.when(F.length(src) < RECORD_WIDTH, F.rpad(src, RECORD_WIDTH, " ")).otherwise(F.col(src))
    return df.withColumn(src, F.overlay(line, F.concat(*parts), F.lit(start)))
