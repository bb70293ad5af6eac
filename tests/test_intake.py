from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import MatchConfig
from ledgerlink.operators import classify as cl
from ledgerlink.sources import intake, layout, publish, tables
from tests.test_skew import rows_of

CFG = MatchConfig(odate=date(2024, 6, 30), run_ts=datetime(2024, 6, 30))


def line(**fields):
    """A full line with the given fields, without Spark."""
    chars = [" "] * layout.RECORD_WIDTH
    for f in layout.LAYOUT:
        if f.name in fields:
            chars[f.start - 1 : f.start - 1 + f.width] = fields[f.name].ljust(f.width)[: f.width]
    return "".join(chars)


def parsed(spark, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "input_order long, value string")
    return layout.parse(df)


def test_layout_is_the_record():
    assert len(layout.LAYOUT) == 119
    assert max(f.start + f.width - 1 for f in layout.LAYOUT) == 1579
    spans = sorted((f.start, f.start + f.width) for f in layout.LAYOUT if f.name != "state_key_code")
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_build_and_parse_round_trip(spark):
    values = {f.name: f"{i:03d}"[: f.width] for i, f in enumerate(layout.LAYOUT)}
    values["state_key_code"] = values["state_key_code_full"][:2]
    df = spark.range(1).select(layout.build({k: F.lit(v) for k, v in values.items()}).alias("value"))
    row = layout.parse(df).first()
    assert len(row.value) == layout.RECORD_WIDTH
    assert {f.name: row[f.name].rstrip() for f in layout.LAYOUT} == values


def test_short_and_non_ascii_lines(spark):
    wide = line(final_empr_nm="CAFÉ ÉTOILE", empr_ein="123456789", fnl_opt_frgn_zip="Z9")
    short, cut = parsed(spark, "FILE", wide).orderBy("input_order").collect()
    assert short.file_name == "FILE" and short.empr_ein == "" and short.fnl_opt_frgn_zip == ""
    assert cut.final_empr_nm.strip() == "CAFÉ ÉTOILE"
    assert cut.empr_ein == "123456789" and cut.fnl_opt_frgn_zip.strip() == "Z9"


def test_rejects(spark):
    df = spark.createDataFrame([("",), ("E",), ("OK",)], "value string")
    valid, bad = intake.split_valid(df)
    assert [r.value for r in valid.collect()] == ["OK"]
    reason = "EOF marker or empty record"
    assert rows_of(bad) == [("", reason, 0), ("E", reason, 1)]


@pytest.mark.parametrize(
    ("ein", "code"), [("123456789", "Y"), ("12345678", "I"), ("12345678A", "I"), ("", "I")]
)
def test_id_rules(spark, ein, code):
    text = line(empr_ein=ein, vald_ein_cd="Y", final_empr_nm="X", wrk_empr_nm="Y", ssn_val_code="I", wrk_ssn="111111111")
    row = intake.validate(parsed(spark, text), CFG).first()
    assert row.vald_ein_cd == code
    assert (row.final_empr_nm == "", row.wrk_empr_nm == "") == (code == "I", code == "I")
    assert (row.wrk_ssn, row.final_ssn) == ("000000000", "000000000")


@pytest.mark.parametrize("flag", ["Y", "N", " "])
def test_foreign_fields_need_their_flag(spark, flag):
    row = intake.validate(parsed(spark, line(qw_frgn_opt_flg_cc=flag, qw_er_opt_frn_cc="MX")), CFG).first()
    want = "MX" if flag == "Y" else None
    assert row.qw_er_opt_frn_cc == want and row.opt_empr_forgn_cc == want
    assert row.empr_forgn_cc is None


CLASSES = [
    (dict(empr_addr_ind_input="X", qw_employer_name="", empr_ein="123456789"), "unknown"),
    (dict(empr_addr_ind_input="X", qw_employer_name="A", empr_ein="123456789"), "regular"),
    (dict(batch_number="999999", empr_ein="A12345678"), "unknown"),
    (dict(is_batch_num_999999_test="Y", empr_ein="123456789"), "unknown"),
    (dict(empr_ein="A12345678"), "pseudo"),
    (dict(empr_ein="120000000"), "pseudo"),
    (dict(empr_ein=""), "pseudo"),
    (dict(empr_ein="555555555"), "pseudo"),  # listed
    (dict(empr_ein="123456789", work_ein="A12345678"), "regular"),  # only empr_ein decides
]


def test_classes(spark):
    df = intake.validate(parsed(spark, *[line(**f) for f, _ in CLASSES]), CFG)
    got = cl.classify(df, replace(CFG, exception_ids=("555555555",))).orderBy("input_order").collect()
    assert [r.cls for r in got] == [c for _, c in CLASSES]


def test_missing_values_never_lose_a_record(spark):
    df = intake.validate(parsed(spark, line()), CFG).withColumns(
        {c: F.lit(None).cast("string") for c in ("batch_number", "is_batch_999999", "empr_ein")}
    )
    assert cl.classify(df, CFG).first().cls == "regular"


def test_patch_keeps_the_rest(spark):
    text = line(empr_ein="123456789", qw_frgn_empr_flg_cc="Y", fnl_opt_frgn_zip="END")
    df = spark.createDataFrame([(text,), ("SHORT",)], "value string").withColumns(
        {
            "empr_table_ind": F.lit("F"),
            "empr_name_ind": F.lit("N"),
            "empr_addr_ind": F.lit("X"),
            "empr_opt_addr_ind": F.lit(None).cast("string"),
            "empr_name_pntr": F.lit(12),
            "empr_addr_pntr": F.lit(None).cast("int"),
            "empr_opt_addr_pntr": F.lit(7),
        }
    )
    span = "FN0000000012X0000000000 0000000007"
    full, short = (r.value for r in layout.patch(df, layout.result_span()).collect())
    assert full == text[:383] + span + text[417:]
    assert len(short) == layout.RECORD_WIDTH and short[383:417] == span


@pytest.mark.parametrize(
    ("name", "tail"),
    [
        ("IN.R240102.T030405.txt", ".R240102.T030405"),
        ("IN.R240102.txt", ".R240102.T101112"),
        ("IN.R240102.T030405", ".R240102.T101112"),  # the last part counts as extension
        ("plain", ".R240630.T101112"),
    ],
)
def test_run_label(spark, name, tail):

    c = publish.run_label(F.lit(name), datetime(2024, 6, 30, 10, 11, 12), "OUT")
    assert spark.range(1).select(c.alias("x")).first().x == "OUT.SEQIDS" + tail


def test_slices_cover_a_table_once(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    parts = [df.filter(p) for p in tables.slice_predicates("k", 7)]
    assert sorted(r.k for p in parts for r in p.collect()) == sorted(str(i) for i in range(500))
    server = tables.slice_predicates("k", 2, "MOD(ABS(HASHTEXT({key})), {n}) = {i}")
    assert server == ["MOD(ABS(HASHTEXT(k)), 2) = 0", "MOD(ABS(HASHTEXT(k)), 2) = 1"]


def test_table_texts_and_options():
    text = tables.key_filtered("names", "empr_id", "run_ids", ["empr_id", "empr_nm"])
    assert text == (
        "(SELECT t.empr_id, t.empr_nm FROM names t "
        "WHERE EXISTS (SELECT 1 FROM run_ids k WHERE k.empr_id = t.empr_id)) AS src"
    )
    assert tables.write_options("overwrite", 500)["truncate"] == "true"
    assert "truncate" not in tables.write_options("append", 500)
