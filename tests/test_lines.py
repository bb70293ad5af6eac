"""Lines and outcomes of many records: what is copied, sorted and written for them."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import Limits, MatchConfig
from ledgerlink.operators import assemble as asm
from ledgerlink.operators import keyed
from ledgerlink.plans import queries
from ledgerlink.sources import intake, layout
from ledgerlink.staging import stage

CFG = MatchConfig(odate=date(2024, 6, 30), run_ts=datetime(2024, 6, 30))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def nothing_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture()
def tables(spark, tmp_path):
    """The tables the fixtures read, with rows that repeat a key or have none."""
    put = lambda name, rows, cols: spark.createDataFrame(rows, cols).write.parquet(f"{tmp_path}/{name}.parquet")
    put("nation", [(i, f"NATION {i}") for i in range(3)], "n_nationkey int, n_name string")
    put("customer", [(i, f"Customer#{i}", i % 3, "AUTO") for i in range(40)] + [(39, "Again", 1, None)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("part", [(i, f"part {i}", "TIN", i) for i in range(40)], "p_partkey long, p_name string, p_type string, p_size int")
    put("orders", [(i, i % 41) for i in range(900)] + [(None, 3), (7, None)], "o_orderkey long, o_custkey long")
    return str(tmp_path)


def test_fields_are_cut_from_spans_not_from_the_line(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice("abc é€ 7") for _ in range(n)) for n in (0, 1, 90, 700, 1603, 1604, 1900)]
    lines += ["x" * 1604, "".join(rng.choice("abc 7") for _ in range(1604))]
    df = stage(spark.createDataFrame(list(enumerate(lines)), "input_order long, value string"), "lines")
    parsed = layout.parse(df)
    for row in parsed.collect():
        text = lines[row.input_order]
        assert [row[f.name] for f in layout.LAYOUT] == [text[f.start - 1 : f.start - 1 + f.width] for f in layout.LAYOUT]
    cuts = plan(parsed.drop("value")).count("substring(")
    whole = sum(plan(parsed.drop("value")).count(f"{text}, {f.start}, {f.width})") for f in layout.LAYOUT[60:70] for text in ("_bytes",))
    assert cuts and not whole
    for start, end, inside in layout.spans(layout.LAYOUT):
        assert end - start <= layout.SPAN_CHARS or len(inside) == 1


def test_a_line_is_built_of_its_values_and_the_blanks_between(spark):
    values = {"file_name": F.lit(None).cast("string"), "state_key_code_full": F.lit("abc"), "fnl_opt_frgn_zip": F.lit("z" * 20)}
    made = spark.range(1).select(layout.build(values).alias("value"))
    want = " " * 143 + "abc".ljust(9) + " " * (1565 - 153) + "z" * 15 + " " * (1604 - 1579)
    assert made.first().value == want
    assert len(layout.build(values)._jc.toString()) < 2500


def test_records_are_not_sorted_to_meet_their_outcome(spark, nothing_broadcast):
    wide = stage(spark.createDataFrame([(i, f"line {i}") for i in (3, 1, 2, 2)] + [(None, "none")], "input_order long, value string"), "wide")
    narrow = stage(spark.createDataFrame([(2, "F"), (1, "N"), (5, "X"), (None, "N")], "input_order long, ind string"), "narrow")
    rejoined = asm.payload_rejoin(narrow, wide, "input_order")
    assert sorted(map(str, map(tuple, rejoined.collect()))) == sorted(map(str, [(2, "F", "line 2"), (2, "F", "line 2"), (1, "N", "line 1"), (5, "X", None), (None, "N", None)]))
    joined = asm.join_outcome(wide, narrow, "input_order")
    assert sorted(str((r.input_order, r._out and r._out.ind)) for r in joined.collect()) == sorted(map(str, [(3, None), (1, "N"), (2, "F"), (2, "F"), (None, None)]))
    table = stage(narrow.filter("input_order is not null").withColumn("n", F.lit(1)), "table")
    found = keyed.attach(wide, table, ["input_order"], "n", ["value"], Limits(broadcast_rows=0, heavy_keys=1))
    assert sorted(str((r.value, r.ind)) for r in found.collect()) == sorted(map(str, [("line 1", "N"), ("line 2", "F"), ("line 2", "F"), ("line 3", None), ("none", None)]))
    for df in (rejoined, joined, found):
        assert "ShuffledHashJoin" in plan(df) and "SortMergeJoin" not in plan(df)


def test_stored_records_hold_what_a_run_keeps(spark, tables):
    case = queries.Case(spark, tables)
    assert set(case.records.columns) == {"input_order", "cls", CFG.special_id, *intake.MATCH_COLUMNS}
    assert case.records.count() == case.lazy_records.count() > 800


def test_written_lines_are_compressed_and_whole(spark, tables):
    case = queries.Case(spark, tables)
    got = queries.src_text(case)
    assert got.inputFiles() and all(f.endswith(".gz") for f in got.inputFiles())
    assert sorted(r.value or "" for r in got.collect()) == sorted(r.value or "" for r in case.lines.collect())
