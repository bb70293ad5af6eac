import random
from dataclasses import replace
from datetime import date, datetime

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlink.config import Limits, MatchConfig
from ledgerlink.functions.similarity import jaro_winkler
from ledgerlink.operators import names
from ledgerlink.staging import stage

CFG = MatchConfig(odate=date(2024, 6, 30), run_ts=datetime(2024, 6, 30))
RECORD = "input_order long, work_ein string, qw_employer_name string"
MASTER = "empr_id string, empr_nm string, nm_snum int"


def words(rng, n, longest):
    return "".join(rng.choice("ABCDEFG HIRST12") for _ in range(rng.randint(n, longest))).strip()


def test_scores_equal_the_sql_function():
    rng = random.Random(7)
    left = [words(rng, 1, 30) or "X" for _ in range(4000)] + ["A", "AB", "MARTHA"]
    right = [
        (a[: rng.randint(0, len(a))] + words(rng, 1, 9) + a[rng.randint(0, len(a)) :]) or "Y"
        for a in left[:-3]
    ] + ["B", "BA", "MARHTA"]
    left += [a * 6 for a in left[:300]]  # longer than one 64-bit word
    right += [b * 5 for b in right[:300]]
    got = jaro_winkler(pa.array(left), pa.array(right))
    t = pa.table({"i": range(len(left)), "a": left, "b": right})  # noqa: F841
    sql = "SELECT jaro_winkler_similarity(a, b) FROM t ORDER BY i"
    want = np.array([r[0] for r in duckdb.sql(sql).fetchall()])
    assert np.allclose(got, want, atol=1e-12)


def test_scores_other_alphabets_by_character():
    got = jaro_winkler(pa.array(["ÄÖÜß", "日本電気"]), pa.array(["ÄÖÜß", "日本電力"]))
    assert got[0] == pytest.approx(1.0)
    assert got[1] == pytest.approx(0.8333333 + 3 * 0.1 * (1 - 0.8333333), abs=1e-6)


def name_frames(spark, incoming, master):
    rec = spark.createDataFrame([(i, e, n) for i, (e, n) in enumerate(incoming)], RECORD)
    return rec, spark.createDataFrame(master, MASTER)


def resolved(spark, incoming, master, cfg=CFG):
    rec, mas = name_frames(spark, incoming, master)
    return {
        (r.empr_id, r.nm): (r.nm_snum, r.name_ind)
        for r in names.name_table(rec, mas, cfg).collect()
    }


def test_edge_cases(spark):
    master = [
        ("1", "Acme Corp", 3),
        ("1", " ACME CORP", 2),  # equal after normalising: lowest number
        ("1", "ACME", 4),
        ("2", "ABC", 1),
        ("3", "NORTHERN LIGHTS A", 5),
        ("3", "NORTHERN LIGHTS B", 6),
        ("4", None, 9),
    ]
    incoming = [
        ("1", "acme corp  "),
        ("1", "ACME HOLDINGS"),  # scores 0.86 with ACME, but the lengths differ too much
        ("2", "ABCD"),  # partner too short
        ("2", "abc"),
        ("3", "NORTHERN LIGHTS C"),  # ties: lowest number
        ("4", "UNSEEN"),
        ("5", "FIRST OF ITS ID"),
        ("5", "   "),
        ("5", None),
    ]
    assert resolved(spark, incoming, master) == {
        ("1", "ACME CORP"): (2, "F"),
        ("1", "ACME HOLDINGS"): (5, "N"),
        ("2", "ABCD"): (2, "N"),
        ("2", "ABC"): (1, "F"),
        ("3", "NORTHERN LIGHTS C"): (5, "F"),
        ("4", "UNSEEN"): (10, "N"),
        ("5", "FIRST OF ITS ID"): (1, "N"),
    }


def test_new_names_can_stay_without_number(spark):
    cfg = replace(CFG, allocate_new_names=False)
    assert resolved(spark, [("1", "NEW NAME"), ("1", "ACME")], [("1", "ACME", 1)], cfg) == {
        ("1", "ACME"): (1, "F")
    }


def test_ties_are_kept_by_best_fuzzy(spark):
    rec, mas = name_frames(
        spark, [("3", "NORTHERN LIGHTS C")], [("3", f"NORTHERN LIGHTS {x}", i) for i, x in enumerate("AB")]
    )
    exact = names.exact_names(names.name_inputs(rec, CFG), mas)
    best = names.best_fuzzy(names.fuzzy_names(exact, mas, CFG)).collect()
    assert sorted(r.nm_snum for r in best) == [0, 1]


@pytest.mark.parametrize("threshold", [0.781, 0.9, 0.6])
def test_no_pair_is_lost_to_bound_or_cells(spark, threshold):
    """One id with many names, cut into small cells, against scoring every pair."""
    rng = random.Random(3)
    stems = [words(rng, 5, 16) for _ in range(25)]
    vary = lambda: (rng.choice(stems) + rng.choice(["", " CO", "S", " INC"]))[rng.choice([0, 0, 1]) :]
    incoming = [("HOT", vary() + words(rng, 1, 4)) for _ in range(150)] + [("B", vary()) for _ in range(8)]
    master = [("HOT", vary() + words(rng, 1, 3), i) for i in range(120)] + [("B", vary(), i) for i in range(6)]
    cfg = replace(CFG, threshold=threshold, limits=Limits(cell_rows=5))
    rec, mas = name_frames(spark, incoming, master)
    left = stage(names.name_inputs(rec, cfg), "left")
    pairs = names.fuzzy_names(left, mas, cfg)
    got = sorted((r.empr_id, r.nm, r.master_nm) for r in pairs.collect())

    a = left.toPandas()  # noqa: F841
    b = names.master_names(mas).toPandas()  # noqa: F841
    want = duckdb.sql(
        f"""SELECT a.empr_id, a.nm, b.nm FROM a JOIN b ON a.empr_id = b.empr_id
        WHERE least(length(a.nm), length(b.nm)) >= 4
        AND least(length(a.nm), length(b.nm)) >= 0.72::DOUBLE * greatest(length(a.nm), length(b.nm))
        AND jaro_winkler_similarity(a.nm, b.nm) >= {threshold}::DOUBLE ORDER BY ALL"""
    ).fetchall()
    assert got == sorted(want)
    assert len(got) > 100


def test_every_large_block_is_cut(spark):
    """More large ids than any fixed number of them, none left whole."""
    rng = random.Random(8)
    ids = [f"{i:04d}" for i in range(1100)]
    incoming = [(i, f"NAME {words(rng, 3, 6)}{k}") for i in ids for k in range(3)]
    master = [(i, f"NAME {words(rng, 3, 6)}{k}", k) for i in ids for k in range(2)]
    cfg = replace(CFG, limits=Limits(cell_rows=1))
    rec, mas = name_frames(spark, incoming, master)
    left = stage(names._scorable(names.name_inputs(rec, cfg), cfg), "l")
    right = stage(names._scorable(names.master_names(mas), cfg), "r")
    cut = names._cells(left, right, cfg, 1).select("empr_id").distinct().count()
    assert cut > 1000
    usual = names.fuzzy_names(names.name_inputs(rec, CFG), mas, CFG)
    cells = names.fuzzy_names(names.name_inputs(rec, cfg), mas, cfg)
    pairs = lambda df: sorted((r.empr_id, r.nm, r.master_nm) for r in df.collect())
    assert pairs(usual) == pairs(cells)


def test_fuzzy_inputs_are_read_not_recomputed(spark):
    rec, mas = name_frames(spark, [("1", "ABCDEF")], [("1", "ABCDEG", 1)])
    text = plan_of(names.fuzzy_names(names.name_inputs(rec, CFG), mas, CFG))
    assert text.count("FileScan") <= 4 and "HashAggregate" not in text


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_joins_on_keys_and_scores_once(spark):
    rec, mas = name_frames(spark, [("1", "ABCDEF")], [("1", "ABCDEG", 1)])
    text = plan_of(names.fuzzy_names(names.name_inputs(rec, CFG), mas, CFG))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert text.count("ArrowEvalPython") == 1
    assert text.index("ArrowEvalPython") < text.index("Join")  # the scorer sits above the join


def test_first_per_key_is_limited_before_the_shuffle(spark):
    from ledgerlink.operators.keyed import keep_first

    df = spark.range(100).withColumn("k", F.col("id") % 3)
    assert "WindowGroupLimit" in plan_of(keep_first(df, ["k"], [F.col("id")]))
