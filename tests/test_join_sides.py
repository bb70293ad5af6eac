"""Tables that grow are never sent whole to the driver because Spark takes their files for their rows."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import Limits, MatchConfig
from ledgerlink.operators import addresses, backfill, changeset, keyed, merge, names, numbering, special
from ledgerlink.plans import enrich, fixtures
from ledgerlink.sources import intake
from ledgerlink.staging import stage
from tests.test_run import LINES, full, narrow_masters

CFG = MatchConfig(odate=date(2024, 6, 30), run_ts=datetime(2024, 6, 30))
LARGE = replace(CFG, limits=Limits(broadcast_rows=0, heavy_keys=1))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sent(df):
    """What the plan sends to every task, by the lines below each exchange."""
    lines = plan(df).split("\n")
    return ["\n".join(lines[i : i + 8]) for i, line in enumerate(lines) if "BroadcastExchange" in line]


@pytest.fixture(scope="module")
def put(spark):
    def stored(schema, *rows):
        return stage(spark.createDataFrame(list(rows), schema), "given")

    return stored


def places(snum):
    return "empr_id string, addr1 string, city string, state string, zip5 string" + snum


def joins(put):
    inputs = put("empr_id string, nm string, n long, first_id long", ("1", "ABCDEF", 1, 1), ("1", "ABCDEG", 1, 2))
    known = put("empr_id string, empr_nm string, nm_snum int", ("1", "abcdef", 1), ("2", "other", 1))
    address = put(places(", n long, first_id long"), ("1", "A", "B", "C", "1", 1, 1), ("1", "D", "B", "C", "1", 1, 2))
    stored = put(places(", addr_snum int"), ("1", "A", "B", "C", "1", 1))
    numbered = put(places(", n long, first_id long, addr_snum int, origin string"), ("1", "D", "B", "C", "1", 1, 2, 2, "new"))
    matched = put(places(", n long, first_id long, addr_snum int"), ("1", "D", "B", "C", "1", 1, 3, None))
    ids, last = put("empr_id string", ("1",)), put("empr_id string, last int", ("1", 4))
    links = put("empr_id string, nm_snum int, addr_snum int", ("1", 1, 1))
    master = put(
        "empr_id string, nm_snum int, empr_nm string, app_odate date, insrt_ts timestamp, lu_ts timestamp, fcr_mtch_dt date",
        ("1", 1, "abcdef", date(2024, 3, 31), None, None, None),
    )
    source = put(
        "input_order long, empr_id string, nm_snum int, empr_nm string, app_odate date, insrt_ts timestamp, lu_ts timestamp, fcr_mtch_dt date",
        (1, "1", 1, "abcdef", date(2024, 6, 30), None, None, None),
        (2, "1", 2, "new", date(2024, 6, 30), None, None, None),
    )
    changes = stage(changeset.change_set(source, master, changeset.NAME, CFG), "changes")
    entities = put(", ".join(f"{c} string" for c in special.ON) + ", n long, first_id long", ("A1", "N", "A", "", "", "C", "S", "1", "2", 1, 1))
    held = put("empr_snum int, empr_idfr string, " + ", ".join(f"{c} string" for c in special.CONTENT.values()), (1, "A1", "n", "a", "", "", "c", "s", "1", "2"))
    reuse = replace(CFG, reuse_special=True)
    return {
        "exact_names": (names.exact_names(inputs, known), 2),
        "fuzzy_candidates": (names.fuzzy_candidates(inputs, known, CFG), 2),
        "match_addresses": (addresses.match_addresses(address, stored), 2),
        "new_optional": (addresses.new_optional(matched, numbered), 0),
        "share_primary": (addresses.share_primary(matched, numbered), 1),
        "table_indicators": (addresses.table_indicators(ids, known, ids), 1),
        "linked_names": (backfill.linked_names(links, known), 1),
        "change_set": (changeset.change_set(source, master, changeset.NAME, CFG), 2),
        "merge_update": (merge.merge_update(master, changes, changeset.NAME, CFG), 1),
        "merge_insert": (merge.merge_insert(master, changes, changeset.NAME), 2),
        "merge": (merge.merge(master, changes, changeset.NAME, CFG), 2),
        "match_special": (special.match_special(entities, held, reuse), 1),
        "restrict": (keyed.restrict(known, keyed.lookup_side(ids, LARGE.limits), ["empr_id"]), 1),
    }


def test_stored_sides_are_shuffled(put):
    for name, (df, rows) in joins(put).items():
        given = [x for x in sent(df) if "cells" not in x]  # cells: one row per 4,096 names at most
        if name == "fuzzy_candidates":
            assert "SortMergeJoin" in plan(df), name
        else:
            assert not given, name
        assert df.count() == rows, name


def test_kept_numbers_are_shuffled(put):
    """Numbers in use, which lie in one small row per id, and the rows that get the next ones."""
    new = put("empr_id string, nm string", ("1", "a"), ("1", "b"), ("3", "c"))
    last = put("empr_id string, last int", ("1", 4), ("2", 1))
    got = numbering.allocate(new, [last], ["empr_id"], ["nm"], "nm_snum", replace(CFG.limits, window_rows=10))
    assert "given" not in " ".join(x for x in sent(got) if "last#" in x.split("FileScan")[-1])
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a", 5), ("1", "b", 6), ("3", "c", 1)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    keep = lambda name, rows, cols: spark.createDataFrame(rows, cols).write.parquet(f"{at}/{name}.parquet")
    keep("nation", [(i, f"NATION {i}") for i in range(3)], "n_nationkey int, n_name string")
    keep("customer", [(i, f"Customer#{i}", i % 3, "AUTO") for i in range(40)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    keep("part", [(i, f"part {i}", "TIN", i) for i in range(40)], "p_partkey long, p_name string, p_type string, p_size int")
    keep("orders", [(i, i % 41) for i in range(300)], "o_orderkey long, o_custkey long")
    return str(at)


def test_only_nations_are_sent_for_the_views(spark, tables):
    fx = fixtures.frames(spark, tables)
    for name in ("sub", "fx_addr", "fx_special", "m_address", "m_special"):
        found = sent(fx[name])
        assert found and all("nation.parquet" in x for x in found), name
    assert not sent(fixtures.stored_masters(fx)["m_link"])
    assert fx["sub"].count() == 293


def test_a_run_sends_only_what_was_counted(spark, monkeypatch):
    """With nothing counted as small, only the heaviest keys, offsets and cells go to every task."""
    df = spark.createDataFrame(list(enumerate(LINES)), "input_order long, value string")
    records = stage(intake.matchable(df, LARGE), "records")
    plans = {}
    for module in (enrich, names, addresses, special):
        own = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, *more, own=own: (plans.__setitem__(name, sent(df)), own(df, name, *more))[1])
    enrich.match(records, full(narrow_masters(spark)), LARGE)
    for name in ("ids", "special_ids", "master_names", "master_addresses", "names_exact", "addr_matched", "opt_shared", "special_matched"):
        assert not plans[name], name
    assert plans["outcome"] and all("TakeOrderedAndProject" in x for x in plans["outcome"])
