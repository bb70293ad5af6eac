"""Change-sets from the deciding records alone: the same as from all records, without sorting those."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import Limits
from ledgerlink.operators import changeset
from ledgerlink.plans import enrich
from ledgerlink.sources import intake
from ledgerlink.staging import stage
from tests.test_run import CFG, E1, E2, E3, HOME, LINES, OPT, full, narrow_masters, other, rec
from tests.test_skew import rows_of

LARGE = replace(CFG, limits=Limits(broadcast_rows=0, heavy_keys=1))


@pytest.fixture(scope="module")
def masters(spark):
    return full(narrow_masters(spark))


def many():
    """Records that repeat names and addresses, half of them of one id; optional addresses also come as primary ones."""
    rng = random.Random(11)
    for _ in range(600):
        ein = rng.choice([E1] * 5 + [E2, E3, "A11111111", "A22222222", "12345"])
        street = rng.choice(["1 Main St", "1 MAIN ST ", "9 NEW RD", "2 SIDE ST", "PO BOX 5", ""])
        opt = rng.choice([None, OPT, {**OPT, "qw_empr_opt_address1": rng.choice(["PO BOX 5", "9 new rd", " "])}])
        more = {"empr_addr_ind_input": "X"} if rng.random() < 0.05 else {}
        work = E3 if ein == "A22222222" else ein
        yield rec(ein, rng.choice(["ACME CORP", "acme corps", "ZENITH WORKS", "", "OTHER INC"]), other(street), opt, work_ein=work, **more)


def staged(spark, lines, masters, cfg=CFG):
    df = spark.createDataFrame(list(enumerate(lines)), "input_order long, value string")
    records = stage(intake.matchable(df, cfg), "records")
    return records, enrich.match(records, masters, cfg)


@pytest.mark.parametrize("lines", [LINES, list(many())], ids=["few", "many"])
@pytest.mark.parametrize("cfg", [CFG, LARGE, replace(CFG, reuse_special=True)], ids=["small", "large", "reuse"])
def test_same_change_sets_as_from_all_records(spark, masters, lines, cfg):
    records, outcome = staged(spark, lines, masters, cfg)
    deciding = stage(enrich.deciding_table(records, outcome, cfg), "deciding_main")
    everything = stage(enrich.main_table(records, outcome, cfg), "all_main")
    assert deciding.count() < everything.count()
    got, want = (enrich.change_sets(main, masters, cfg) for main in (deciding, everything))
    for name in want:
        text = [F.col(c).cast("string") for c in want[name].columns]
        assert sorted(map(str, got[name].select(*text).collect())) == sorted(map(str, want[name].select(*text).collect())), name
        assert got[name].columns == want[name].columns


def test_deciding_records_by_hand(spark):
    rows = [
        # record, class, id, name, address, optional, indicator
        (1, "regular", "a", 1, 2, 0, "F"),
        (0, "regular", "a", 1, 3, 0, "F"),  # the first of name 1, though not of address 2
        (2, "regular", "a", 1, 2, 3, "F"),  # the first of optional 3
        (3, "regular", "a", 1, 2, 3, "F"),
        (4, "regular", "o", 1, 1, 0, "O"),  # its id counts as special: no table
        (5, "unknown", None, 0, 0, 0, " "),
        (6, "pseudo", "a", 0, 2, 0, "O"),  # a special number is not an address number
        (7, "pseudo", "a", 0, 2, 0, "O"),
        (8, "pseudo", "a", 0, 0, 0, "O"),
        (9, "regular", None, 1, 0, 0, "N"),
        (10, "regular", None, 1, 0, 0, "N"),
    ]
    columns = "input_order long, cls string, master_id string, empr_name_pntr int, empr_addr_pntr int, empr_opt_addr_pntr int, empr_table_ind string"
    df = spark.createDataFrame(rows, columns)
    assert rows_of(changeset.deciding_records(df, CFG)) == [(0,), (1,), (2,), (6,), (9,)]
    assert rows_of(changeset.deciding_records(df.limit(0), CFG)) == []


def test_records_are_not_sorted(spark, masters):
    records, outcome = staged(spark, LINES, masters, LARGE)
    for df in (changeset.deciding_records(outcome, LARGE), enrich.deciding_table(records, outcome, LARGE)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Window" not in plan
