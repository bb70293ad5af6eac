"""Steps of matching that read what is stored, and send on what is still asked for."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlink.config import Limits
from ledgerlink.functions.similarity import name_signature
from ledgerlink.operators import changeset
from ledgerlink.plans import enrich, fixtures
from ledgerlink.plans.queries import Case
from ledgerlink.sources import intake
from ledgerlink.staging import stage
from tests.test_run import CFG, LINES, full, narrow_masters

SF_DIR = "/root/testdata/sf0.001"
LARGE = replace(CFG, limits=Limits(broadcast_rows=0, heavy_keys=1))


def text_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def as_text(df):
    return sorted(map(str, df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]).collect()))


def staged_names(monkeypatch, module):
    names, own = [], module.stage
    monkeypatch.setattr(module, "stage", lambda df, name, *more: (names.append(name), own(df, name, *more))[1])
    return names


def test_masters_are_stored_once(spark):
    case = Case(spark, SF_DIR)
    views = {spec.name: f"m_{spec.name}" for spec in changeset.TABLES}
    for name, df in case.masters.tables().items():
        plan = text_of(df)
        assert "Join" not in plan and "Window" not in plan, name
        assert as_text(df) == as_text(case.fx[views[name]]), name


def test_large_tables_are_dealt_out(spark):
    fx = fixtures.frames(spark, SF_DIR)
    for name in ("orders", "customer", "part"):
        assert "Repartition" in text_of(fx[name]), name


@pytest.fixture(scope="module")
def matched(spark):
    df = spark.createDataFrame(list(enumerate(LINES)), "input_order long, value string")
    records = stage(intake.matchable(df, LARGE), "records")
    return records, enrich.match(records, full(narrow_masters(spark)), LARGE)


def test_deciding_outcomes_are_not_written_again(matched, monkeypatch):
    names = staged_names(monkeypatch, enrich)
    enrich.deciding_table(*matched, LARGE)
    assert names == ["deciding"]


def test_deciding_records_build_no_arrays(matched):
    plan = text_of(changeset.deciding_records(matched[1], LARGE))
    assert "stack(" in plan and "array" not in plan


def test_lookups_get_narrower(matched, spark, monkeypatch):
    seen, own = [], enrich.attach
    monkeypatch.setattr(enrich, "attach", lambda left, *more: (seen.append(set(left.columns)), own(left, *more))[1])
    enrich.match(matched[0], full(narrow_masters(spark)), LARGE)
    first, second, third = seen[-3:]
    assert first > second - {"opt_snum", "opt_origin", "opt_first"} and "opt_addr1" not in second
    assert "nm" in second and "nm" not in third and "addr1" in third


def test_signatures(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("ABCabc  é漢😀\t~`@\x00z9") for _ in range(rng.randrange(1, 90))) for _ in range(500)]

    def by_hand(nm):
        bits = [ord(ch) % 64 for ch in nm]
        sets = [sum(1 << b for b in set(bits) if bits.count(b) >= k) for k in (1, 2, 3)]
        return tuple(s - (1 << 64) if s >> 63 else s for s in sets)

    df = spark.createDataFrame([(n,) for n in names], "nm string").select("nm", name_signature("nm").alias("sig"))
    assert "lambda" not in text_of(df)
    assert all(tuple(r.sig) == by_hand(r.nm) for r in df.collect())
