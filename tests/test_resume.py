"""Taking up the finished stages of a batch that failed."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlink.operators import names
from ledgerlink.plans import enrich
from ledgerlink.sources import intake, publish
from ledgerlink.staging import OtherJob, create_once, stage, stage_noted, stages_of
from tests.test_publish import NEW, SMALL, copy_of, first  # noqa: F401
from tests.test_run import E1, E2, batch, masters, other, rec, stages_left  # noqa: F401
from tests.test_skew import rows_of

FEED = [rec(name="ACME CORPS"), rec(name="ZENITH WORKS"), rec(ein=NEW[3], name=f"COMPANI {NEW[3]}"), rec(ein=E2, name="THIRD"), "E"]


class Stopped(BaseException):
    """As a driver that is told to end."""


def stop(*args, **kwargs):
    raise Stopped


def never_scored(*args):
    """A score that ends the task that asks for it."""
    return F.raise_error(F.lit("scored again")).cast("double")


def everything(result):
    tables = {**result.tables, "output": result.output, "summary": result.summary, "rejects": result.rejects}
    return {name: sorted(map(repr, df.collect())) for name, df in tables.items()}


def test_scorer_does_not_run_again(spark, first, tmp_path, monkeypatch, stages_left):  # noqa: F811
    root, plain = copy_of(first[0], tmp_path / "o"), copy_of(first[0], tmp_path / "p")
    feed, known = batch(tmp_path / "in", FEED), enrich.read_masters(spark, root)
    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(enrich, "change_sets", stop)
        enrich.run(spark, feed, known, root, SMALL, job="day")
    assert stages_left() == {"job-day"} and publish.last(spark, root) == known.version
    with monkeypatch.context() as m:
        m.setattr(names, "jaro_winkler_score", never_scored)
        m.setattr(intake, "matchable", lambda lines, cfg, plan=intake.matchable: plan(lines, cfg).filter(F.raise_error(F.lit("read again")).isNull()))
        resumed = enrich.run(spark, feed, enrich.read_masters(spark, root), root, SMALL, job="day")
    assert not stages_left()
    want = everything(enrich.run(spark, feed, enrich.read_masters(spark, plain), plain, SMALL))
    assert everything(resumed) == want and (resumed.lines, resumed.rejected) == (5, 1)

    # The same name begins anew once the job is done; here the scorer is asked again.
    with monkeypatch.context() as m, pytest.raises(Exception, match="scored again"):
        m.setattr(names, "jaro_winkler_score", never_scored)
        enrich.run(spark, batch(tmp_path / "in2", [rec(name="ACMES CORPX")]), enrich.read_masters(spark, root), root, SMALL, job="day")


def test_masters_that_changed_are_matched_again(spark, first, tmp_path, monkeypatch, stages_left):  # noqa: F811
    root, plain = copy_of(first[0], tmp_path / "o"), copy_of(first[0], tmp_path / "p")
    feed, between = batch(tmp_path / "in", FEED), batch(tmp_path / "b", [rec(ein=E2, name="FIRST RUN LTD", home=other("8 OLD RD"))])
    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(enrich.publish, "write_snapshots", stop)
        enrich.run(spark, feed, enrich.read_masters(spark, root), root, SMALL, job="night")
    for place in (root, plain):
        enrich.run(spark, between, enrich.read_masters(spark, place), place, SMALL)
    resumed = enrich.run(spark, feed, enrich.read_masters(spark, root), root, SMALL, job="night")
    assert everything(resumed) == everything(enrich.run(spark, feed, enrich.read_masters(spark, plain), plain, SMALL))
    of_id = publish.read_current(spark, root, "name").filter(F.col("empr_id") == E2)
    assert {r.nm_snum: r.empr_nm.strip() for r in of_id.collect()} == {1: "FIRST RUN LTD", 2: "THIRD"}
    assert not stages_left()


def test_another_batch_of_that_name_is_refused(spark, masters, tmp_path, monkeypatch):  # noqa: F811
    feed, root = batch(tmp_path / "in", FEED[:1]), str(tmp_path / "o")
    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(enrich, "match", stop)
        enrich.run(spark, feed, masters, root, SMALL, job="mixed")
    with pytest.raises(OtherJob):
        enrich.run(spark, batch(tmp_path / "in2", FEED), masters, root, SMALL, job="mixed")
    # Masters that are plain frames have no number: the lines are taken up, the rest is done anew.
    done = enrich.run(spark, feed, masters, root, SMALL, job="mixed")
    assert done.output.count() == 1


def test_stages_by_part_and_turn(spark):
    made, of = [], {"x": 1}

    def twice(df, ends):
        a, note = stage_noted(df, "a", lambda: {"rows": made.append(1) or len(made)})
        b = stage(df.select((F.col("id") * 10).alias("id")), "a")
        if ends:
            raise Stopped
        return rows_of(a), rows_of(b), note

    with pytest.raises(Stopped), stages_of(spark, "job-turns", of):
        twice(spark.range(3), True)
    with stages_of(spark, "job-turns", of):
        assert twice(spark.range(3), False) == ([(0,), (1,), (2,)], [(0,), (10,), (20,)], {"rows": 1})
    assert made == [1]


def test_first_to_finish_a_stage_decides(spark, tmp_path):
    """A run beside this one writes its entry while this one writes its rows."""
    spark.range(5).write.parquet(str(tmp_path / "theirs"))

    def meanwhile():
        from ledgerlink.staging import _JOURNAL

        entry = f"{_JOURNAL.get().folder}/start-a-1.json"
        assert create_once(spark, entry, f'{{"path": "{tmp_path}/theirs", "note": {{"by": "them"}}}}')
        return {"by": "us"}

    with stages_of(spark, "job-race", {}):
        df, note = stage_noted(spark.range(2), "a", meanwhile)
        assert note == {"by": "them"} and df.count() == 5
    assert os.path.exists(tmp_path / "theirs")
