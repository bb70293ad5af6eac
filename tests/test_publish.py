"""Publishing beside other runs, masters in buckets, and clearing up."""

import os
import time
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlink.plans import enrich
from ledgerlink.sources import intake, publish
from ledgerlink.staging import create_once, remove, stage, stage_path, stage_root, stages_of, sweep_stages
from tests.test_run import CFG, E2, batch, masters, other, rec  # noqa: F401
from tests.test_skew import rows_of

SMALL = replace(CFG, master_buckets=16)
NEW = [f"{i:09d}" for i in range(712345600, 712345660)]


@pytest.fixture(scope="module")
def first(spark, masters, tmp_path_factory):  # noqa: F811
    """A root with one published run of many ids."""
    root = tmp_path_factory.mktemp("published")
    lines = [rec(ein=e, name=f"COMPANY {e}", home=other(f"{e[-2:]} STREET")) for e in NEW] + [rec()]
    done = enrich.run(spark, batch(root / "in", lines), masters, str(root / "out"), SMALL)
    return str(root / "out"), done


def copy_of(root, path):
    """The same published state under another root: entries refer to the first one's snapshots."""
    import shutil

    shutil.copytree(f"{root}/published", f"{path}/published")
    return str(path)


@pytest.mark.parametrize("link", [True, False])
def test_a_name_is_taken_once(spark, tmp_path, link):
    path = f"{tmp_path}/entry.json"
    assert create_once(spark, path, "one", link) and not create_once(spark, path, "two", link)
    assert open(path).read() == "one" and [x for x in os.listdir(tmp_path) if not x.startswith(".")] == ["entry.json"]


def test_second_of_two_runs_does_not_hide_the_first(spark, first, tmp_path):
    """Both read one version and give the same id new names; the later publisher is told, or merges again."""
    root = copy_of(first[0], tmp_path / "o")
    one, two = (enrich.read_masters(spark, root) for _ in range(2))
    a = enrich.run(spark, batch(tmp_path / "a", [rec(ein=NEW[0], name="FIRST RUN LTD")]), one, root, SMALL)
    feed = batch(tmp_path / "b", [rec(ein=NEW[0], name="ZWEITE QUELLE"), rec(ein=E2, name="THIRD")])
    before = sorted(os.listdir(f"{root}/published"))
    with pytest.raises(publish.Conflict):
        enrich.run(spark, feed, two, root, SMALL)
    assert sorted(os.listdir(f"{root}/published")) == before and publish.current(spark, root).attempt == a.attempt
    b = enrich.run(spark, feed, two, root, SMALL, retries=1)
    assert publish.current(spark, root).attempt == b.attempt and publish.current(spark, root).seq == 3
    names = publish.read_current(spark, root, "name").filter(F.col("empr_id") == NEW[0])
    assert {r.nm_snum: r.empr_nm.strip() for r in names.collect()} == {1: f"COMPANY {NEW[0]}", 2: "FIRST RUN LTD", 3: "ZWEITE QUELLE"}


def test_run_that_publishes_in_the_middle_of_another(spark, first, tmp_path, monkeypatch):
    """The entry is taken between the last look at the manifest and the write."""
    root = copy_of(first[0], tmp_path / "o")
    taken = publish.last(spark, root) + 1
    make = publish.create_once

    def beaten(spark, path, text):
        assert make(spark, path, '{"seq": 2, "label": "x", "attempt": "other", "paths": {}}')
        return make(spark, path, text)

    monkeypatch.setattr(publish, "create_once", beaten)
    with pytest.raises(publish.Conflict):
        enrich.run(spark, batch(tmp_path / "a", [rec()]), enrich.read_masters(spark, root), root, SMALL)
    assert publish.last(spark, root) == taken and publish.current(spark, root).attempt == "other"


def test_batch_writes_and_reads_its_own_buckets_only(spark, first, masters, tmp_path):  # noqa: F811
    root = copy_of(first[0], tmp_path / "o")
    old, known = publish.current(spark, root), enrich.read_masters(spark, root)
    lines = [rec(ein=NEW[3], name="NEW NAME GMBH", home=other("1 NEW WAY")), rec(ein=NEW[4], name=f"COMPANY {NEW[4]}")]
    feed = batch(tmp_path / "a", lines)
    done = enrich.run(spark, feed, known, root, SMALL)
    new = publish.current(spark, root)
    own = {r.b for r in spark.createDataFrame([(NEW[3],), (NEW[4],)], "i string").select(publish.bucket_of(F.col("i"), 16).alias("b")).collect()}
    for name in enrich.FIELD_OF:
        before, after = publish.bucket_paths(old, name), publish.bucket_paths(new, name)
        changed = {n for n in after if after[n] != before.get(n)}
        assert changed <= own and before.keys() <= after.keys(), name
        assert name not in ("name", "address", "link") or changed
    # The same result as with whole masters, rewritten as a whole.
    flat = enrich.Masters(**{f: stage(known.tables()[n], n) for n, f in enrich.FIELD_OF.items()})
    whole = enrich.run(spark, feed, flat, str(tmp_path / "w"), SMALL)
    for name, df in done.tables.items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, whole.tables[name].collect()))
    assert rows_of(done.output) == rows_of(whole.output)
    # What matching reads of the masters.
    records = spark.createDataFrame([(NEW[3], NEW[3])], "work_ein string, empr_ein string")
    limited = known.limited(records, SMALL)
    for name, df in limited.tables().items():
        files = {f.split("/id_bucket=")[1].split("/")[0] for f in df.inputFiles()}
        assert files <= {str(n) for n in own}, name
    assert 0 < len(limited.names.inputFiles()) < len(known.names.inputFiles())


def test_padded_ids_share_a_bucket(spark):
    df = spark.createDataFrame([("12345",), ("12345    ",), (None,)], "i string")
    got = [r.b for r in df.select(publish.bucket_of(F.col("i"), 1000).alias("b")).collect()]
    assert got[0] == got[1] and got[2] is not None


def test_tables_without_rows_are_published_too(spark, first):
    root, done = first
    empty = spark.createDataFrame([], done.tables["name"].schema)
    assert publish.write_buckets(empty, stage_path(spark, "none"), "name", "empr_id", 4) == {}
    assert publish.read_paths(spark, empty.schema, []).count() == 0


def aged(path, days):
    """Everything below a path looks so many days old."""
    then = time.time() - days * 86_400
    for top, folders, files in os.walk(path, topdown=False):
        for x in (*folders, *files):
            os.utime(f"{top}/{x}", (then, then))
    os.utime(path, (then, then))


def test_sweep_keeps_what_is_needed_or_in_progress(spark, masters, tmp_path):  # noqa: F811
    root, day = str(tmp_path / "o"), timedelta(days=1)
    runs = [enrich.run(spark, batch(tmp_path / "a", [rec(ein=e, name=f"CO {e}") for e in NEW[:20]]), masters, root, SMALL)]
    for i, e in enumerate((NEW[0], NEW[1])):
        feed = batch(tmp_path / f"b{i}", [rec(ein=e, name="ANOTHER NAME", home=other("7 HILL"))])
        runs.append(enrich.run(spark, feed, enrich.read_masters(spark, root), root, SMALL))
    top = f"{root}/snapshots/{runs[0].label}"
    for name in ("killed", "running"):
        spark.range(3).write.parquet(f"{top}/{name}/enriched")
    aged(root, 3)
    spark.range(3).write.parquet(f"{top}/running/name")  # goes on writing
    rows = {name: rows_of(publish.read_current(spark, root, name)) for name in enrich.FIELD_OF}
    assert publish.sweep(spark, root, keep=1, older_than=timedelta(days=30)) == []
    gone = publish.sweep(spark, root, keep=1, older_than=day)
    assert f"{top}/killed" in gone and not os.path.exists(f"{top}/killed") and os.path.exists(f"{top}/running/enriched")
    # The first run's output goes; the buckets the current run still uses stay, replaced ones go.
    needed = set(publish.current(spark, root).paths.values())
    assert not os.path.exists(f"{top}/{runs[0].attempt}/enriched")
    assert all(os.path.exists(p) for p in needed) and any(runs[0].attempt in p for p in needed)
    left = [f"{top}/{runs[0].attempt}/name/{x}" for x in os.listdir(f"{top}/{runs[0].attempt}/name") if x.startswith("id_bucket")]
    assert left and set(left) <= needed
    assert rows == {name: rows_of(publish.read_current(spark, root, name)) for name in enrich.FIELD_OF}
    assert publish.last(spark, root) == 3
    with pytest.raises(ValueError):
        publish.sweep(spark, root, keep=0, older_than=day)


def test_stages_of_killed_runs_are_swept(spark):
    with stages_of(spark, "in_progress"):
        stage(spark.range(3), "x")
        remove(spark, f"{stage_root(spark)}/ledgerlink/killed")
        spark.range(3).write.parquet(f"{stage_root(spark)}/ledgerlink/killed/names-1")
        aged(f"{stage_root(spark)}/ledgerlink/killed", 5)
        gone = sweep_stages(spark, timedelta(days=2))
        assert [g.rsplit("/", 1)[1] for g in gone] == ["killed"]
        assert os.path.exists(f"{stage_root(spark)}/ledgerlink/in_progress")


def test_rejects_are_also_csv_only_if_there_are_any(spark, masters, first, tmp_path):  # noqa: F811
    root = str(tmp_path / "o")
    done = enrich.run(spark, batch(tmp_path / "a", [rec(), "E", ""]), masters, root, SMALL)
    path = publish.current(spark, root).paths[enrich.REJECTS_CSV]
    got = spark.read.option("header", True).csv(path)
    assert got.columns == ["value", "reject_reason", "record_length"] and got.count() == 2
    assert {r.reject_reason for r in got.collect()} == {intake.REJECT_REASON} and done.rejected == 2
    assert enrich.REJECTS_CSV not in publish.current(spark, first[0]).paths


def numbers(spark, root):
    """(kept, highest in the table) by table and id, of the run published last."""
    known = enrich.read_masters(spark, root)
    out = {}
    for spec in enrich.NUMBERED:
        on, seq = spec.key
        kept = {r[0]: r[1] for r in known.in_use[spec.name].select(on, "last").collect()}
        rows = known.tables()[spec.name].groupBy(on).agg(F.max(seq))
        out[spec.name] = kept, {r[0]: r[1] for r in rows.collect()}
    return out


def test_kept_numbers_equal_the_highest_after_three_batches(spark, first, tmp_path):
    root = copy_of(first[0], tmp_path / "o")
    batches = [
        [rec(ein=NEW[0], name="SECOND NAME LTD", home=other("2 SIDE RD")), rec(ein=E2, name="FRESH ID")],
        [rec(ein=NEW[0], name="THIRD NAME GMBH", home=other("3 SIDE RD")), rec(ein="A11111111", name="SPECIAL NINE")],
        [rec(ein=E2, name="NEXT OF FRESH", home=other("4 SIDE RD")), rec(ein=NEW[1], name=f"COMPANY {NEW[1]}")],
    ]
    for i, lines in enumerate(batches):
        before = publish.current(spark, root)
        enrich.run(spark, batch(tmp_path / f"in{i}", lines), enrich.read_masters(spark, root), root, SMALL)
        for name, (kept, highest) in numbers(spark, root).items():
            assert kept == highest and kept, name
        # Buckets without changes are not written again.
        after = publish.current(spark, root)
        for kept in enrich.IN_USE.values():
            old, new = publish.bucket_paths(before, kept), publish.bucket_paths(after, kept)
            assert sum(new[n] != old.get(n) for n in new) <= 2 and old.keys() <= new.keys()


def test_a_number_is_not_given_again_after_its_row_is_gone(spark, first, tmp_path):
    root = copy_of(first[0], tmp_path / "o")
    enrich.run(spark, batch(tmp_path / "a", [rec(ein=E2, name="ONE"), rec(ein=E2, name="ZWEI WERKE")]), enrich.read_masters(spark, root), root, SMALL)
    known = enrich.read_masters(spark, root)
    gone = known.names.filter(~((F.col("empr_id") == E2) & (F.col("nm_snum") == 2)))
    fewer = enrich.Masters(**{f: gone if n == "name" else known.tables()[n] for n, f in enrich.FIELD_OF.items()}, in_use=known.in_use)
    without = replace(fewer, in_use={})
    for given, number in ((fewer, 3), (without, 2)):
        done = enrich.run(spark, batch(tmp_path / f"b{number}", [rec(ein=E2, name="DRITTE QUELLE")]), given, str(tmp_path / f"w{number}"), SMALL)
        rows = done.tables["name"].filter((F.col("empr_id") == E2) & F.col("empr_nm").startswith("DRITTE")).collect()
        assert [r.nm_snum for r in rows] == [number]


def test_roots_without_kept_numbers_get_them(spark, first, tmp_path):
    """A run published before numbers were kept: its tables are asked, and the next run keeps them."""
    root = copy_of(first[0], tmp_path / "o")
    known = enrich.read_masters(spark, root)
    old = replace(
        known, in_use={}, schemas={n: known.schemas[n] for n in enrich.FIELD_OF}, paths={n: known.paths[n] for n in enrich.FIELD_OF}
    )
    enrich.run(spark, batch(tmp_path / "a", [rec(ein=NEW[5], name="SECOND OF FIVE")]), old, root, SMALL)
    for kept, highest in numbers(spark, root).values():
        assert kept == highest and kept
