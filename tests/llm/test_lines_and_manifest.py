"""Merkle manifest, line dedup and hard negatives against plain Python, and on rows that are hard to bear."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import line_dedup as ld
from ledgerlink.llm.common import setting
from ledgerlink.llm.hard_negatives import hard_negatives, hard_negatives_sql, mine, pack_keys, relabelled, unpack_keys
from ledgerlink.llm.line_dedup import line_dedup, line_dedup_sql
from ledgerlink.llm.merkle import folded_root, merkle_audit, merkle_manifest, merkle_sql
from ledgerlink.llm.queries import op12_line_dedup
from tests.compare import differences

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, pos int, digest string, id string, row int, sub int, h string, at int, n int, lines string, batch int, kept string"
EXTRA = ("t", 1, "d", "i", 2, 3, "h", 4, 5, "l", 6, "k")


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS).repartition(3)


def duck_docs(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in rows])
    return con


def made_up_docs():
    rng = random.Random(4)
    rows = [(i, f"Text {i}", "en", f"src{i % 3}", i) for i in range(700)]  # more than one stored level
    rows += [(1000 + i, f"Texte {i}", "fr", None, None) for i in range(9)]
    rows += [(2000, "Allein", "de", "s", 6), (2001, None, None, None, None), (None, "No id", None, "s", 1), (None, None, "en", "s", 1)]
    rows += [(5, "Text 5", "en", "src2", 5), (5, "Text 5", "en", "src2", 5), (5, "other", "en", "src2", 5)]
    rows += [(3000 + i, "É   Ab", f"l{i}", "-", 0) for i in range(10)]  # more groups than one run
    rows += [(4000, "", "", "", 0), (-3, "A" * 200_000, "en", "s", 200_000)]
    rng.shuffle(rows)
    return rows


def manifest_by_hand(rows):
    def digest(values):
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([hashlib.sha256("".join(out[-1][i : i + 8]).encode()).hexdigest() for i in range(0, len(out[-1]), 8)])
        return out

    def climb(levels, place):
        for level in levels[:-1]:
            run = place - place % 8
            yield level[run:place], level[place + 1 : run + 8]
            place //= 8

    order = {}
    for doc, text, lang, source, n in rows:
        leaf = digest((doc, source, lang, n, text))
        low = text if text is None else "".join(c.lower() if c.isascii() else c for c in text)
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        order.setdefault(lang, []).append((doc is not None, doc or 0, leaf, doc, digest((doc, source, lang, n, low)) if hit else leaf))
    names = sorted(order, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in names:
        order[lang].sort(key=lambda x: x[:3])
        trees[lang] = levels([x[2] for x in order[lang]])
    outer = levels([trees[x][-1][0] for x in names])
    for at, lang in enumerate(names):
        for place, (_, _, leaf, doc, altered) in enumerate(order[lang]):
            path = [*climb(trees[lang], place), *climb(outer, at)]
            folded = altered
            for left, right in path:
                folded = hashlib.sha256("".join([*left, folded, *right]).encode()).hexdigest()
            proof = hashlib.sha256("".join(x for a, b in path for x in (*a, *b)).encode()).hexdigest()
            yield doc, leaf, trees[lang][-1][0], outer[-1][0], proof, folded, folded == outer[-1][0]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("take", [slice(None), slice(0, 1), slice(0, 3), slice(0, 0)])
def test_manifest_equals_plain_python_and_sql(spark, take):
    rows = made_up_docs()[take]
    got = merkle_audit(docs_of(spark, rows))
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == Counter(manifest_by_hand(rows))
    assert differences(got, duck_docs(rows), merkle_sql()) is None


def test_manifest_of_many_stored_levels(spark):
    """Every level is stored, and the outer tree has several too."""
    rows = made_up_docs()
    got = merkle_audit(docs_of(spark, rows), stride=1).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == Counter(manifest_by_hand(rows))


def test_one_changed_byte_fails_in_its_own_row_only(spark):
    rows = made_up_docs()
    proofs, roots = merkle_manifest(docs_of(spark, rows))
    changed = F.when(F.col("doc_id") == 77, F.unhex(F.sha2(F.lit("x"), 256))).otherwise(F.col("leaf"))
    bad = proofs.filter(folded_root(changed, "proof", "shape") != F.col("root"))
    assert [r.doc_id for r in bad.collect()] == [77]
    assert roots.count() == len({r[2] for r in rows})


LONG = "a line of more than ten characters"


def made_up_lines():
    rng = random.Random(8)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["short", "", "   ", "tenletters", "ninelettr"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9))), "en", "s", 1) for i in range(60)]
    rows += [(100, None, "en", "s", 1), (101, "", "en", "s", 1), (102, "\n\n\n", "en", "s", 1), (103, LONG, "en", "s", 1)]
    rows += [(104, f"  {LONG.upper()}\t\r\n{LONG}\x0b \n{LONG}\u0085 \n{LONG}", "en", "s", 1)]
    rows += [(105, "one here twice.\nx\none here twice.", "en", "s", 1), (106, "One here TWICE.\ny", "en", "s", 1)]
    rows += [(7, "same id one line\nsame id other", "en", "s", 1), (7, "same id one line\nz", "en", "s", 1), (108, "same id one line", "en", "s", 1)]
    rows += [(None, "only rows without\nids have this", "en", "s", 1), (None, "only rows without\nnothing", "en", "s", 1), (None, LONG, "en", "s", 1)]
    rows += [(109, "ÀÉÎ Straße\nÀÉÎ Straße", "en", "s", 1), (110, "àéî straße\nÀÉÎ sTRAßE", "en", "s", 1)]
    rows += [(111, "w" * 300_000 + "\n" + "\n".join(f"much text {i % 700}" for i in range(30_000)), "en", "s", 1), (112, "much text 5\n" + "w" * 300_000, "en", "s", 1)]
    rows += [(60, rows[0][1], "en", "s", 1)] * 3
    return rows


def dedup_by_hand(rows):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if c.isascii() else c for c in line)

    owners, docs = {}, {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            docs.setdefault(key(line), set()).add(doc)
    for k, ids in docs.items():
        if len(k) >= 10 and len(ids) > 1:
            owners[k] = min(i for i in ids if i is not None)
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if owners.get(key(x), doc) == doc]
        yield doc, len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize(("batches", "fan_in"), [(1, 2), (4, 2), (7, 2), (5, 3)])
def test_line_dedup_equals_plain_python(spark, batches, fan_in):
    rows = made_up_lines()
    got = line_dedup(docs_of(spark, rows), batches=batches, fan_in=fan_in).collect()
    assert Counter(map(tuple, got)) == Counter(dedup_by_hand(rows))
    assert not spark.catalog.listTables()  # the runs' tables are gone
    assert spark.conf.get(ld.SORTED_SCAN) == "false"


def test_line_dedup_equals_sql(spark, monkeypatch):
    for rows in (made_up_lines(), made_up_lines()[60:62], []):
        monkeypatch.setattr("ledgerlink.llm.queries.table", lambda *_, rows=rows: docs_of(spark, rows))
        assert differences(op12_line_dedup(spark, ""), duck_docs(rows), line_dedup_sql()) is None


def test_runs_are_merged_and_read_sorted(spark):
    runs = ld.Runs(spark, fan_in=2)
    try:
        for i in range(5):
            runs.add(spark.range(10 * i, 10 * i + 10).select(F.md5(F.col("id").cast("string")).cast("binary").alias("h")))
        assert [len(x) for x in runs.levels] == [1, 0, 1]
        asked = spark.range(100).select(F.md5(F.col("id").cast("string")).cast("binary").alias("h"))
        with setting(spark, ld.SORTED_SCAN, "true"):
            left = runs.unseen(asked)
            assert left.count() == 50
            plan = left._jdf.queryExecution().executedPlan().toString()
        # Neither run is shuffled; only the batch is.
        assert plan.count("SortMergeJoin") >= 2 and plan.split("Initial Plan")[-1].count("Exchange") <= 1
    finally:
        runs.close()


def test_line_dedup_has_no_python_in_its_plan(spark):
    plan = line_dedup(docs_of(spark, made_up_lines()[:20]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VECTORS = "vec_id bigint, embedding array<float>, label int, id string, v int, dim int, row int, block int, anchor int, score int, rank int, key string, chunk int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5, 6, 7, "k", 8) for r in rows], VECTORS).repartition(3)


def made_up_vectors():
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0, 1.5]) for _ in range(3)], rng.randrange(3)) for i in range(420)]
    rows += [(500, [1.0, 1.0, 1.0], 9), (600, [0.0] * 3, 1), (700, None, 1), (800, [1.0, None, 1.0], 1), (900, [1.0, float("nan"), 1.0], 1)]
    rows += [(1000, [1.0, float("inf"), 0.0], 0), (1100, [1.0, 1.0, 1.0], None), (None, [1.5, 1.5, 1.5], 1), (None, [1.5, 1.5, 1.0], 2)]
    rows += [(200, [1.0, 0.5, 1.5], 2), (200, rows[200][1], rows[200][2]), (1200, [1.0, 2.0], 1), (1201, [2.0, 2.0], 1), (1202, [2.0, 1.0], 2), (1300, [], 1), (1301, [], 1), (1302, [], 2)]
    return rows


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_hard_negatives_equal_sql(spark, block_rows, monkeypatch):
    from ledgerlink.llm import blocks

    if block_rows == 40:
        monkeypatch.setattr(blocks, "QUERY_ROWS", 2)
        monkeypatch.setattr(blocks, "CHUNK_BLOCKS", 2)
    rows = made_up_vectors()
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    got = hard_negatives(relabelled(vectors(spark, rows)), block_rows=block_rows)
    assert got.count() > 50
    assert differences(got, con, hard_negatives_sql()) is None
    assert hard_negatives(relabelled(vectors(spark, []))).count() == 0
    assert hard_negatives(vectors(spark, [(100, [1.0], 1)])).count() == 0


def test_keys_sort_as_the_pairs_do():
    rng = np.random.default_rng(1)
    score = rng.choice(np.array([-(1 << 62), -5, 0, 3, 1 << 62]), 200)
    ids = rng.choice(np.array([-9, -1, 0, 4, 1 << 61]), 200)
    rows, missing = rng.permutation(200), rng.integers(0, 2, 200).astype(bool)
    keys = pack_keys(score, 1, missing, ids, rows)
    by_bytes = sorted(range(200), key=lambda i: keys[i].as_py())
    assert by_bytes == sorted(range(200), key=lambda i: (-int(score[i]), missing[i], int(ids[i]), rows[i]))
    assert unpack_keys(keys)["row"].tolist() == rows.tolist()


def test_iterator_keeps_open_windows_only():
    """A million pairs of one anchor pass through; what is held is at most its positives."""

    def pairs():
        for score in range(1_000_000, 0, -1):
            yield 1, 100, score, int(score not in (1_000_000, 900_000, 10)), score

    got = list(mine(pairs(), 5, 80, 100))
    assert [r[:4] for r in got if r[1] == 10] == [(100, 10, i + 1, 9 - i) for i in range(2)]
    assert len(got) == 5 + 5 + 2
