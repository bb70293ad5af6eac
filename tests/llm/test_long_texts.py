"""Texts above one slice (2 MB), beside short ones, against the libraries or plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlink.llm import common, ppm
from ledgerlink.llm.decontaminate import contamination
from ledgerlink.llm.licenses import WORD_BYTES, license_scan
from ledgerlink.llm.ppm import ppm_scores
from ledgerlink.llm.simhash import simhash_groups
from ledgerlink.llm.token_counts import token_counts
from ledgerlink.llm.pieces import round_trip
from ledgerlink.llm.token_files import read_token_files, write_token_files
from tests.llm.conftest import wide
from tests.llm.test_documents import groups_of, ppm_by_hand
from tests.llm.test_tokenizers import PIECE, WORD, piece_library, word_ids, word_library  # noqa: F401

PASSAGE = " ".join(f"passage{i} é{i}" for i in range(15))
NOTICE = "This work is licensed under a Creative Commons Attribution 4.0 International License. Licensed under the Apache License, Version 2.0."


def long_text(documents, size, seed):
    """Given texts in some order, repeated until they have ``size`` bytes."""
    texts = sorted(t for _, t in documents if t)
    random.Random(seed).shuffle(texts)
    whole = "\n".join(texts)
    return "\n".join([whole] * (size // len(whole.encode()) + 1)).encode()[:size].decode("utf-8", "ignore")


@pytest.fixture(scope="module")
def rows(both):
    a = long_text(both["documents"], common.SLICE_BYTES + 300_000, 1)
    b = long_text(both["documents"], common.SLICE_BYTES + 5, 2)
    return [(1, a), (2, "short one"), (3, f"{a} {PASSAGE} {NOTICE} end"), (None, b), (4, None), (5, a.upper()), (6, "short two")]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return wide(spark, rows).repartition(2)


def test_tokens(frame, rows, word_library, tmp_path):  # noqa: F811
    ids = [word_ids(word_library, t) for _, t in rows]
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(frame, WORD).collect())
    assert got == Counter((i, len((t or "").encode()), len(x)) for (i, t), x in zip(rows, ids, strict=True))
    files = read_token_files(write_token_files(frame, WORD, 2, f"file://{tmp_path}/tokens"))
    got = {(r[0], *tuple(r)[2:]) for r in files.collect()}
    assert got == {(i, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for (i, _), x in zip(rows, ids, strict=True)}


def test_pieces(frame, rows, piece_library):  # noqa: F811
    got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in round_trip(frame, PIECE).collect())
    want = Counter()
    for i, t in rows:
        ids = piece_library.encode(t or "", add_bos=True, add_eos=True)
        want[i, np.array(ids, "<u4").tobytes(), piece_library.decode(ids)] += 1
    assert got == want


def test_fingerprints(frame, rows):
    assert Counter(map(tuple, simhash_groups(frame).collect())) == groups_of(rows)


def test_scores_over_several_slices(spark, rows, monkeypatch):
    """Texts above a slice, chunks of many slices, and sums of counts in between."""
    monkeypatch.setattr(ppm, "SLICE_BYTES", 40_000)
    some = [(i, t[:150_000] if t else t) for i, t in rows] + [(i, rows[0][1][9_000 * i : 9_000 * i + 30_000]) for i in range(10, 30)]
    for chunk in (1 << 20, 200_000):
        got = ppm_scores(wide(spark, some).repartition(2), order=3, chunk_bytes=chunk).collect()
        got, want = sorted(map(tuple, got), key=repr), sorted(ppm_by_hand(some, 3).elements(), key=repr)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert [x for r in got for x in r[5:]] == pytest.approx([x for r in want for x in r[5:]], abs=1e-4)


def test_scans_and_passages(spark, frame, rows):
    items = wide(spark, [(7, PASSAGE), (8, "not in any of the texts at all, not even six words")]).withColumnRenamed("doc_id", "item_id")
    words = {i: (t or "").encode().translate(WORD_BYTES).decode().split() for i, t in rows}
    found = {r.doc_id: r for r in license_scan(frame).collect()}
    assert {i: r.n_words for i, r in found.items()} == {i: len(w) for i, w in words.items()}
    assert {"apache", "apache-2.0-notice", "cc-notice"} <= set(found[3].labels.split(",")) and "cc-notice" not in found[1].labels
    first = words[3].index("passage0")
    assert [tuple(r) for r in contamination(frame, items).collect()] == [(3, 7, first, first + 29, 12)]
