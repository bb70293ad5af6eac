"""Lookups of a chunk: most grams are found without bisection, and only a slice's new words are hashed."""

import numpy as np
import pyarrow as pa

from ledgerlink.llm import ppm


def test_few_grams_are_bisected(monkeypatch):
    rng = np.random.default_rng(5)
    gram = np.unique(rng.integers(0, 1 << 48, 200_000))
    value = rng.random(len(gram))
    mixed = rng.permutation(len(gram))
    known = ppm.GramValues(gram[mixed], value[mixed])
    asked, bisected, search = rng.integers(0, len(gram), 300_000), [], np.searchsorted

    def counted(a, v, *more):
        bisected.append(len(v))
        return search(a, v, *more)

    monkeypatch.setattr(np, "searchsorted", counted)
    assert (known.find(gram[asked]) == value[asked]).all()
    assert sum(bisected) < 0.05 * len(asked)


def test_grams_without_a_slot_of_their_own(monkeypatch):
    monkeypatch.setattr(ppm.GramValues, "TABLES", ((0, 0), (0, 2)))  # all grams share one slot
    gram = np.array([7, 3, 5, 0], np.int64)
    assert ppm.GramValues(gram, gram / 2).find(np.array([0, 3, 3, 7, 5])).tolist() == [0, 1.5, 1.5, 3.5, 2.5]


def test_only_new_words_are_hashed(monkeypatch):
    words = ppm.WordCounts()
    names = [b"w%d" % i for i in range(5000)]
    for part in (names[:2000], names[2000:]):
        words.add(pa.table({"word": pa.array(part, pa.binary()), "c": pa.array([int(w[1:]) + 1 for w in part])}))
    hashed, index_in = [], ppm.pc.index_in

    def counted(values, value_set):
        hashed.append(len(value_set))
        return index_in(values, value_set=value_set)

    monkeypatch.setattr(ppm.pc, "index_in", counted)
    per_text, n = words.of([b"w10 w4999 other w10", b"", b"w0"])
    assert per_text.tolist() == [4, 0, 1] and n.tolist() == [11, 5000, 0, 11, 1]
    assert hashed == [4]
