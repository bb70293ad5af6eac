"""Jaro-Winkler scoring of name pairs, and a bound that rules pairs out unscored."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

# Send the scorer to the executors with the query, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PREFIX_CHARS = 4
PREFIX_WEIGHT = 0.1
BOOST_ABOVE = 0.7


def _codes(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of character codes per name, zero padded, and the lengths."""
    lengths = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(lengths.max(initial=0)), 1)
    text = names.to_numpy(zero_copy_only=False).astype(f"U{width}")
    codes = text.view(np.uint32).reshape(len(text), width)
    if codes.max(initial=0) < 256:
        codes = codes.astype(np.uint8)
    return codes, lengths


def _low_bits(words: int) -> np.ndarray:
    """Row ``k`` holds the lowest ``k`` bits set, spread over 64-bit words."""
    marks = np.tri(64 * words + 1, 64 * words, -1, dtype=np.uint8)
    return np.packbits(marks, axis=1, bitorder="little").view(np.uint64)


def jaro_winkler(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Scores of a batch of pairs: a step per character position, all pairs at once."""
    a, len_a = _codes(left)
    b, len_b = _codes(right)
    n = len(a)
    if n == 0:
        return np.zeros(0)
    words = -(-b.shape[1] // 64)
    width = 64 * words
    wide = np.zeros((n, width), dtype=b.dtype)
    wide[:, : b.shape[1]] = b
    low = _low_bits(words)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)

    # Bit j of a row stands for position j of the right name.
    free = low[len_b]
    matched_a = np.zeros(a.shape, dtype=bool)
    for i in range(a.shape[1]):
        equal = (wide == a[:, i : i + 1]).ravel()
        same = np.packbits(equal, bitorder="little").view(np.uint64).reshape(n, words)
        same &= free & low[np.minimum(i + reach + 1, width)] & ~low[np.clip(i - reach, 0, width)]
        same[i >= len_a] = 0
        for w in range(words):
            first = np.where(matched_a[:, i], np.uint64(0), same[:, w] & (~same[:, w] + np.uint64(1)))
            free[:, w] ^= first
            matched_a[:, i] |= first != 0
    taken = np.ascontiguousarray(low[len_b] ^ free).view(np.uint8)
    matched_b = np.unpackbits(taken.ravel(), bitorder="little").reshape(n, width).astype(bool)

    m = matched_a.sum(axis=1)
    # Both masks hold m marks per row, so reading them row by row lines the
    # matched characters of the two names up in order.
    differ = a[matched_a] != wide[matched_b]
    owner = np.nonzero(matched_a)[0]
    half = np.bincount(owner[differ], minlength=n) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = (m / len_a + m / len_b + (m - half) / m) / 3.0
    jaro = np.where(m > 0, jaro, 0.0)

    lead = min(PREFIX_CHARS, a.shape[1], b.shape[1])
    same = a[:, :lead] == b[:, :lead]
    same &= np.arange(lead)[None, :] < np.minimum(len_a, len_b)[:, None]
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    boosted = jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro)
    return np.where(jaro > BOOST_ABOVE, boosted, jaro)


@F.arrow_udf(DoubleType())
def _score(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(jaro_winkler(left, right))


# Declared so that a filter on the score is not moved below it, which would run it twice.
jaro_winkler_score = _score.asNondeterministic()


def signatures(names: pa.Array) -> pa.Array:
    """Three bit sets of each name, a step per character position, all names at once; see ``name_signature``."""
    codes, lengths = _codes(names)
    seen = [np.zeros(len(codes), np.uint64) for _ in SIGNATURE]
    for i in range(codes.shape[1]):
        bit = np.where(i < lengths, np.uint64(1) << (codes[:, i] & 63).astype(np.uint64), np.uint64(0))
        for once, more in ((1, 2), (0, 1)):
            seen[more] |= seen[once] & bit
        seen[0] |= bit
    return pa.StructArray.from_arrays([pa.array(s.view(np.int64)) for s in seen], SIGNATURE)


SIGNATURE = ["s1", "s2", "s3"]
_signature = F.arrow_udf(signatures, StructType([StructField(s, LongType()) for s in SIGNATURE]))


def name_signature(nm: str) -> Column:
    """Three bit sets: characters seen at least once, twice, three times. ``nm`` is not null.

    The bit is the character's code modulo 64, so space to ``>`` share bits with the
    backquote to ``~``. That makes the bound below looser, never wrong.
    """
    return _signature(nm)


def jaro_needed(threshold: float, prefix: int) -> float:
    """Smallest Jaro value that can still reach the threshold with this prefix."""
    if threshold <= BOOST_ABOVE:
        return threshold
    gain = PREFIX_WEIGHT * prefix
    return max(BOOST_ABOVE, (threshold - gain) / (1.0 - gain)) if prefix else threshold


def can_reach(left: str, right: str, threshold: float) -> Column:
    """True unless the character sets alone prove the score is below the threshold.

    Jaro is at most (m/|a| + m/|b| + 1) / 3, and m is at most the number of
    characters the two names share. Sides carry ``len``, ``sig`` and ``p1..p3``.
    """

    def f(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    def missing(x: str, y: str) -> Column:
        out = F.lit(0)
        for s in ("s1", "s2", "s3"):
            out = out + F.bit_count(f(x, s).bitwiseAND(F.bitwise_not(f(y, s))))
        return out

    shared = F.least(f(left, "len") - missing(left, right), f(right, "len") - missing(right, left))
    needed = (
        F.when(f(left, "p3") == f(right, "p3"), F.lit(jaro_needed(threshold, 4)))
        .when(f(left, "p2") == f(right, "p2"), F.lit(jaro_needed(threshold, 2)))
        .when(f(left, "p1") == f(right, "p1"), F.lit(jaro_needed(threshold, 1)))
        .otherwise(F.lit(jaro_needed(threshold, 0)))
    )
    best = shared / f(left, "len") + shared / f(right, "len") + 1
    return best >= 3 * needed - 1e-9
