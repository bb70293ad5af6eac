"""Pair merging over many short symbol sequences at once, as ragged numpy arrays.

A batch is one flat symbol array and the length of every sequence. In each round every
sequence finds its lowest-rank mergeable pair and applies it; sequences without one
leave the batch.
"""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int64(1) << 40
BITS = 21
# Sequences above this go through a heap, whose work grows as n log n and not with
# rounds times length.
LONG = 2_000
BLOCK = 1 << 19


class PairTable:
    """(left, right) -> rank and merged symbol, looked up for whole arrays."""

    def __init__(self, left, right, rank, merged):
        key = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        order = np.argsort(key)
        self.key = key[order]
        self.rank = np.asarray(rank, np.int64)[order]
        self.merged = np.asarray(merged, np.int64)[order]
        slot = self._slot(self.key)
        self.at = np.full(1 << BITS, -1, np.int32)
        self.at[slot] = np.arange(len(slot))
        # Slots with several pairs are searched for instead.
        self.shared = np.bincount(slot, minlength=1 << BITS) > 1

    @staticmethod
    def _slot(key):
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def find(self, left, right):
        """Index into ``rank`` and ``merged`` for each pair, -1 if it cannot merge."""
        key = (left << 32) | right
        slot = self._slot(key)
        at = self.at[slot]
        at[self.key[at] != key] = -1
        crowded = np.flatnonzero(self.shared[slot])
        if len(crowded):
            k = key[crowded]
            i = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
            at[crowded] = np.where(self.key[i] == k, i, -1)
        return at

    def pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {
            (k >> 32, k & 0xFFFFFFFF): (r, m)
            for k, r, m in zip(self.key.tolist(), self.rank.tolist(), self.merged.tolist(), strict=True)
        }


def merge_long(symbols: list[int], pairs: dict) -> list[int]:
    """One sequence, by a heap of candidate pairs: lowest rank first, then leftmost."""
    nxt = [*range(1, len(symbols)), -1]
    prev = list(range(-1, len(symbols) - 1))
    symbols = list(symbols)
    heap = []

    def offer(i):
        j = nxt[i]
        if j >= 0 and (found := pairs.get((symbols[i], symbols[j]))):
            heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(len(symbols)):
        offer(i)
    while heap:
        _, i, a, b, merged = heapq.heappop(heap)
        j = nxt[i]
        if symbols[i] != a or j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j] = merged, -1
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [s for s in symbols if s >= 0]


def merge_block(flat: np.ndarray, lengths: np.ndarray, table: PairTable, leftmost: bool):
    """Merged symbols of all sequences and their lengths; no sequence is empty."""
    n = len(lengths)
    done_symbols, done_owner = [], []
    owner = np.repeat(np.arange(n), lengths)
    while len(flat):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        at = np.full(len(flat), -1, np.int64)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        at[inside] = table.find(flat[inside], flat[inside + 1])
        rank = np.where(at >= 0, table.rank[at], NONE)
        per = np.diff(np.r_[starts, len(flat)])
        best = np.repeat(np.minimum.reduceat(rank, starts), per)
        ended = best == NONE
        if ended.any():
            done_symbols.append(flat[ended])
            done_owner.append(owner[ended])
            alive = ~ended
            flat, owner, at, rank, best = flat[alive], owner[alive], at[alive], rank[alive], best[alive]
            if not len(flat):
                break
        hits = np.flatnonzero(rank == best)
        if leftmost:
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
        else:
            # In a run of overlapping hits (a a a) every other one is applied, from the left.
            apart = np.r_[True, (hits[1:] != hits[:-1] + 1) | (owner[hits[1:]] != owner[hits[:-1]])]
            first = np.maximum.accumulate(np.where(apart, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - first) % 2 == 0]
        flat[hits] = table.merged[at[hits]]
        keep = np.ones(len(flat), bool)
        keep[hits + 1] = False
        flat, owner = flat[keep], owner[keep]
    owner = np.concatenate(done_owner) if done_owner else np.empty(0, np.int64)
    symbols = np.concatenate(done_symbols) if done_symbols else np.empty(0, np.int64)
    return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)


def merge_all(flat: np.ndarray, lengths: np.ndarray, table: PairTable, pairs, leftmost: bool):
    """Merged symbols of all sequences and their lengths, in blocks of bounded size.

    ``pairs()`` gives the table as a dict; it is asked for only if there are long sequences.
    No sequence is empty.
    """
    ends = np.cumsum(lengths)
    symbols, counts = [], []
    cuts = np.flatnonzero(np.diff(ends // BLOCK, append=-1))
    at = 0
    for cut in cuts:
        size = lengths[at : cut + 1]
        part = flat[ends[at] - lengths[at] : ends[cut]]
        if size.max() > LONG:
            each = np.split(part, np.cumsum(size)[:-1])
            each = [
                np.array(merge_long(x.tolist(), pairs()), np.int64)
                if len(x) > LONG
                else merge_block(x.copy(), np.array([len(x)]), table, leftmost)[0]
                for x in each
            ]
            symbols.extend(each)
            counts.append(np.array([len(x) for x in each]))
        else:
            got = merge_block(part.copy(), size, table, leftmost)
            symbols.append(got[0])
            counts.append(got[1])
        at = cut + 1
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *symbols]), np.concatenate([empty, *counts])
