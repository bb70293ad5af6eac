"""Helpers shared by the operators: texts in bounded slices, and connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.staging import stage

SLICE_BYTES = 2 << 20


class WordTable:
    """Ids (or only their number) by word, for whole slices of text at once.

    Words are found and compared with array operations. What a word of up to ``KEY_BYTES`` bytes gives is kept beside the
    word itself, in the one slot of a table of fixed size that its hash points to, for the life of a Python worker. A word
    that is not there, or is longer, is made again. Words count as equal only if all their bytes are.
    """

    KEY_BYTES = 24

    def __init__(self, separators: bytes, width: int, dtype: str, bits: int = 21):
        self.gap = separators[:1]
        self.apart = np.zeros(256, bool)
        self.apart[list(separators)] = True
        self.bits, self.width, self.dtype = bits, width, np.dtype(dtype)
        self.masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        self.key = np.zeros((self.KEY_BYTES // 8, 1 << bits), np.uint64)
        self.size = np.zeros(1 << bits, np.uint8)
        self.n = np.zeros(1 << bits, np.int64)
        self.ids = np.zeros((1 << bits, width), self.dtype)

    def _keys(self, blob: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The first bytes of each word as numbers, zero beyond its end."""
        windows = np.ndarray((len(blob) + self.KEY_BYTES - 7,), "<u8", blob + bytes(self.KEY_BYTES), strides=(1,))
        inside = (np.clip(lengths - 8 * k, 0, 8) for k in range(len(self.key)))
        return np.stack([windows[np.minimum(starts + 8 * k, len(blob))] & self.masks[m] for k, m in enumerate(inside)])

    def _hash(self, keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where to look; two words may share it."""
        h = lengths.astype(np.uint64)
        for part in keys:
            h = (h ^ (h >> np.uint64(32)) ^ part) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def _distinct(self, words, short: np.ndarray, keys: np.ndarray, lengths: np.ndarray, h: np.ndarray):
        """(place of one of each word, number of its word for each) for some words, compared byte by byte.

        Long words, and the rare short ones that share a hash with another, are told apart by a dictionary.
        """
        which = np.zeros(len(h), np.int64)
        at = np.flatnonzero(short)
        _, first, group = np.unique(h[at], return_index=True, return_inverse=True)
        like = at[first[group]]
        odd = (lengths[at] != lengths[like]) | (keys[:, at] != keys[:, like]).any(0)
        which[at] = group
        places, seen = at[first].tolist(), {}
        for i in (*np.flatnonzero(~short).tolist(), *at[odd].tolist()):
            number = seen.setdefault(words(i), len(places))
            if number == len(places):
                places.append(i)
            which[i] = number
        return np.array(places, np.int64), which

    def look_up(self, texts: list[bytes], make) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(words of each text, ids of each word, all ids in order or None if ``width`` is 0).

        ``make(words)`` gives (ids of each word, all ids or None) for new words.
        """
        blob = self.gap.join([*texts, b""])
        apart = self.apart[np.frombuffer(blob, np.uint8)]
        turn = np.diff(apart.view(np.int8), prepend=np.int8(1))
        starts, ends = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        per_text = np.diff(np.searchsorted(starts, begins))
        if not len(starts):
            return per_text, np.zeros(0, np.int64), np.zeros(0, self.dtype) if self.width else None
        lengths = ends - starts
        short = lengths <= self.KEY_BYTES
        keys = self._keys(blob, starts, lengths)
        h = self._hash(keys, lengths)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        hit = short & (self.n[slot] > 0) & (self.size[slot] == lengths)
        for known, part in zip(self.key, keys, strict=True):
            hit &= known[slot] == part
        n = np.where(hit, self.n[slot], 0)
        miss = np.flatnonzero(~hit)
        which = new = made = None
        if len(miss):
            word = lambda i: blob[starts[miss[i]] : ends[miss[i]]]
            places, which = self._distinct(word, short[miss], keys[:, miss], lengths[miss], h[miss])
            at = miss[places]
            new, made = make([blob[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            n[miss] = new[which]
        flat = self._gather(slot, hit, n, miss, which, new, made) if self.width else None
        if len(miss):
            keep = np.flatnonzero(short[at] & (new > 0) & (new <= self.width if self.width else True))
            to, at = slot[at[keep]], at[keep]
            # Of several new words for one slot the last stays, the same one in every array.
            to, last = np.unique(to[::-1], return_index=True)
            at, keep = at[::-1][last], keep[::-1][last]
            self.key[:, to], self.size[to], self.n[to] = keys[:, at], lengths[at], new[keep]
            if self.width:
                self.ids[to] = rows_of(made, new, self.width)[keep]
        return per_text, n, flat

    def _gather(self, slot, hit, n, miss, which, new, made) -> np.ndarray:
        out = np.empty(int(n.sum()), self.dtype)
        ends = np.cumsum(n)
        known = np.flatnonzero(hit)
        inside = np.arange(self.width) < n[known][:, None]
        out[((ends - n)[known][:, None] + np.arange(self.width))[inside]] = self.ids[slot[known]][inside]
        if len(miss):
            size = n[miss]
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat((ends - n)[miss], size) + step] = made[np.repeat((np.cumsum(new) - new)[which], size) + step]
        return out


def rows_of(flat: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` values of each part of a flat array, 0 beyond its end."""
    place = (np.cumsum(lengths) - lengths)[:, None] + np.arange(width)
    rows = flat[np.minimum(place, max(len(flat) - 1, 0))]
    return np.where(np.arange(width) < lengths[:, None], rows, 0)


def by_text(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each text's part in a flat list, from the numbers of parts."""
    ends = np.cumsum(lengths).tolist()
    return list(zip([0, *ends], ends, strict=False))


def sums_by_text(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each text's part; 0 for texts without any."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: str) -> str:
    """SQL for ``text`` with A-Z in lower case and all else as it is."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two columns, whatever else the frame has; a null text is an empty one."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("id"), text.cast("binary").alias("text"))


def id_type(docs: DataFrame, id_col: str) -> T.DataType:
    return docs.schema[id_col].dataType


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and texts of a batch in runs of at most ``most`` bytes (or one longer text)."""
    texts = batch.column(1)
    start = size = 0
    part: list[bytes] = []
    for i in range(len(texts)):
        one = texts[i].as_py()
        if part and size + len(one) > most:
            yield batch.column(0).slice(start, len(part)), part
            start, size, part = i, 0, []
        part.append(one)
        size += len(one)
    if part:
        yield batch.column(0).slice(start, len(part)), part


def per_text(docs: DataFrame, id_col: str, text_col: str, fields: Sequence[T.StructField], columns) -> DataFrame:
    """One row per document: its id, then what ``columns(texts)`` gives for a slice of texts.

    ``columns`` runs in the tasks and returns one list or array for each of ``fields``.
    """
    schema = T.StructType([T.StructField(id_col, id_type(docs, id_col)), *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            for ids, texts in slices(batch):
                made = [pa.array(x, f.type) for x, f in zip(columns(texts), list(out)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.cast(out.field(0).type), *made], schema=out)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges`` (a, b).

    Alternates large-star and small-star steps. A node's neighbours are never gathered:
    a step takes the minimum per node and joins it back, so a node with many
    edges is split like any other join. Every step is written to the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    links = stage(links.distinct(), name)
    before = None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        links = stage(small.filter("a != b").distinct(), name)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
