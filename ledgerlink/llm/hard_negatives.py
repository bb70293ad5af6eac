"""Hard negatives by a secondary sort: for an anchor and a positive, rows of other labels that score almost as high.

Scored pairs carry one packed key (descending score, positives before negatives, id). They are dealt out by anchor and sorted by
(anchor, key) within partitions, the DataFrame form of repartitionAndSortWithinPartitions. An iterator then reads each
anchor's pairs once: a positive opens a window of scores, and the negatives after it are given out while
they lie in an open window that is not full. It holds the open windows only, never an anchor's pairs.

Before that shuffle a block of rows sends on only what can be among an anchor's first: its best positives, and once
these are known, the first rows of every window. The first rows of a window over all blocks are among them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.blocks import BLOCK_ROWS, Vectors, best_first, met, vector_rows
from ledgerlink.staging import stage

POSITIVE, NEGATIVE = 0, 1
KEY = np.dtype([("score", ">u8"), ("kind", "u1"), ("missing", "u1"), ("id", ">u8"), ("row", ">u8")])
SIGN = np.uint64(1 << 63)
PAIRS = "anchor bigint, anchor_id bigint, score bigint, key binary"
MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def pack_keys(score: np.ndarray, kind: int, missing: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> pa.Array:
    """Keys whose bytes sort as (descending score, kind, missing ids last, id, row)."""
    key = np.empty(len(score), KEY)
    key["score"] = ~(score.astype(np.int64).view(np.uint64) ^ SIGN)
    key["kind"], key["missing"] = kind, missing
    key["id"] = np.ascontiguousarray(ids, np.int64).view(np.uint64) ^ SIGN
    key["row"] = rows
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY.itemsize), len(key), [None, pa.py_buffer(key.tobytes())])
    return fixed.cast(pa.binary())


def unpack_keys(keys: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), KEY)


def numbers(values: np.ndarray) -> list[int]:
    """Signed numbers from the unsigned ones of a key."""
    return (values.astype(np.uint64) ^ SIGN).view(np.int64).tolist()


class PairSearch:
    """Scores every row of a block for each anchor, and sends on those that ``picked`` chooses."""

    prepare = staticmethod(Vectors)

    def __call__(self, block: Vectors, asked: Vectors) -> Iterator[pa.RecordBatch]:
        if block.exact_in_doubles(asked):
            scores = (asked.values.T.astype(np.float64) @ block.values.astype(np.float64)).astype(np.int64)
        else:
            scores = asked.values.T @ block.values
        anchors, ids, picked, keys = [], [], [], []
        for i, one in enumerate(scores):
            at = self.picked(block, asked, i, one)
            anchors.append(np.full(len(at), asked.row[i]))
            ids.append(np.full(len(at), asked.id[i]))
            picked.append(one[at])
            keys.append(pack_keys(one[at], self.kind, block.missing[at], block.id[at], block.row[at]))
        columns = [pa.array(np.concatenate(c)) for c in (anchors, ids, picked)]
        yield pa.RecordBatch.from_arrays([*columns, pa.concat_arrays(keys)], ["anchor", "anchor_id", "score", "key"])


class Positives(PairSearch):
    """The best other rows of an anchor's label."""

    kind = POSITIVE

    def __init__(self, most: int):
        self.most = most

    def picked(self, block: Vectors, asked: Vectors, i: int, scores: np.ndarray) -> np.ndarray:
        at = np.flatnonzero((block.label == asked.label[i]) & (block.row != asked.row[i]))
        return at[best_first(scores[at], block.id[at], block.missing[at], block.row[at], self.most)]


class Negatives(PairSearch):
    """The first rows of other labels in the window of each positive.

    An anchor's label is given with its positives' scores, which stand in the place of a vector's end.
    """

    kind = NEGATIVE

    def __init__(self, most: int, low: int, high: int, windows: int):
        self.most, self.low, self.high, self.windows = most, low, high, windows

    def __call__(self, block: Vectors, asked: Vectors) -> Iterator[pa.RecordBatch]:
        # The last components are the number of positives and their scores.
        given = asked.values[len(block.values) :]
        self.count, self.tops = given[0], given[1:]
        asked.values = asked.values[: len(block.values)]
        asked.largest = int(np.abs(asked.values).max(initial=0))
        return super().__call__(block, asked)

    def picked(self, block: Vectors, asked: Vectors, i: int, scores: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(block.label != asked.label[i])
        own, chosen = scores[at], [np.zeros(0, np.int64)]
        for top in set(self.tops[: self.count[i], i].tolist()):
            inside = at[(own <= top) & (own >= -(-self.low * top // self.high))]
            best = best_first(scores[inside], block.id[inside], block.missing[inside], block.row[inside], self.most)
            chosen.append(inside[best])
        return np.unique(np.concatenate(chosen))


def mine(pairs: Iterable[tuple], most: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from pairs
    (anchor, anchor_id, score, kind, id) in order of (anchor, key)."""
    now, windows = None, []
    for anchor, anchor_id, score, kind, other in pairs:
        if anchor != now:
            now, windows = anchor, []
        if kind == POSITIVE:
            windows.append([other, score, 0])
            continue
        for window in windows:
            positive, top, given = window
            # The order gives score <= top.
            if given < most and low * top <= high * score:
                window[2] += 1
                yield anchor_id, positive, given + 1, other, top, score
        # A window that has ended for this score has ended for all that follow.
        windows = [w for w in windows if w[2] < most and low * w[1] <= high * score]


def hard_negatives(
    vectors: DataFrame,
    every_nth: int = 100,
    positives: int = 5,
    negatives: int = 5,
    scale: int = 256,
    share: tuple[int, int] = (80, 100),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    Anchors are rows whose id ``every_nth`` divides. Its positives are the ``positives`` other rows of its label with
    the highest scores; for each, the first ``negatives`` rows of other labels whose score is at most the positive's and at least
    ``share`` of it are given, ranked from 1. A score is the inner product of the components floor(scale * x), in
    64 bits; ties go to the smaller id, rows without an id come last. Rows with a null label or vector, or with a null or
    non-finite component, take no part. Rows that share an id are rows of their own, and rows without an id are no
    anchors but may be found. Vectors of another length than the anchor's are not compared with it. Fewer positives or
    negatives give fewer rows; a positive with a negative score has an empty window. Labels are whole numbers. Other
    columns are not looked at; an empty table gives no rows.
    """
    low, high = share
    rows = vector_rows(vectors, id_col, vector_col, scale, vectors[label_col])
    asked = rows.filter(F.pmod("id", F.lit(every_nth)) == 0)
    near = met(rows, asked, Positives(positives), PAIRS, block_rows)
    place = F.row_number().over(Window.partitionBy("anchor").orderBy("key"))
    near = stage(near.withColumn("place", place).filter(F.col("place") <= positives).drop("place"), "positives")
    # The windows go along behind the vector's components.
    tops = near.groupBy("anchor").agg(F.collect_list("score").alias("tops"))
    width = F.lit(positives) - F.size("tops")
    windows = F.concat(F.array(F.size("tops").cast("long")), "tops", F.array_repeat(F.lit(0).cast("long"), width))
    opened = asked.join(tops, asked["row"] == tops["anchor"]).withColumn("v", F.concat("v", windows))
    far = met(rows, opened.drop("anchor", "tops"), Negatives(negatives, low, high, positives), PAIRS, block_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MINED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]

        def pairs() -> Iterator[tuple]:
            for batch in batches:
                key = unpack_keys(batch.column("key"))
                scores = numbers(~key["score"].astype(np.uint64))
                others = [None if m else i for m, i in zip(key["missing"].tolist(), numbers(key["id"]), strict=True)]
                yield from zip(*(batch.column(c).to_pylist() for c in ("anchor", "anchor_id")), scores, key["kind"].tolist(), others, strict=True)

        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for row in mine(pairs(), negatives, low, high):
            held.append(row)
            if len(held) == 10_000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    dealt = near.union(far).repartition("anchor").sortWithinPartitions("anchor", "key")
    return dealt.mapInArrow(run, MINED)


def relabelled(vectors: DataFrame, every_nth: int = 7, labels: int = 10) -> DataFrame:
    """The table with label (label + 1) % ``labels`` where ``every_nth`` divides the id."""
    moved = F.when(F.col("vec_id") % every_nth == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


def hard_negatives_sql(every: int = 100, positives: int = 5, negatives: int = 5, scale: int = 256) -> str:
    """DuckDB SQL over ``embeddings``, by scoring every pair."""
    return f"""
WITH ok AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.row, a.vec_id AS anchor_id, c.row AS other, c.vec_id, a.label = c.label AS same,
        list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM ok a JOIN ok c ON a.row != c.row AND len(a.v) = len(c.v) WHERE a.vec_id % {every} = 0
), p AS (
    SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same
), n AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.row, p.other ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
    FROM p JOIN s ON s.row = p.row AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
    WHERE p.place <= {positives}
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {negatives}
"""
