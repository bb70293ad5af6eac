"""Exact top-k search by inner product, with sequential access to sorted lists only.

Vectors are packed into blocks; in a block every dimension is a list of its vectors sorted by value. For a query
the lists are read from their best ends, in step, while lower and upper bounds of the seen vectors are kept. Reading
stops when no unseen vector can still qualify; then the vectors whose upper bound reaches the
k-th best lower bound get their final scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.blocks import BLOCK_ROWS, Vectors, best_first, met, vector_rows

# A step reads this many entries of a list, but at most one of this many parts of it.
READ, READ_PART = 1024, 4
FOUND = "query_row bigint, query_id bigint, row bigint, id bigint, score bigint"


class Block(Vectors):
    """A block whose dimensions are sorted lists."""

    def __init__(self, row: dict):
        super().__init__(row)
        self.lists = np.frombuffer(row["lists"], "<i4").reshape(self.values.shape)
        # What the lists hold, in their order, and the vectors by row; whole numbers below 2 ** 53.
        self.listed = np.take_along_axis(self.values, self.lists, 1).astype(np.float64)
        self.rows = np.ascontiguousarray(self.values.T).astype(np.float64)

    def search(self, own_row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best vectors but the query's own row."""
        # Bounds are sums of whole numbers: exact in doubles while they stay below 2 ** 53.
        exact = self.largest * int(np.abs(query).max(initial=0)) * max(len(query), 1) < 1 << 53
        survivors = np.arange(len(self.id))
        if exact and query.any():
            survivors = self._read(own_row, query.astype(np.float64), k)
        survivors = survivors[self.row[survivors] != own_row]
        if exact:
            scores = (self.rows[survivors] @ query.astype(np.float64)).astype(np.int64)
        else:
            scores = self.values[:, survivors].T @ query
        at = survivors
        best = best_first(scores, self.id[at], self.missing[at], self.row[at], k)
        return at[best], scores[best]

    def _read(self, own_row: int, query: np.ndarray, k: int) -> np.ndarray:
        """Places of all vectors that can be among the k best.

        Lists of positive components are read from their end, those of negative ones from their start.
        """
        n = len(self.id)
        sides = [(d, query[d], up) for up, d in ((True, np.flatnonzero(query > 0)), (False, np.flatnonzero(query < 0)))]
        sides = [x for x in sides if len(x[0])]

        def column(at: int) -> list[np.ndarray]:
            """What each list adds to a score at a depth."""
            return [q * self.listed[d, n - 1 - at if up else at] for d, q, up in sides]

        least = column(n - 1)
        lower = np.full(n, sum(x.sum() for x in least))  # unseen components count the least their list has
        seen = np.zeros(n, bool)
        own = np.flatnonzero(self.row == own_row)
        read: list = []
        step = max(1, min(READ, n // READ_PART))
        for depth in range(0, n, step):
            upto = min(n, depth + step)
            for (d, q, up), low in zip(sides, least, strict=True):
                part = slice(n - upto, n - depth) if up else slice(depth, upto)
                at = self.lists[d, part]
                gain = q[:, None] * self.listed[d, part] - low[:, None]
                lower += np.bincount(at.ravel(), gain.ravel(), n)
                seen[at.ravel()] = True
                read.append((at, gain))
            if upto == n:
                break
            among = seen.copy()
            among[own] = False
            known = lower[among]
            if len(known) < k:
                continue
            kth = np.partition(known, len(known) - k)[len(known) - k]
            frontier = column(upto - 1)
            # An unseen vector has at most the sum of what the lists are at; an equal score could win by its id.
            if sum(x.sum() for x in frontier) < kth:
                # Upper bounds: what is read, and for every other list what it is at.
                upper = np.full(n, sum(x.sum() for x in frontier))
                for i, (at, gain) in enumerate(read):
                    side = i % len(sides)
                    more = gain + (least[side] - frontier[side])[:, None]
                    upper += np.bincount(at.ravel(), more.ravel(), n)
                return np.flatnonzero(among & (upper >= kth))
        return np.arange(n)


class Search:
    """The k best of one block for each of some queries."""

    def __init__(self, k: int):
        self.k = k

    prepare = staticmethod(Block)

    def __call__(self, block: Block, asked: Vectors) -> Iterator[pa.RecordBatch]:
        found = [block.search(int(r), q, self.k) for r, q in zip(asked.row, asked.values.T, strict=True)]
        sizes = [len(places) for places, _ in found]
        at = np.concatenate([places for places, _ in found])
        columns = [
            pa.array(np.repeat(asked.row, sizes)),
            pa.array(np.repeat(asked.id, sizes)),
            pa.array(block.row[at]),
            pa.array(block.id[at], mask=block.missing[at]),
            pa.array(np.concatenate([scores for _, scores in found]).astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "row", "id", "score"])


def top_k(
    vectors: DataFrame,
    every_nth: int = 100,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): for each row whose id ``every_nth`` divides, the k rows of highest score but itself.

    The score is the inner product of whole-number components (64-bit); ties go to the smaller id, rows without an id come
    last. Fewer than k other vectors give as many rows. Vectors that are null, or hold a null or non-finite component,
    take no part. Rows that share an id are rows of their own: each is a query if ``every_nth`` divides it, and a
    candidate for the others. Rows without an id are candidates only. Vectors of another length than the query's
    are not compared with it. Other columns are not looked at; an empty table gives no rows.

    Every block of vectors meets every block of queries, which are a stated set. Each meeting
    sends k rows per query on.
    """
    rows = vector_rows(vectors, id_col, vector_col, scale)
    asked = rows.filter(F.pmod("id", F.lit(every_nth)) == 0)
    found = met(rows, asked, Search(k), FOUND, block_rows, lists=True)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")


def top_k_sql(every: int = 100, k: int = 10, scale: int = 1024) -> str:
    """DuckDB SQL over ``embeddings``, by scoring every pair."""
    return f"""
WITH ok AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM ok q JOIN ok c ON q.row != c.row AND len(q.v) = len(c.v) WHERE q.vec_id % {every} = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}
"""
