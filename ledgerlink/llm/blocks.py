"""Vectors in blocks of bounded size, met with blocks of queries: a stated set of rows against all rows.

Every row has a number of its own, given once and written, so rows that share an id, or have none, stay apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.staging import stage

BLOCK_ROWS = 4096
QUERY_ROWS = 256
# Query blocks that meet one copy of a block.
CHUNK_BLOCKS = 64
MISSING = np.iinfo(np.int64).max


def whole_numbers(vector: Column, scale: int) -> Column:
    """Each component x as floor(scale * x); null if the vector or a component is null or not finite."""

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    doubles = F.transform(vector, lambda x: x.cast("double"))
    whole = F.transform(doubles, lambda x: F.floor(F.lit(scale) * x).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(F.exists(doubles, bad), F.lit(False)), whole)


def vector_rows(vectors: DataFrame, id_col: str, vector_col: str, scale: int, label: Column | None = None) -> DataFrame:
    """(row, id, label, v, dim) of every row with a usable vector, and a label where one is asked for; written."""
    number = F.lit(0).cast("long") if label is None else label.cast("long")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        vectors[id_col].cast("long").alias("id"),
        number.alias("label"),
        whole_numbers(vectors[vector_col], scale).alias("v"),
    )
    rows = rows.filter(F.col("v").isNotNull() & F.col("label").isNotNull())
    return stage(rows.withColumn("dim", F.size("v")), "vectors")


def best_first(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores, then smaller ids, missing ids last, then smaller rows."""
    places = np.arange(len(scores))
    if len(scores) > 4 * k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    order = np.lexsort((rows[places], ids[places], missing[places], -scores[places]))
    return places[order[:k]]


class Vectors:
    """Some rows of one dimension: ``values`` by dimension, then by row."""

    def __init__(self, row: dict):
        self.row = np.frombuffer(row["rows"], "<i8")
        self.id = np.frombuffer(row["ids"], "<i8")
        self.missing = np.frombuffer(row["missing"], "?")
        self.label = np.frombuffer(row["labels"], "<i8")
        self.values = np.frombuffer(row["vals"], "<i8").reshape(-1, len(self.row))
        self.largest = int(np.abs(self.values).max(initial=0))

    def exact_in_doubles(self, other: Vectors) -> bool:
        """Whether inner products, and the sums on the way, are below 2 ** 53."""
        return self.largest * other.largest * max(len(self.values), 1) < 1 << 53


FIELDS = ("rows", "ids", "missing", "labels", "vals", "lists")
PACKED = "dim int, block bigint, " + ", ".join(f"{f} binary" for f in FIELDS)


def packed(df: DataFrame, lists: bool = False) -> DataFrame:
    """One row per (dim, block) of ``df``; ``lists`` adds each dimension's places in order of value."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []

        def done() -> pa.RecordBatch:
            row, ids, missing, label, vals = (np.concatenate(x) for x in zip(*parts, strict=True))
            by_dim = np.ascontiguousarray(vals.T)
            order = np.argsort(by_dim, axis=1, kind="stable").astype("<i4").tobytes() if lists else None
            blobs = [x.tobytes() for x in (row, ids, missing, label, by_dim)] + [order]
            columns = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64())]
            columns += [pa.array([b], pa.binary()) for b in blobs]
            return pa.RecordBatch.from_arrays(columns, ["dim", "block", *FIELDS])

        for batch in batches:
            dim, block = (batch.column(c).to_numpy() for c in ("dim", "block"))
            edges = np.flatnonzero((np.diff(dim) != 0) | (np.diff(block) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(dim)], strict=True):
                if a == b:
                    continue
                if (dim[a], block[a]) != key:
                    if key:
                        yield done()
                    key, parts = (dim[a], block[a]), []
                part = batch.slice(a, b - a)
                ids = part.column("id")
                flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
                parts.append(
                    (
                        part.column("row").to_numpy(),
                        ids.fill_null(MISSING).to_numpy(),
                        ids.is_null().to_numpy(zero_copy_only=False),
                        part.column("label").to_numpy(),
                        flat.astype("<i8").reshape(b - a, len(flat) // (b - a)),
                    )
                )
        if key:
            yield done()

    spread = df.select("dim", "block", "row", "id", "label", "v").repartition("dim", "block")
    return spread.sortWithinPartitions("dim", "block", "row").mapInArrow(pack, PACKED)


def met(rows: DataFrame, asked: DataFrame, search, schema: str, block_rows: int = BLOCK_ROWS, lists: bool = False) -> DataFrame:
    """What ``search(block, queries)`` yields (record batches) for every block of ``rows`` and block of ``asked``.

    ``block`` is made by ``search.prepare`` once for all the queries that follow it; a copy of it serves up to
    ``CHUNK_BLOCKS`` blocks of queries, so what stands in one task is bounded. Only rows of one dimension meet.
    """
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    # One row per length of vectors.
    sizes = stage(sizes, "block_sizes")
    blocks = rows.join(F.broadcast(sizes), "dim").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    n_groups = max(1, -(-asked.count() // QUERY_ROWS))
    n_chunks = -(-n_groups // CHUNK_BLOCKS)
    every = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")
    blocks = packed(blocks, lists).select("*", F.lit(0).alias("kind"), every)
    group = F.pmod(F.xxhash64("row"), F.lit(n_groups).cast("long"))
    queries = packed(asked.withColumn("block", group)).withColumnRenamed("block", "group").join(F.broadcast(sizes), "dim")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block")
    chunk = F.floor(F.col("group") / CHUNK_BLOCKS).cast("int").alias("chunk")
    queries = queries.select("dim", each, *FIELDS, F.lit(1).alias("kind"), chunk)
    # A number of partitions is given, as few bytes of vectors are much work.
    tasks = min(20_000, 4 * n_chunks * (sizes.agg(F.sum("blocks")).first()[0] or 1))
    together = blocks.unionByName(queries).repartition(tasks, "dim", "block", "chunk")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["kind"] == 0:
                    key, block = (row["dim"], row["block"]), search.prepare(row)
                elif key == (row["dim"], row["block"]):
                    yield from search(block, Vectors(row))

    return together.sortWithinPartitions("dim", "block", "chunk", "kind").mapInArrow(run, schema)
