"""Benchmark decontamination: spaced-seed hashes, an equality join, substitution-tolerant verification.

A passage counts if 12 consecutive words of a document agree with 12 consecutive words of an item in at
least 10 places. Cut into four blocks of three words, two of the blocks then agree; the masks are
the three shapes that two of four blocks can have, so every such passage shares a seed with its item.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import fresh, id_and_text, id_type, slices
from ledgerlink.llm.licenses import WORD_BYTES
from ledgerlink.staging import stage

WINDOW, SUBSTITUTIONS = 12, 2
MASKS = ("111111", "111000111", "111000000111")
SHORTEST = 6
FILTER_BITS = 24


def _factors() -> np.ndarray:
    """An odd 64-bit factor per mask and position, from a fixed rule."""
    x = np.arange(1, len(MASKS) * WINDOW + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x | np.uint64(1)).reshape(len(MASKS), WINDOW)


FACTORS = _factors()


def seeds_of(texts: list[bytes], bits: np.ndarray | None) -> Iterator[tuple[int, int, int, int, str, int]]:
    """(text number, hash, word position, words before it in the context, context, words of the text) of every seed.

    With ``bits`` (a Bloom filter of 64-bit words) only of the seeds it may hold. The context is all words that a
    window around the seed can touch.
    """
    words = [t.translate(WORD_BYTES).split() for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    codes = np.fromiter((zlib.crc32(w) for ws in words for w in ws), np.uint64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(words)), lengths)
    for mask, factors in zip(MASKS, FACTORS, strict=True):
        span = len(mask)
        n = len(codes) - span + 1
        if n <= 0:
            continue
        h = np.zeros(n, np.uint64)
        for j, used in enumerate(mask):
            if used == "1":
                h += codes[j : j + n] * factors[j]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        inside = owner[:n] == owner[span - 1 :]
        for place in filter_places(h) if bits is not None else ():
            inside &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        for i in np.flatnonzero(inside).tolist():
            k = int(owner[i])
            at = i - int(starts[k])
            lo = max(0, at + span - WINDOW)
            yield k, int(h[i].astype(np.int64)), at, at - lo, b" ".join(words[k][lo : at + WINDOW]).decode(), len(words[k])


def filter_places(h: np.ndarray) -> list[np.ndarray]:
    """The two bits of the filter that a hash sets."""
    low = np.uint64((1 << FILTER_BITS) - 1)
    return [h >> np.uint64(64 - FILTER_BITS), (h >> np.uint64(12)) & low]


def seeds(docs: DataFrame, id_col: str, text_col: str, bits=None) -> DataFrame:
    """(id, hash, at, before, context, size) of the seeds of every row; ``bits`` is a broadcast filter."""
    schema = T.StructType(
        [
            T.StructField("id", id_type(docs, id_col)),
            T.StructField("hash", T.LongType()),
            T.StructField("at", T.LongType()),
            T.StructField("before", T.LongType()),
            T.StructField("context", T.StringType()),
            T.StructField("size", T.LongType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            for ids, texts in slices(batch):
                found = list(seeds_of(texts, None if bits is None else bits.value))
                for at in range(0, len(found), 1 << 16):
                    owner, *rest = zip(*found[at : at + (1 << 16)], strict=True)
                    columns = [ids.take(pa.array(owner)).cast(out.field(0).type)]
                    columns += [pa.array(x, f.type) for x, f in zip(rest, list(out)[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=out)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)


def seed_filter(items: DataFrame) -> np.ndarray:
    """A Bloom filter of the hashes of ``items``: 2 ** FILTER_BITS bits, whatever their number."""
    bits = [f"shiftrightunsigned(hash, {64 - FILTER_BITS})", f"shiftrightunsigned(hash, 12) & {(1 << FILTER_BITS) - 1}"]
    places = items.select(F.explode(F.array(*map(F.expr, bits))).alias("p"))
    word = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    rows = word.toPandas()  # at most one row per 64 bits of the filter
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint64)


def overlap(doc: list[str], doc_before: int, item: list[str], item_before: int, size: int) -> tuple[int, int, int] | None:
    """(first, last, best) of the agreeing windows around a seed, as offsets from it; None if there are none.

    ``size`` is the number of words in the item: an item shorter than the window must agree as a whole.
    """
    window = min(WINDOW, size)
    need = window - (SUBSTITUTIONS if size >= WINDOW else 0)
    lo = -min(doc_before, item_before)
    hi = min(len(doc) - doc_before, len(item) - item_before)
    same = [doc[doc_before + i] == item[item_before + i] for i in range(lo, hi)]
    found = [(i, n) for i in range(len(same) - window + 1) if (n := sum(same[i : i + window])) >= need]
    if not found:
        return None
    return lo + found[0][0], lo + found[-1][0] + window - 1, max(n for _, n in found)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item id, first_word, last_word, agreeing): which documents hold passages of which items.

    Words are runs of ASCII letters and digits (lower-cased) and non-ASCII characters. A row says that every window
    of 12 words that agrees with the item in 10 or more places lies between ``first_word`` and ``last_word`` (counted
    from 0), and how many places agree in the best one. Items of 6 to 11 words must occur whole and unchanged;
    shorter ones are no evidence and never reported. Null and empty texts have no words. Rows that share an id, or have none,
    are reported as one document (or item), but each is compared by itself and an item row has its own length. Other
    columns are not looked at; empty tables give no rows.

    The items' seeds pass through a filter of fixed size, so that documents send only seeds that are very
    likely an item's to the join. The join itself is by hash: a passage in a third of all documents is a key like
    others, which Spark splits, and pairs are reduced before they are shuffled again.
    """
    if id_col == item_col:
        raise ValueError("documents and items need different id columns")
    known = stage(seeds(items, item_col, item_text_col).filter(F.col("size") >= SHORTEST), "item_seeds")
    bits = docs.sparkSession.sparkContext.broadcast(seed_filter(known))
    hits = seeds(docs, id_col, text_col, bits).drop("size")
    known = known.select(
        "hash",
        F.col("id").alias("item"),
        F.col("before").alias("item_before"),
        F.col("context").alias("item_context"),
        "size",
    )
    met = hits.join(known, "hash").select("id", "at", "before", "context", "item", "item_before", "item_context", "size")
    schema = T.StructType(
        [T.StructField(id_col, id_type(docs, id_col)), T.StructField(item_col, id_type(items, item_col))]
        + [T.StructField(c, T.LongType()) for c in ("first_word", "last_word", "agreeing")]
    )

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                doc, item = r["context"].split(" "), r["item_context"].split(" ")
                if found := overlap(doc, r["before"], item, r["item_before"], r["size"]):
                    rows.append((r["id"], r["item"], r["at"] + found[0], r["at"] + found[1], found[2]))
            columns = zip(*rows, strict=True) if rows else [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, out, strict=True)], schema=out)

    verified = met.mapInArrow(verify, schema)
    return verified.groupBy(id_col, item_col).agg(
        F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("agreeing").alias("agreeing")
    )


def drop_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents whose id ``found`` does not name: all rows of one id, or without one, go or stay together.

    ``keep_clean`` decides for each row.
    """
    name = fresh(docs, "_bad")
    bad = found.select(F.col(id_col).alias(name)).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(F.col(name)), "left_anti")


def keep_clean(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose own text holds no passage of any item, whatever other rows share their id or lack one.

    Rows are told apart by the SHA-256 of their text: equal texts hold the same passages.
    """
    key = fresh(items, fresh(docs, "_text_key"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    keyed = docs.withColumn(key, F.sha2(text.cast("binary"), 256))
    found = contamination(keyed, items, key, text_col, item_col, item_text_col)
    return drop_contaminated(keyed, found, key).drop(key)


def contamination_sql() -> str:
    """DuckDB SQL for ``contamination`` of ``documents`` by ``benchmark``, without seeds: it lines up all equal words."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    need = WINDOW - SUBSTITUTIONS
    counts = ", ".join(
        f"count(*) OVER (PARTITION BY doc_id, item_id, d ORDER BY p RANGE BETWEEN CURRENT ROW AND w - 1 - {k} FOLLOWING) AS n{k}"
        for k in range(SUBSTITUTIONS + 1)
    )
    found = " UNION ALL ".join(
        f"SELECT doc_id, item_id, p - {k} AS first, p - {k} + w - 1 AS last, n{k} AS n FROM m WHERE n{k} >= need "
        f"AND p - {k} >= 0 AND p - {k} - d >= 0 AND p - {k} + w <= doc_n AND p - {k} - d + w <= item_n AND (w = {WINDOW} OR {k} = 0)"
        for k in range(SUBSTITUTIONS + 1)
    )
    return f"""
WITH dw AS (SELECT doc_id, {words} AS ws FROM documents), iw AS (SELECT item_id, {words} AS ws FROM benchmark),
x AS (SELECT doc_id, len(ws) AS doc_n, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM dw),
y AS (SELECT item_id, len(ws) AS item_n, unnest(ws) AS word, unnest(range(len(ws))) AS q FROM iw WHERE len(ws) >= {SHORTEST}),
e AS (
    SELECT doc_id, item_id, doc_n, item_n, p, p - q AS d, least({WINDOW}, item_n) AS w,
           CASE WHEN item_n >= {WINDOW} THEN {need} ELSE item_n END AS need
    FROM x JOIN y USING (word)
), m AS (SELECT *, {counts} FROM e)
SELECT doc_id, item_id, min(first) AS first_word, max(last) AS last_word, max(n) AS agreeing
FROM ({found}) GROUP BY doc_id, item_id
"""
