"""Token ids as flat files: unsigned integers, 64-bit document offsets and document ids beside them.

Each partition writes its own files, in document order. Where a partition starts in the whole
is the prefix sum of the sizes before it, so nothing is copied together.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import by_text, id_and_text, slices, sums_by_text
from ledgerlink.llm.wordbpe import WordBpe, word_bpe
from ledgerlink.staging import stage, stage_path

READ_DOCS = 1 << 14
# Ids of a chunk that are kept; longer chunks are encoded anew in every slice.
WIDTH = 8
MANIFEST = "place int, file string, dtype string, docs bigint, tokens bigint"


def chunk_ids(model: WordBpe, new: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each chunk has, and all ids: the library's model encodes the pre-tokens of plain chunks,
    the whole library the others."""
    encode = model.library.model.tokenize
    plain, odd = model.plain(new)
    each: list = [None] * len(new)
    sizes = np.zeros(len(new), np.int64)
    ids: list[int] = []
    if plain:
        lines, per_chunk = model.plain_pretokens([new[i] for i in plain])
        letters = {b: c for b, c in enumerate(model.letters) if b != 10}
        found = [[t.id for t in encode(p)] for p in lines.decode("latin-1").translate(letters).split("\n")]
        ids = list(chain.from_iterable(found))
        sizes[plain] = sums_by_text(np.fromiter(map(len, found), np.int64, len(found)), per_chunk)
    flat = np.array(ids, dtype)
    if odd:
        for i, (a, b) in zip(plain, by_text(sizes[plain]), strict=True):
            each[i] = flat[a:b]
        for i in odd:
            each[i] = np.array(model.library.encode(new[i].decode(), add_special_tokens=False).ids, dtype)
            sizes[i] = len(each[i])
        flat = np.concatenate(each)
    return sizes, flat


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, out_dir: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encodes every row and writes the files under ``out_dir``; returns their manifest.

    Rows stand in ascending order of id, then text; null ids come first, null texts are empty, and each row ends
    with ``end_id``. The manifest lists (place, file, dtype, docs, tokens, first_doc, first_token). File names
    differ between attempts of a task and the manifest names those of the attempt that counted, so lost
    executors and repeated tasks leave no wrong file in it. An empty table gives an empty manifest. ``out_dir`` must be
    reachable by every executor.
    """
    with open(tokenizer, "rb") as f:
        data = f.read()
    blob = docs.sparkSession.sparkContext.broadcast(data)
    largest = max([end_id, *json.loads(data)["model"]["vocab"].values()])
    dtype = "<u2" if largest < 1 << 16 else "<u4"
    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model = word_bpe(blob.value)
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(_uri(out_dir))
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        sizes: list[np.ndarray] = []
        files = None
        for batch in batches:
            for ids, texts in slices(batch):
                if files is None:
                    store.create_dir(root, recursive=True)
                    files = [store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("tokens", "docs")]
                per_text, n, flat = model.words(
                    texts, lambda new: chunk_ids(model, new, dtype), WIDTH, dtype
                )
                tokens = sums_by_text(n, per_text)
                files[0].write(np.insert(flat, np.cumsum(tokens), end_id).tobytes())
                files[1].write(np.array(ids.fill_null(-1 << 63).to_pylist(), "<i8").tobytes())
                sizes.append(tokens + 1)
        if files:
            for f in files:
                f.close()
            offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype("<i8")
            with store.open_output_stream(f"{root}/{name}.offsets") as f:
                f.write(offsets.tobytes())
            row = {"place": task.partitionId(), "file": f"{out_dir}/{name}", "dtype": dtype}
            row |= {"docs": len(offsets) - 1, "tokens": int(offsets[-1])}
            types = {"place": pa.int32(), "file": pa.string(), "dtype": pa.string(), "docs": pa.int64(), "tokens": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in types.items()], list(types))

    manifest = stage(ordered.mapInArrow(write, MANIFEST), "token_files")
    # One row per partition: small enough for one task.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    bases = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(a) for c, a in (("docs", "first_doc"), ("tokens", "first_token"))]
    return stage(manifest.select("*", *bases), "token_manifest")


def mapped(uri: str, dtype: str) -> np.ndarray:
    """A flat file as an array: mapped into memory where the store allows it, else read."""
    store, path = fs.FileSystem.from_uri(_uri(uri))
    if not store.get_file_info(path).size:
        return np.empty(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files.

    ``start`` counts the ids of all documents before it; the checksum is that of the ids as
    little-endian 32-bit integers.
    """
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in (id_col, "start", "n_tokens", "ids_crc32")]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = mapped(f"{row['file']}.tokens", row["dtype"])
                offsets, ids = mapped(f"{row['file']}.offsets", "<i8"), mapped(f"{row['file']}.docs", "<i8")
                for at in range(0, row["docs"], READ_DOCS):
                    upto = min(at + READ_DOCS, row["docs"])
                    edge = offsets[at : upto + 1].tolist()
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(edge, edge[1:], strict=False)]
                    start = np.array(edge[:-1]) + row["first_token"]
                    doc = pa.array(ids[at:upto].astype(np.int64), mask=np.asarray(ids[at:upto]) == -1 << 63)
                    columns = [doc, pa.array(start), pa.array(np.diff(edge)), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    # One task per file: rows this small would otherwise all be read by one.
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int, out_dir: str | None = None) -> DataFrame:
    """Writes the files (into a fresh folder of the shared store unless ``out_dir`` is given) and reads them back."""
    root = out_dir or stage_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer, end_id, root))
