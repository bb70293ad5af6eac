"""Language-model scores by prediction by partial matching over byte contexts, beside a unigram base.

The model is the byte-context trie of all training texts, held as tables: how often each byte followed each context
of 0 to ``ORDER`` bytes. A byte not seen in a context is escaped to the next shorter one (the escape counts as often as
there are distinct bytes there, method C) and the bytes of the longer context are excluded. A byte that follows
a context also follows its suffixes, so what is excluded is a sum per context and every gram has one code length.

No trie is ever in one place. Documents are packed into chunks of bounded size with the distinct grams and words each
uses; the tables are joined to those, and each chunk is scored beside the few code lengths it needs.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import WordTable, id_type, setting, slices, sums_by_text
from ledgerlink.llm.rules import fold
from ledgerlink.llm.wordbpe import SPACES
from ledgerlink.staging import stage

ORDER = 5
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 32 << 20
# A chunk ends before that if it has so many distinct grams or words (and what its last slice adds).
CHUNK_GRAMS, CHUNK_WORDS = 1 << 20, 1 << 19
# Slices whose counts are held apart until they are added up: few, as the sum needs several times their memory.
MERGE_AFTER = 4
SLICE_BYTES = 1 << 20
# All bytes but six kinds of white space, then the space between words and the end.
SYMBOLS = 252
END = b"\n"
GRAMS, WORDS, DOCS = 0, 1, 2
# Texts and packed rows go to Python in batches of so many bytes, not of 64 MB.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
CHUNK_FIELDS = "chunk bigint, kind int, gram bigint, word string, n bigint, docs binary"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def grams_of(streams: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram (context and byte) at every byte of some streams, and where each stream begins.

    A stream begins in the context of ends.
    """
    if not 1 <= order <= 6:
        raise ValueError("order: 1 to 6, so that a gram fits 64 bits")
    blob = b"".join([END * order + s for s in streams])
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    # Eight bytes from every place on, of which the first ``order + 1`` are the gram.
    windows = np.ndarray((len(blob) - order,), ">u8", blob + bytes(8), strides=(1,))
    gram = windows.astype(np.uint64) >> np.uint64(8 * (7 - order))
    begins = np.cumsum(lengths) - lengths
    keep = np.ones(len(gram), bool)
    after = (begins + lengths + order * np.arange(len(streams)))[:-1]
    for k in range(order):  # the next stream's padding is nobody's text
        keep[after + k] = False
    return gram[keep].view(np.int64), begins


def stream(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def _sum_by(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their sums. The keys come in a few sorted runs, which a merge sort uses.

    ``parts`` is emptied, and each array goes as soon as the next one is made.
    """
    if len(parts) == 1:
        return parts.pop()
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
    parts.clear()
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def give_back() -> None:
    """Memory that Arrow keeps for later goes back to the system: a worker shares its executor's."""
    pa.default_memory_pool().release_unused()


def _sum_words(parts: list[pa.Table]) -> pa.Table:
    """(word, n) with each word once."""
    whole = pa.concat_tables(parts).combine_chunks()
    return whole.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])


def _counted(words: list[bytes], weight: int) -> pa.Table:
    found = pc.value_counts(pa.array(words, pa.binary()))
    counts = found.field("counts")
    return pa.table({"word": found.field("values"), "n": counts if weight else pc.multiply(counts, 0)})


def packed_table(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue()


def unpacked_table(blob: pa.Buffer | bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def pack_docs(ids: pa.Array, held: pa.Array, texts: list[bytes]) -> bytes:
    return packed_table(pa.record_batch([ids, held, pa.array(texts, pa.binary())], ["id", "held", "text"]))


@dataclass
class Chunk:
    """What one chunk uses: distinct grams and words with their training counts (0: only held out).

    Both are arrays, added up every few slices.
    """

    order: int
    size: int = 0
    grams: list = field(default_factory=list)
    words: list = field(default_factory=list)

    def add(self, texts: list[bytes], held: list[bool]) -> list[bytes]:
        """Counts some texts and returns their streams."""
        cut = [tokens(t) for t in texts]
        streams = [stream(w) for w in cut]
        for some in (True, False):
            part = [w for w, h in zip(cut, held, strict=True) if h == some]
            if not part:
                continue
            own = [x for x, h in zip(streams, held, strict=True) if h == some]
            unique, n = np.unique(grams_of(own, self.order)[0], return_counts=True)
            self.grams.append((unique, np.zeros_like(n) if some else n))
            words = [w for ws in part for w in ws] + [END] * len(part)
            self.words.append(_counted(words, int(not some)))
        self.size += sum(map(len, texts))
        if len(self.grams) > MERGE_AFTER:
            self.grams, self.words = [self.merged()], [_sum_words(self.words)]
        return streams

    def full(self, most: int) -> bool:
        return self.size >= most or len(self.grams[0][0]) >= CHUNK_GRAMS or len(self.words[0]) >= CHUNK_WORDS

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        return _sum_by(self.grams)

    def rows(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        unique, n = self.merged()
        step = 1 << 17
        for at in range(0, len(unique), step):
            yield _rows(schema, number, GRAMS, gram=unique[at : at + step], n=n[at : at + step])
        del unique, n
        words = _sum_words(self.words)
        for part in words.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(step):
            yield _rows(schema, number, WORDS, word=part["word"], n=part["n"])


def _rows(schema: pa.Schema, number: int, kind: int, **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    given = {"chunk": np.full(size, number), "kind": np.full(size, kind, np.int32)} | columns
    ready = {k: v if isinstance(v, pa.Array) else pa.array(v, schema.field(k).type) for k, v in given.items()}
    made = [ready[f.name] if f.name in ready else pa.nulls(size, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def pack(docs: DataFrame, id_col: str, text_col: str, order: int, held: Column, chunk_bytes: int) -> DataFrame:
    """Rows of three kinds per chunk: its grams, its words, its documents in compressed slices."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(docs[id_col].alias("id"), text.alias("text"), held.alias("held"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = CHUNK_ARROW
        number = TaskContext.get().partitionId() << 24
        chunk = Chunk(order)
        for batch in batches:
            at = 0
            for ids, texts in slices(batch, SLICE_BYTES):
                part = batch.column(2).slice(at, len(texts))
                at += len(texts)
                streams = chunk.add(texts, part.to_pylist())
                yield _rows(schema, number, DOCS, docs=[pack_docs(ids, part, streams)])
                give_back()
                if chunk.full(chunk_bytes):
                    yield from chunk.rows(number, schema)
                    number, chunk = number + 1, Chunk(order)
        if chunk.grams:
            yield from chunk.rows(number, schema)

    return narrow.mapInArrow(run, CHUNK_FIELDS)


CHUNK_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("kind", pa.int32()),
        ("gram", pa.int64()),
        ("word", pa.string()),
        ("n", pa.int64()),
        ("docs", pa.binary()),
    ]
)


def _low(col: str, n_bytes: int) -> Column:
    return F.col(col).bitwiseAND(F.lit((1 << 8 * n_bytes) - 1))


def _context(col: str) -> Column:
    return F.shiftright(col, 8)


def code_lengths(grams: DataFrame, order: int) -> DataFrame:
    """(gram, value): log10 probability of the last byte of every distinct gram after the others.

    ``grams`` has (gram, n); n is its count in training texts, possibly 0. At most 252 grams share a context, and as many
    a suffix, so sums over these are windows of bounded size.
    """
    every = stage(grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    # Per level (contexts of j bytes): gram, its count n, and below, the count of its suffix one level down.
    levels: dict[int, DataFrame] = {}
    rows = every.filter("n > 0")
    for j in range(order, -1, -1):
        if j:
            shorter = _low("gram", j)
            rows = rows.withColumn("shorter", shorter)
            rows = rows.withColumn("m", F.sum("n").over(Window.partitionBy("shorter")))
            levels[j] = stage(rows, f"grams_{j}")
            # As many rows of a suffix as bytes come before it; they hold one sum.
            rows = levels[j].groupBy(F.col("shorter").alias("gram")).agg(F.max("m").alias("n"))
        else:
            levels[0] = stage(rows.withColumn("m", F.lit(0).cast("long")), "grams_0")

    def contexts(j: int) -> DataFrame:
        """(ctx, total, distinct, below): below is what the bytes seen here count one level down."""
        sums = [F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("m").alias("below")]
        return levels[j].groupBy(_context("gram").alias("ctx")).agg(*sums)

    # Every gram of a training text has its value at the first level; the others are open.
    own = Window.partitionBy("ctx")
    first = levels[order].withColumn("ctx", _context("gram")).select(
        "gram", "n", F.sum("n").over(own).alias("total"), F.count("*").over(own).alias("distinct")
    )
    done = [first.select("gram", F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("value"))]
    nothing = F.lit(0).cast("long")
    open_rows = every.filter("n = 0").select(
        "gram", F.lit(0.0).alias("value"), nothing.alias("out"), nothing.alias("seen")
    )
    for j in range(order, -1, -1):
        rows = open_rows.withColumn("g", _low("gram", j + 1)).withColumn("ctx", _context("g"))
        if j < order:
            rows = rows.join(levels[j].select(F.col("gram").alias("g"), F.col("n").alias("c")), "g", "left")
        else:
            rows = rows.withColumn("c", F.lit(None).cast("long"))
        rows = rows.join(contexts(j), "ctx", "left")
        left, new = F.col("total") - F.col("out"), F.col("distinct") - F.col("seen")
        all_of = left + new
        if j < order:
            found = rows.filter("c IS NOT NULL")
            done.append(found.select("gram", (F.col("value") + F.log10(F.col("c") / all_of)).alias("value")))
        escape = F.when(F.col("total").isNotNull() & (all_of > 0), F.log10(new / all_of)).otherwise(0.0)
        open_rows = rows.filter("c IS NULL").select(
            "gram",
            (F.col("value") + escape).alias("value"),
            F.coalesce("below", "out").alias("out"),
            F.coalesce("distinct", "seen").alias("seen"),
        )
        if j:
            open_rows = stage(open_rows, f"escaped_{j}")
    done.append(open_rows.select("gram", (F.col("value") - F.log10(F.lit(SYMBOLS) - F.col("seen"))).alias("value")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


class GramValues:
    """Values by gram for whole arrays; every gram asked for is known.

    A gram is looked for in its slot of one table, else in that of a second one, which holds those that lost their slot in the
    first, and the few that are in neither by bisection.
    """

    # The factor of each table's hash, and how many bits shorter its slots' numbers are than the first one's.
    TABLES = ((0x9E3779B97F4A7C15, 0), (0xC2B2AE3D27D4EB4F, 2))

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.value = gram[order], value[order]
        self.bits = max(10, int(len(gram)).bit_length() + 1)
        self.tables, left = [], np.arange(len(gram), dtype=np.int32)
        for k, (_, less) in enumerate(self.TABLES):
            slot, at = self._slot(self.gram[left], k), np.zeros(1 << self.bits - less, np.int32)
            at[slot] = left
            self.tables.append(at)
            left = left[at[slot] != left]

    def _slot(self, gram: np.ndarray, k: int) -> np.ndarray:
        factor, less = self.TABLES[k]
        return ((gram.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.bits + less)).view(np.int64)

    def find(self, gram: np.ndarray) -> np.ndarray:
        at = self.tables[0][self._slot(gram, 0)]
        other = np.flatnonzero(self.gram[at] != gram)
        lost = gram[other]
        again = self.tables[1][self._slot(lost, 1)]
        rest = np.flatnonzero(self.gram[again] != lost)
        again[rest] = np.searchsorted(self.gram, lost[rest])
        at[other] = again
        return self.value[at]


class WordCounts:
    """Training counts by word for whole slices, 0 for words that have none.

    A count is the corpus's, so what the small table keeps holds for every chunk; the others are searched in the chunk's words.
    """

    def __init__(self):
        self.table = WordTable(SPACES, 0, "<u4", bits=17)
        self.start()

    def start(self) -> None:
        self.parts: list[pa.Table] = []
        self.whole = self.words = self.counts = None

    def add(self, part: pa.Table) -> None:
        self.parts.append(part)

    def _of_new(self, new: list[bytes]) -> np.ndarray:
        if self.whole is None:
            empty = pa.table({"word": pa.array([], pa.binary()), "c": pa.array([], pa.int64())})
            self.whole, self.parts = pa.concat_tables([empty, *self.parts]).combine_chunks(), []
            self.words, self.counts = self.whole["word"].combine_chunks(), self.whole["c"].to_numpy()
        # Of the chunk's words and the slice's new ones (both without repeats) the latter are hashed: they are far fewer.
        at = pc.index_in(self.words, value_set=pa.array(new, pa.binary()))
        out = np.zeros(len(new), np.int64)
        out[at.drop_null().to_numpy()] = self.counts[at.is_valid().to_numpy(zero_copy_only=False)]
        return out

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(words of each text, count of each word)."""
        per_text, n, _ = self.table.look_up(texts, lambda new: (self._of_new(new) + 1, None))
        return per_text, n - 1


def score_slice(streams: list[bytes], grams: GramValues, words: WordCounts, ends: int, train: int, distinct: int, order: int):
    """(n_tokens, n_known, base_score, score) of each stream; ``ends`` is the training count of the end."""
    lengths, c = words.of(streams)
    size = train + distinct + 1
    base = sums_by_text(np.log10((c + 1) / size), lengths) + np.log10((ends + 1) / size)
    seen = sums_by_text((c > 0).astype(np.int64), lengths) + int(ends > 0)
    gram, begins = grams_of(streams, order)
    return lengths + 1, seen, base, np.add.reduceat(grams.find(gram), begins)


PACKED = "chunk bigint, kind int, docs binary"
PACKED_ARROW = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("docs", pa.binary())])
PACK_ROWS = 1 << 19


def packed_by_chunk(df: DataFrame, kind: int, pack_rows) -> DataFrame:
    """Rows (chunk, key, value) as one binary row per task and chunk, of at most ``PACK_ROWS`` rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            order = np.argsort(table["chunk"].to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            chunk = table["chunk"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                blob = pack_rows(table.slice(a, b - a))
                columns = [pa.array([chunk[a]], pa.int64()), pa.array([kind], pa.int32()), pa.array([blob], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=PACKED_ARROW)

        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size >= PACK_ROWS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return df.mapInArrow(run, PACKED)


def pack_values(rows: pa.Table) -> bytes:
    """Steps between sorted grams, and values, byte by byte of all numbers, compressed."""
    order = np.argsort(rows["gram"].to_numpy())
    gram, value = rows["gram"].to_numpy()[order], rows["value"].to_numpy()[order]
    both = np.stack([np.diff(gram, prepend=0), value.view(np.int64)])
    planes = np.ascontiguousarray(both.view(np.uint8).reshape(2, len(gram), 8).transpose(0, 2, 1))
    return np.int64(len(gram)).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack_values(blob: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    planes = np.frombuffer(pa.decompress(blob[8:], 16 * n, codec="zstd"), np.uint8)
    both = np.ascontiguousarray(planes.reshape(2, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(2, n)
    return np.cumsum(both[0]), both[1].view(np.float64)


def pack_counts(rows: pa.Table) -> bytes:
    return packed_table(pa.table({"word": rows["word"].cast(pa.binary()), "c": rows["c"].cast(pa.int64())}))


def ppm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Both models learn from the rows whose id is not in the held-out fold. ``score`` is the log10 probability of the text as
    its lower-cased words, one space between them, and an end. ``base_score`` is the add-one unigram
    model's over words and an end token. Null and empty texts are an end only; repeated rows count and are scored each; a null id
    counts as not held out; other columns are not looked at. With no training rows every byte is
    equally likely. Tasks hold one chunk's distinct grams and words at a time, not the corpus's.
    """
    with setting(docs.sparkSession, ARROW_BYTES, str(BATCH_BYTES)):
        return _scored(docs, id_col, text_col, order, chunk_bytes)


def _scored(docs: DataFrame, id_col: str, text_col: str, order: int, chunk_bytes: int) -> DataFrame:
    held = fold(id_col, FOLDS) == HELD_OUT
    packed = stage(pack(docs, id_col, text_col, order, held, chunk_bytes), "chunks")
    grams, words = packed.filter(f"kind = {GRAMS}"), packed.filter(f"kind = {WORDS}")
    values = code_lengths(grams.select("gram", "n"), order)
    vocabulary = words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0")
    vocabulary = stage(vocabulary, "vocabulary")
    end = F.max(F.when(F.col("word") == END.decode(), F.col("c")))
    totals = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), end.alias("e")).first()
    train, distinct, ends = totals.n, totals.v, totals.e or 0

    gram_rows = grams.select("chunk", "gram").join(values, "gram").select("chunk", "gram", "value")
    word_rows = words.select("chunk", "word").join(vocabulary, "word").select("chunk", "word", "c")
    together = packed_by_chunk(gram_rows, GRAMS, pack_values).union(packed_by_chunk(word_rows, WORDS, pack_counts))
    together = together.union(packed.filter(f"kind = {DOCS}").select("chunk", "kind", "docs"))
    together = together.repartition("chunk").sortWithinPartitions("chunk", "kind")
    longs = ("n_tokens", "n_known", "train_tokens")
    schema = T.StructType(
        [T.StructField(id_col, id_type(docs, id_col)), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in longs]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known, words = None, [], None, WordCounts()
        for batch in batches:
            chunks, kinds = batch.column("chunk").to_pylist(), batch.column("kind").to_pylist()
            for i, (chunk, kind) in enumerate(zip(chunks, kinds, strict=True)):
                # One row's bytes at a time, as a view of the batch.
                blob = batch.column("docs")[i].as_buffer()
                if chunk != now:
                    now, parts, known = chunk, [], None
                    words.start()
                    give_back()
                if kind == GRAMS:
                    parts.append(unpack_values(blob))
                elif kind == WORDS:
                    words.add(unpacked_table(blob))
                else:
                    if known is None:
                        gram, value = map(np.concatenate, zip(*parts, strict=True))
                        parts = []
                        give_back()
                        known = GramValues(gram, value)
                        del gram, value
                    rows = unpacked_table(blob)
                    made = score_slice(rows["text"].to_pylist(), known, words, ends, train, distinct, order)
                    columns = [rows["id"].combine_chunks(), rows["held"].combine_chunks()]
                    columns += [pa.array(x) for x in (made[0], made[1], np.full(len(rows), train), made[2], made[3])]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    return stage(together.mapInArrow(run, schema), "scores")
