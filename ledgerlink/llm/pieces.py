"""SentencePiece encoding with byte spans of the original text, and decoding.

Text is normalised by the longest prefix found in the model's compiled character map, and
for every normalised byte the place it came from is kept. Pieces are merged on the normalised text and
projected back to the bytes they cover.
"""

from __future__ import annotations

import codecs
import re
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlink.llm.common import WordTable, by_text, per_text, sums_by_text
from ledgerlink.llm.ragged import PairTable, merge_all

SPACE = "▁"
SPACE_BYTES = SPACE.encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class CharsMap:
    """The compiled character map: a double-array trie of prefixes and the texts they become.

    Layout: the trie's size in bytes, its 32-bit units, then null-ended replacements.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text[at:]``."""
        units, found = self.units, None
        pos = self._offset(units[0])
        for i in range(at, len(text)):
            pos ^= text[i]
            if pos >= len(units) or units[pos] & 0x800000FF != text[i]:
                break
            unit = units[pos]
            pos ^= self._offset(unit)
            if unit & 0x100:
                start = units[pos] & 0x7FFFFFFF
                found = (i + 1 - at, start)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


class PieceModel:
    """Read from the bytes of a BPE model with byte fallback; raises for kinds it does not cover."""

    def __init__(self, blob: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        kinds = [p.type for p in proto.pieces]
        inner = any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces if p.type == NORMAL)
        covered = (
            spec.model_type == spec.BPE
            and spec.byte_fallback
            and {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE}
            and norm.escape_whitespaces
            and not spec.treat_whitespace_as_suffix
            and not inner
            and not proto.denormalizer_spec.precompiled_charsmap
        )
        if not covered:
            raise ValueError("this model is of a kind that is not covered")
        self.charsmap = CharsMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        self.bos, self.eos = spec.bos_id, spec.eos_id
        self.size = len(kinds)
        vocab = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self._index(vocab, [p.score for p in proto.pieces])
        surface = {CONTROL: b"", UNKNOWN: spec.unk_surface.encode()}
        self.decoded = [
            bytes([int(p.piece[1:-1], 16)])
            if p.type == BYTE
            else surface.get(p.type, p.piece.replace(SPACE, " ").encode())
            for p in proto.pieces
        ]
        self.silent = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.spaced = {i for p, i in vocab.items() if p.startswith(SPACE)}
        self.table_of_words = WordTable(b" ", 12, "<u4", bits=20)

    def _index(self, vocab: dict[str, int], score: list[float]) -> None:
        left, right, rank, merged = [], [], [], []
        place = {s: r for r, s in enumerate(sorted({score[i] for i in vocab.values()}, reverse=True))}
        self.norm_width = np.zeros(self.size, np.int64)
        self.norm_width[list(self.byte_id.values())] = 1
        self.raw_width = self.norm_width.copy()
        self.top_byte = max(self.byte_id.values()) + 1
        for piece, i in vocab.items():
            self.norm_width[i] = len(piece.encode())
            self.raw_width[i] = self.norm_width[i] - 2 * piece.count(SPACE)
            for cut in range(1, len(piece)):
                a, b = vocab.get(piece[:cut]), vocab.get(piece[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(place[score[i]])
                    merged.append(i)
        self.table = PairTable(left, right, rank, merged)
        self.char = np.arange(0x110000, dtype=np.int32) + self.size  # unknown: size + code point
        for piece, i in vocab.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i

    @cached_property
    def pairs(self) -> dict:
        return self.table.pairs()

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) its offset in ``text``."""
        out, came = [], []

        def put(piece: bytes, at: int) -> None:
            out.append(piece)
            came.extend([at] * len(piece))

        def step(at: int) -> tuple[int, bytes]:
            if self.charsmap and (found := self.charsmap.longest(text, at)):
                return found
            lead = text[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return width, text[at : at + width]

        at = 0
        if self.squeeze:
            while at < len(text) and not (piece := step(at))[1].strip(b" "):
                at += piece[0]
        if at == len(text):
            return b"", np.array([at])
        if self.prefix:
            put(SPACE_BYTES, at)
        after_space = self.squeeze
        while at < len(text):
            width, piece = step(at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                # A replacement comes from one prefix as a whole.
                put(piece.replace(b" ", SPACE_BYTES), at)
                after_space = self.squeeze and piece.endswith(b" ")
            at += width
        if self.squeeze:
            while out and b"".join(out).endswith(SPACE_BYTES):
                whole = b"".join(out)[: -len(SPACE_BYTES)]
                at = came[len(whole)]
                out, came = [whole], came[: len(whole)]
        return b"".join(out), np.array([*came, at])

    def _merge(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many pieces each segment of normalised text has, and all ids; unknown characters become their bytes."""
        text = b"".join(segments).decode()
        lengths = np.array([len(s.decode()) for s in segments], np.int64)
        flat = self.char[np.frombuffer(text.encode("utf-32-le"), "<u4")].astype(np.int64)
        flat, lengths = merge_all(flat, lengths, self.table, lambda: self.pairs, leftmost=True)
        unknown = flat >= self.size
        if unknown.any():
            each = [chr(c - self.size).encode() for c in flat[unknown].tolist()]
            repeat = np.ones(len(flat), np.int64)
            repeat[unknown] = [len(b) for b in each]
            lengths = sums_by_text(repeat, lengths)
            flat, spread = np.repeat(flat, repeat), np.repeat(unknown, repeat)
            flat[spread] = [self.byte_id[b] for b in b"".join(each)]
        return lengths, flat.astype("<u4")

    def _ends(self, ids: np.ndarray, text: bytes, came: np.ndarray | None) -> np.ndarray:
        """Where in ``text`` each piece ends; of a character's bytes only the last one covers it."""
        if came is not None:
            return came[np.cumsum(self.norm_width[ids])]
        ends = np.cumsum(self.raw_width[ids]) - 1  # the space before the first word is not in the text
        if (ids < self.top_byte).any():
            raw = np.frombuffer(text + b"\0", np.uint8)
            start = np.maximum.accumulate(np.where(raw & 0xC0 != 0x80, np.arange(len(raw)), 0))
            ends = start[ends]
        return ends

    def encode(self, texts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Ids (with begin and end) and the end offset of every piece, as little-endian 32-bit arrays."""
        inner: list = [np.zeros(0, "<u4")] * len(texts)
        places: list = [None] * len(texts)
        # Most texts are words with one space between: their segments are the words and the space before.
        usual = self.charsmap is None and not self.squeeze and self.prefix
        words = [i for i, t in enumerate(texts) if usual and t and SPACE_BYTES not in t and b"  " not in t + b" " and t[:1] != b" "]
        if words:
            per_text, n, flat = self.table_of_words.look_up(
                [texts[i] for i in words], lambda new: self._merge([SPACE_BYTES + w for w in new])
            )
            for i, (a, b) in zip(words, by_text(sums_by_text(n, per_text)), strict=True):
                inner[i] = flat[a:b]
        for i in sorted({*range(len(texts))} - {*words}):
            norm, places[i] = self.normalise(texts[i])
            segments = [s.encode() for s in SEGMENT.findall(norm.decode())]
            if segments:
                inner[i] = self._merge(segments)[1]
        begin = np.full(int(self.bos >= 0), self.bos, "<u4")
        end = np.full(int(self.eos >= 0), self.eos, "<u4")
        ids, ends = [], []
        for text, pieces, came in zip(texts, inner, places, strict=True):
            ids.append(np.concatenate([begin, pieces, end]).tobytes())
            edges = [begin * 0, self._ends(pieces, text, came), end * 0 + len(text)]
            ends.append(np.concatenate(edges).astype("<u4").tobytes())
        return ids, ends

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids; every byte that is no valid UTF-8 becomes U+FFFD."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        whole = b"".join(map(self.decoded.__getitem__, numbers))
        first = next((i for i in numbers if i not in self.silent), None)
        if self.prefix and first in self.spaced:
            whole = whole[1:]
        return whole.decode("utf-8", "each_byte")


@lru_cache(maxsize=2)
def piece_model(blob: bytes) -> PieceModel:
    """One per Python worker, with its cache of segments."""
    return PieceModel(blob)


def _sent(df: DataFrame, model: str):
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, ends) of every row, begin and end ids included.

    ``ids`` and ``ends`` are little-endian 32-bit arrays; piece i covers the bytes from ``ends[i - 1]`` to
    ``ends[i]`` of the original text. Null and empty texts have the begin and end ids only; repeated rows are
    encoded each; other columns are not looked at. ``model`` is a path the driver reads (a vocabulary has a
    fixed size). Segments between spaces are merged once and kept, up to a fixed number.
    """
    blob = _sent(docs, model)
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("ends", T.BinaryType())]
    out = per_text(docs, id_col, text_col, fields, lambda texts: piece_model(blob.value).encode(texts))
    n = (F.octet_length("ids") / 4).cast("long")
    return out.select(id_col, n.alias("n_tokens"), "ids", "ends")


def round_trip(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", out_col: str = "decoded"
) -> DataFrame:
    """(id, n_tokens, ids, ends, decoded) of every row: ``encode_pieces``, and the text of those ids."""
    blob = _sent(docs, model)
    binary = [T.StructField("ids", T.BinaryType()), T.StructField("ends", T.BinaryType())]

    def columns(texts: list[bytes]):
        known = piece_model(blob.value)
        ids, ends = known.encode(texts)
        return ids, ends, [known.decode(x) for x in ids]

    out = per_text(docs, id_col, text_col, [*binary, T.StructField(out_col, T.StringType())], columns)
    return out.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "ends", out_col)


def decode_pieces(
    encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids", out_col: str = "decoded"
) -> DataFrame:
    """(id, ids, decoded) of every row; null ids give an empty text."""
    blob = _sent(encoded, model)
    schema = T.StructType(
        [encoded.schema[id_col], T.StructField(ids_col, T.BinaryType()), T.StructField(out_col, T.StringType())]
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            model = piece_model(blob.value)
            texts = [model.decode(x.as_py() or b"") for x in batch.column(1)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, ids_col, out_col])

    return encoded.select(id_col, F.col(ids_col)).mapInArrow(run, schema)
