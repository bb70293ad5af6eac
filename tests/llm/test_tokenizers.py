"""Token counts, token files and pieces against the tokenizer libraries."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from ledgerlink.llm.pieces import CharsMap, PieceModel, decode_pieces, encode_pieces, round_trip
from ledgerlink.llm.ragged import PairTable, merge_all, merge_long
from ledgerlink.llm.queries import QUERIES
from ledgerlink.llm.token_counts import token_counts
from ledgerlink.llm.token_files import read_token_files, write_token_files
from tests.llm.conftest import SF, wide

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def piece_library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture(scope="module")
def piece_model():
    with open(PIECE, "rb") as f:
        return PieceModel(f.read())


def word_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def strings(n, seed=5):
    rng = random.Random(seed)
    letters = "ab the in\n\t éÉöß😀AZ09.,!?'▁ś <|>"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["documents", "edges"])
def test_counts(request, name, both, word_library):
    df = request.getfixturevalue(name)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, WORD, limit=100).collect())
    want = Counter()
    for i, t in both[name]:
        n = len(word_ids(word_library, t))
        want[i, len((t or "").encode()), n, n > 100] += 1
    assert got == want


def test_counts_of_random_texts(spark, word_library):
    rows = list(enumerate(strings(1500)))
    got = {r.doc_id: r.n_tokens for r in token_counts(wide(spark, rows), WORD).collect()}
    assert got == {i: len(word_ids(word_library, t)) for i, t in rows}


def test_merging_in_blocks_equals_the_heap():
    rng = np.random.default_rng(3)
    left, right = rng.integers(0, 40, (2, 60))
    unique = sorted(set(zip(left.tolist(), right.tolist())))
    table = PairTable([a for a, _ in unique], [b for _, b in unique], range(len(unique)), [100 + i for i in range(len(unique))])
    seqs = [rng.integers(0, 40, rng.integers(1, 30)) for _ in range(400)]
    flat, lengths = np.concatenate(seqs), np.array([len(s) for s in seqs])
    for leftmost in (True, False):
        out, n = merge_all(flat.copy(), lengths, table, table.pairs, leftmost)
        got = [x.tolist() for x in np.split(out, np.cumsum(n)[:-1])]
        assert got == [merge_long(s.tolist(), table.pairs()) for s in seqs]


@pytest.mark.parametrize("name", ["documents", "edges"])
def test_token_files(request, name, both, word_library, tmp_path):
    df = request.getfixturevalue(name)
    manifest = write_token_files(df, WORD, 2, f"file://{tmp_path}/tokens")
    got = sorted(map(tuple, read_token_files(manifest).collect()), key=lambda r: r[1])
    at, want = 0, []
    for i, t in sorted(both[name], key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = [*word_ids(word_library, t), 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    # The files themselves, in order of place, are the ids of all documents.
    files = [r.file.removeprefix("file://") for r in manifest.orderBy("place").collect()]
    flat = np.concatenate([np.fromfile(f"{f}.tokens", "<u2") for f in files])
    assert len(flat) == at and (flat == 2).sum() >= len(want)


def test_token_files_of_no_rows(empty, tmp_path):
    manifest = write_token_files(empty, WORD, 2, str(tmp_path))
    assert manifest.count() == 0 and read_token_files(manifest).count() == 0
    assert token_counts(empty, WORD).count() == 0


@pytest.mark.parametrize("name", ["documents", "edges"])
def test_pieces(request, name, both, piece_library):
    got = Counter()
    for r in round_trip(request.getfixturevalue(name), PIECE).collect():
        got[r.doc_id, r.n_tokens, bytes(r.ids), r.decoded] += 1
    want = Counter()
    for i, t in both[name]:
        ids = piece_library.encode(t or "", add_bos=True, add_eos=True)
        want[i, len(ids), np.array(ids, "<u4").tobytes(), piece_library.decode(ids)] += 1
    assert got == want


def test_random_pieces_and_their_spans(piece_model, piece_library):
    texts = strings(1500, 9) + ["a b\x00 c", "  lead", "trail  ", "▁", "a▁b c"]
    ids, ends = piece_model.encode([t.encode() for t in texts])
    for t, i, e in zip(texts, ids, ends, strict=True):
        i = np.frombuffer(i, "<u4").tolist()
        assert i == piece_library.encode(t, add_bos=True, add_eos=True)
        proto = piece_library.encode(t, return_type="proto")
        assert np.frombuffer(e, "<u4").tolist() == [0, *[p.end for p in proto.pieces], len(t.encode())]


def test_decoding_of_any_ids(piece_model, piece_library):
    rng = random.Random(2)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(0, 32000), rng.randrange(3, 259)]) for _ in range(12)]
        assert piece_model.decode(np.array(ids, "<u4").tobytes()) == piece_library.decode(ids)


def test_encode_then_decode_frames(edges, empty):
    encoded = encode_pieces(edges, PIECE)
    decoded = decode_pieces(encoded, PIECE)
    whole = round_trip(edges, PIECE)
    assert Counter(r.decoded for r in decoded.collect()) == Counter(r.decoded for r in whole.collect())
    assert round_trip(empty, PIECE).count() == encode_pieces(empty, PIECE).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_map(rule):
    """A model with a compiled map: the longest prefix wins, as in the library."""
    off = {"add_dummy_prefix": False, "escape_whitespaces": False, "remove_extra_whitespaces": False}
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **off)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    charsmap = CharsMap(proto.normalizer_spec.precompiled_charsmap)
    texts = ["ﬁ Ａｂｃ ½ ㌔ é é ™ x", "가각 　wide", "①②③ ﷺ", "plain text", "ⅷ ß ẞ İ"]
    for text in texts:
        raw, at, out = text.encode(), 0, b""
        while at < len(raw):
            step = charsmap.longest(raw, at)
            if step is None:
                width = len(raw[at:].decode()[0].encode())
                step = (width, raw[at : at + width])
            at, out = at + step[0], out + step[1]
        assert out.decode() == library.normalize(text)


def test_alignment_with_a_character_map(piece_model):
    """Replacements point at the prefix they come from."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    with open(PIECE, "rb") as f:
        own = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    own.normalizer_spec.precompiled_charsmap = proto.normalizer_spec.precompiled_charsmap
    own.normalizer_spec.remove_extra_whitespaces = True
    blob = own.SerializeToString()
    model, full = PieceModel(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)
    for text in ["ﬁsh  Ａｂｃ ", " ½ cup", "x　 y  ", "", "   ", "é é ㌔"]:
        ids, ends = model.encode([text.encode()])
        assert np.frombuffer(ids[0], "<u4").tolist() == full.encode(text, add_bos=True, add_eos=True)
        spans = np.frombuffer(ends[0], "<u4").tolist()
        assert spans == sorted(spans) and spans[-1] == len(text.encode())


def test_registered_queries(spark, documents, word_library, piece_library):
    rows = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in QUERIES["op10_sentencepiece"](spark, SF).collect():
        ids = piece_library.encode(rows[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(piece_library.decode(ids).encode()).hexdigest()
        pieces = piece_library.encode(rows[r.doc_id], return_type="proto").pieces
        spans = [0, *[p.end for p in pieces], len(rows[r.doc_id].encode())]
        assert r.spans_sha256 == hashlib.sha256(np.array(spans, "<u4").tobytes()).hexdigest()
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, SF).collect()}
    files = QUERIES["op7_token_files"](spark, SF).select("doc_id", (F.col("n_tokens") - 1).alias("n")).collect()
    assert counts == {r.doc_id: r.n for r in files} == {i: len(word_ids(word_library, t)) for i, t in rows.items()}


def twins(n=1024):
    """Two words of ``n`` letters in the pattern of parities and its opposite, which sums of powers cannot tell apart."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("eq"[b] for b in bits), "".join("qe"[b] for b in bits)


ALIKE = [*twins(), *twins(16), "a" * 24, "a" * 25, "a" * 24 + "b", "a" * 24 + "c", "a" * 8 + "b" * 8, "b" * 8 + "a" * 8, "ab", "abc", "b", "bc", "ab\x00", "ab"]


@pytest.mark.parametrize("constant", [False, True])
def test_words_are_told_apart_by_their_bytes(constant, monkeypatch, word_library, piece_library):
    """Alike words, and all words under one hash: each still gets the library's result, also from a second slice."""
    from ledgerlink.llm.common import WordTable
    from ledgerlink.llm.ppm import WordCounts
    from ledgerlink.llm.token_files import WIDTH, chunk_ids
    from ledgerlink.llm.wordbpe import WordBpe

    if constant:
        monkeypatch.setattr(WordTable, "_hash", lambda self, keys, lengths: np.zeros(len(lengths), np.uint64))
    rng = random.Random(3)
    words = [*ALIKE, *("".join(rng.choice("abe") for _ in range(rng.randint(1, 30))) for _ in range(300))]
    texts = [" ".join(rng.choices(words, k=50)) for _ in range(20)] + [" ".join(ALIKE)]
    given = [t.encode() for t in texts]
    with open(WORD, "rb") as f:
        model = WordBpe(f.read())
    with open(PIECE, "rb") as f:
        pieces = PieceModel(f.read())
    counts = WordCounts()
    known = {w.encode(): i + 1 for i, w in enumerate(dict.fromkeys(words)) if i % 3}
    counts.add(pa.table({"word": pa.array(list(known), pa.binary()), "c": pa.array(list(known.values()), pa.int64())}))
    for _ in range(2):
        per_text, n, flat = model.words(given, lambda new: chunk_ids(model, new, "<u2"), WIDTH, "<u2")
        at = np.cumsum(np.r_[0, n])[np.cumsum(np.r_[0, per_text])]
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [word_ids(word_library, t) for t in texts]
        ids = [np.frombuffer(x, "<u4").tolist() for x in pieces.encode(given)[0]]
        assert ids == [piece_library.encode(t, add_bos=True, add_eos=True) for t in texts]
        per_text, c = counts.of(given)
        assert c.tolist() == [known.get(w, 0) for t in given for w in t.split()]


@pytest.mark.parametrize("query_name", ["op1_token_counts", "op7_token_files", "op10_sentencepiece"])
def test_alike_words_in_queries(spark, monkeypatch, query_name, word_library, piece_library):
    texts = [" ".join(ALIKE), " ".join(reversed(ALIKE)), *ALIKE, "x " * 1_200_000 + ALIKE[1]]  # the last is longer than a slice
    monkeypatch.setattr("ledgerlink.llm.queries.table", lambda *_: wide(spark, list(enumerate(texts))).coalesce(1))
    got = {r.doc_id: r for r in QUERIES[query_name](spark, "").collect()}
    for i, t in enumerate(texts):
        if query_name == "op10_sentencepiece":
            ids = piece_library.encode(t, add_bos=True, add_eos=True)
            assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert got[i].decoded_sha256 == hashlib.sha256(piece_library.decode(ids).encode()).hexdigest()
        else:
            ids = word_ids(word_library, t) + [2] * (query_name == "op7_token_files")
            assert got[i].n_tokens == len(ids)
            if query_name == "op7_token_files":
                assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
