"""Text treatment of a word-end BPE tokenizer file: chunks of text to pre-tokens and symbols.

A token never crosses white space, so a text is cut at ASCII white space into chunks and
each distinct chunk is worked on once.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from ledgerlink.llm.common import WordTable
from ledgerlink.llm.ragged import PairTable, merge_all

# Characters whose case and category are the same in every Unicode version and that NFC keeps.
PLAIN = re.compile("[!-~¡-¬®-ɏ]+")
PLAIN_LINES = re.compile("[\n!-~¡-¬®-ɏ]*")
SPACES = b" \t\n\r\x0b\x0c"
# One mark between an ASCII letter and white space is a pre-token of its own.
MARK = re.compile(rb"([.,!?])(?<=[a-z].)(?=\s|$)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def fold_case(text: bytes) -> bytes:
    """The text with fewer different chunks and the same tokens: ASCII letters lowered, single marks apart.

    Left as it is where that could alter the result: special tokens are matched as written, and combining marks
    (which begin with these bytes) are composed before letters are lowered.
    """
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    return MARK.sub(rb" \1", text.lower())


class WordBpe:
    """Read from the bytes of a tokenizer file; raises if the file treats text another way."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, mapped = spec["pre_tokenizer"]["pretokenizers"]
        suffix = model["end_of_word_suffix"]
        known = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
            and (mapped["type"], mapped["add_prefix_space"], mapped["use_regex"]) == ("ByteLevel", False, False)
            and suffix
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"])
        )
        if not known:
            raise ValueError("this tokenizer file treats text in a way that is not covered")
        self.library = Tokenizer.from_str(blob.decode())
        self.split = regex.compile(split["pattern"]["Regex"])
        self.lines = regex.compile(split["pattern"]["Regex"] + "|\n")
        self.special = {a["content"].encode(): a["id"] for a in spec["added_tokens"]}
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")")
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.vocab = model["vocab"]
        self.inner = np.array([self.vocab[c] for c in self.letters], np.int64)
        self.last = np.array([self.vocab[c + suffix] for c in self.letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = PairTable(
            [self.vocab[a] for a, _ in merges],
            [self.vocab[b] for _, b in merges],
            range(len(merges)),
            [self.vocab[a + b] for a, b in merges],
        )
        self.tables: dict[str, WordTable] = {}

    def pretokens(self, chunk: bytes) -> list[bytes | int]:
        """Pre-tokens of any chunk as bytes, special tokens as their ids, by the library's own steps."""
        out: list[bytes | int] = []
        for part in self.special_at.split(chunk):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.library.normalizer.normalize_str(part.decode())
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    out.append(bytes(self.byte_of[c] for c in piece))
        return out

    def plain_pretokens(self, chunks: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Pre-tokens of plain chunks, with a line end between any two, and how many each chunk has."""
        found = self.lines.findall(b"\n".join(chunks).decode().lower())
        at = np.flatnonzero(np.fromiter((t == "\n" for t in found), bool, len(found)))
        counts = np.diff(np.r_[-1, at, len(found)]) - 1
        return "\n".join([t for t in found if t != "\n"]).encode(), counts

    def plain(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        """Places of the chunks that are plain text without special tokens, and of the others."""
        joined = b"\n".join(chunks)
        if b"<|" not in joined and PLAIN_LINES.fullmatch(joined.decode()):
            return list(range(len(chunks))), []
        flags = [b"<|" not in c and PLAIN.fullmatch(c.decode()) is not None for c in chunks]
        return [i for i, f in enumerate(flags) if f], [i for i, f in enumerate(flags) if not f]

    def counts(self, lines: bytes) -> np.ndarray:
        """Tokens of each pre-token of some lines: the symbols that survive merging."""
        raw = np.frombuffer(lines, np.uint8)
        cut = np.flatnonzero(raw == 10)
        lengths = np.diff(np.r_[-1, cut, len(raw)]) - 1
        raw = np.delete(raw, cut)
        flat = self.inner[raw]
        end = np.cumsum(lengths) - 1
        flat[end] = self.last[raw[end]]
        return merge_all(flat, lengths, self.table, lambda: self.pairs, leftmost=False)[1]

    def words(self, texts: list[bytes], make, width: int = 0, dtype: str = "<u4"):
        """``WordTable.look_up`` of the chunks of some texts."""
        table = self.tables.setdefault(f"{width} {dtype}", None) or WordTable(SPACES, width, dtype)
        self.tables[f"{width} {dtype}"] = table
        return table.look_up([fold_case(t) for t in texts], make)

    @cached_property
    def pairs(self) -> dict:
        return self.table.pairs()


@lru_cache(maxsize=2)
def word_bpe(blob: bytes) -> WordBpe:
    """One per Python worker, with its tables of chunks."""
    return WordBpe(blob)
