"""Licence scans: phrases, and templates with optional and replaceable regions as token automata.

Template markup, over words: ``[[ ... ]]`` may be missing, ``{{a b|c}}`` is one of the given
wordings, ``{{2..6}}`` is any 2 to 6 words; regions nest. All other words are mandatory and must
stand exactly as written, one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlink.llm.common import per_text
from ledgerlink.llm.notices import NOTICES

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

TEMPLATES = NOTICES


def word_bytes() -> bytes:
    """Byte table: A-Z in lower case, word bytes kept, every other byte a space."""
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray(b" " * 256)
    for b in keep:
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


WORD_BYTES = word_bytes()
ANY = None
_PART = re.compile(r"\[\[|\]\]|\{\{|\}\}|\||[^\s\[\]{}|]+")


@dataclass(frozen=True)
class Automaton:
    """States are numbered; 0 starts and ``end`` accepts.

    ``steps[s]`` lists (word or any, next state); ``free[s]`` the states reached without a word.
    """

    steps: tuple
    free: tuple
    end: int
    mandatory: tuple[bytes, ...]

    def closure(self, states) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def accepts_at(self, words: list[bytes], start: int) -> bool:
        """Whether some run of words that begins at ``start`` is the template."""
        states = self.closure([0])
        for word in words[start:]:
            if self.end in states:
                return True
            states = self.closure({t for s in states for w, t in self.steps[s] if w is ANY or w == word})
            if not states:
                return False
        return self.end in states

    def first_words(self) -> set | None:
        """Words an accepted run can begin with; None if any word can."""
        words = {w for s in self.closure([0]) for w, _ in self.steps[s]}
        return None if ANY in words else words


def compile_template(markup: str) -> Automaton:
    """The markup as an automaton; raises on unbalanced regions or a template without mandatory words."""
    parts = _PART.findall(markup)
    steps: list[list] = [[]]
    free: list[list] = [[]]
    mandatory: list[list[bytes]] = [[]]
    at = 0

    def state() -> int:
        steps.append([])
        free.append([])
        return len(steps) - 1

    def run(start: int, closing: str | None, top: bool) -> int:
        """Reads alternatives up to ``closing``; the state after them."""
        nonlocal at
        here, ends = start, []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part == closing:
                break
            if part == "|" and closing:
                ends.append(here)
                here = start
            elif part in ("[[", "{{"):
                mandatory.append([])
                entry = state()
                free[here].append(entry)
                span = re.fullmatch(r"(\d+)\.\.(\d+)", parts[at]) if part == "{{" else None
                if span:
                    at += 2
                    least, most = map(int, span.groups())
                    out, now = state(), entry
                    for k in range(most + 1):
                        if k >= least:
                            free[now].append(out)
                        if k < most:
                            new = state()
                            steps[now].append((ANY, new))
                            now = new
                    here = out
                else:
                    after = run(entry, "]]" if part == "[[" else "}}", False)
                    if part == "[[":
                        free[entry].append(after)
                    here = after
                mandatory.append([])
            elif part in ("]]", "}}", "|"):
                raise ValueError(f"unbalanced template: {markup}")
            else:
                new = state()
                steps[here].append((part.encode(), new))
                if top:
                    mandatory[-1].append(part.encode())
                here = new
        else:
            if closing:
                raise ValueError(f"unbalanced template: {markup}")
        out = state()
        for e in [*ends, here]:
            free[e].append(out)
        return out

    end = run(0, None, True)
    longest = max(mandatory, key=len)
    if not longest:
        raise ValueError(f"no mandatory words: {markup}")
    return Automaton(tuple(map(tuple, steps)), tuple(map(tuple, free)), end, tuple(longest))


def places(spaced: bytes, phrase: bytes) -> list[int]:
    """Word positions of a phrase in words that each follow a space and are ended by one."""
    found, at = [], spaced.find(phrase)
    while at >= 0:
        found.append(spaced.count(b" ", 0, at))
        at = spaced.find(phrase, at + 1)
    return found


class Scanner:
    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.automata = []
        for label, markup in templates.items():
            a = compile_template(markup)
            anchor = b" " + b" ".join(a.mandatory) + b" "
            self.automata.append((label, a, anchor, a.first_words()))

    def scan(self, text: bytes):
        """(words, base places, first, last, base labels, labels, score) of one text."""
        words = text.translate(WORD_BYTES).split()
        spaced = b" " + b" ".join(words) + b" "
        starts, base = [], set()
        for phrase, label in self.phrases:
            if found := places(spaced, phrase):
                starts += found
                base.add(label)
        own = set()
        for label, automaton, anchor, first in self.automata:
            if anchor in spaced:
                begins = (i for i, w in enumerate(words) if first is None or w in first)
                if any(automaton.accepts_at(words, i) for i in begins):
                    own.add(label)
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | own)),
            1.0 if own else 0.5 if base else 0.0,
        )


def license_scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence wording of every row.

    ``n_base`` counts all places of the phrases, ``first_word`` and ``last_word`` are the outermost of them
    (null without any). ``labels`` adds the templates that the text holds somewhere, mandatory wording exact.
    ``score`` is 1 with a whole template, 0.5 with phrases only, else 0. Null and empty texts have no words
    and no labels (empty strings); repeated rows are scanned each; other columns are not looked at.
    """
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
    scanner = Scanner(phrases, templates)

    def columns(texts: list[bytes]):
        return list(zip(*map(scanner.scan, texts), strict=True)) or [[] for _ in fields]

    return per_text(docs, id_col, text_col, fields, columns)


def template_regex(markup: str) -> str:
    """The template as a regular expression over " word word " for an independent check in SQL."""
    out, stack = "", []
    for part in _PART.findall(markup):
        if part in ("[[", "{{"):
            out += "(?:"
            stack.append(part)
        elif part in ("]]", "}}"):
            out += ")?" if stack.pop() == "[[" else ")"
        elif part == "|":
            out += "|"
        elif m := re.fullmatch(r"(\d+)\.\.(\d+)", part):
            out += f"(?: [^ ]+){{{m[1]},{m[2]}}}"
        else:
            out += " " + re.escape(part)
    return out + " "


def license_sql(phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES) -> str:
    """DuckDB SQL for ``license_scan`` over the view ``documents``."""
    lists = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(n_words), "
        f"lambda i: words[i + 1 : i + {len(p.split())}] = {p.split()!r})) AS place FROM w "
        f"WHERE contains(spaced, ' {p} ')"
        for p, label in phrases.items()
    )
    own = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' FROM w WHERE regexp_matches(spaced, '{template_regex(markup)}')"
        for label, markup in templates.items()
    )
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH raw AS (
    SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), w AS (SELECT *, len(words) AS n_words, ' ' || array_to_string(words, ' ') || ' ' AS spaced FROM raw),
hits AS ({lists}),
base AS (
    SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
           list(DISTINCT label) AS found FROM hits GROUP BY doc_id
), own AS (SELECT doc_id, list(DISTINCT label) AS more FROM ({own}) AS t(doc_id, label) GROUP BY doc_id)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_concat(coalesce(found, []), coalesce(more, []))), ','), '') AS labels,
       CASE WHEN more IS NOT NULL THEN 1.0 WHEN found IS NOT NULL THEN 0.5 ELSE 0.0 END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""
