"""Licence scans: identifier tags and notice phrases by Aho-Corasick, licence expressions by shunting-yard.

A text is lower-cased (A-Z) and cut into words, runs of digits, letters and everything beyond ASCII. One
automaton over the words joined by spaces finds the notice phrases. A second one, over the lower-cased
text as it stands, finds tags such as ``SPDX-License-Identifier:`` where the first has seen one; what follows a
tag is parsed as a licence expression of identifiers, ``and``, ``or``, ``with`` and parentheses.

An expression is worth the freedom it grants, from 0 (all rights reserved) to 1 (public domain): ``or``
lets the reader choose, so the freer side counts, ``and`` binds to both, so the stricter counts, and ``with``
adds an exception to a licence, which halves what it takes away. ``with`` binds closest, then ``and``, then
``or``. Reading stops at the first thing that cannot go on the expression; a part that is not complete is
dropped, so ``MIT or later`` is MIT. The score of a text is the least freedom that its phrases and
expressions grant; 0 if it has none but reserves all rights, 1 if it says nothing. A phrase inside a longer
one says nothing of its own (``lesser general public license``), but a base label stays.

Defined results: a null text counts as empty; a text without words or finds has empty labels and score 1;
the first and last place are null without one; places of phrases may overlap and all count; unknown
identifiers end an expression, ``LicenseRef-`` names go by the label ``custom`` with freedom 0.5; every row gives one
row, repeated rows included; a null id stays null; extra columns are ignored. Work is linear in the length of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import small
from tidemark.llm.registry import query
from tidemark.llm.text import whole

# The phrases of the base and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notices and their labels.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "isc license": "isc", "zlib license": "zlib",
    "boost software license": "bsl", "artistic license": "artistic", "mozilla public license": "mpl",
    "eclipse public license": "epl", "common development and distribution license": "cddl",
    "european union public licence": "eupl", "lesser general public license": "lgpl", "library general public license": "lgpl",
    "affero general public license": "agpl", "gnu free documentation license": "gfdl", "open font license": "ofl",
    "creative commons zero": "cc0", "cc0": "cc0", "public domain": "public-domain", "the unlicense": "unlicense",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc": "cc-by-nc", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd"}
# Identifiers in expressions, and their labels; a version may follow with a hyphen.
IDENTIFIERS = {
    "mit": "mit", "mit-0": "mit", "isc": "isc", "0bsd": "bsd", "bsd": "bsd", "apache": "apache", "zlib": "zlib", "bsl": "bsl", "artistic": "artistic",
    "unlicense": "unlicense", "cc0": "cc0", "mpl": "mpl", "epl": "epl", "cddl": "cddl", "eupl": "eupl", "lgpl": "lgpl", "gpl": "gpl",
    "agpl": "agpl", "gfdl": "gfdl", "ofl": "ofl", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd",
    "cc-by-nc": "cc-by-nc", "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd", "proprietary": "reserved", "none": "reserved"}
# The freedom of labels, from reserved to public domain.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "mit": 0.9, "isc": 0.9, "bsd": 0.9, "zlib": 0.9, "bsl": 0.9, "apache": 0.9,
    "artistic": 0.8, "cc-by": 0.8, "ofl": 0.7, "mpl": 0.7, "epl": 0.7, "cddl": 0.7, "eupl": 0.6, "lgpl": 0.6, "custom": 0.5, "cc-by-sa": 0.5, "gfdl": 0.4,
    "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2, "cc-by-nc-nd": 0.1, "reserved": 0.0}
# What an expression may follow.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")
_TAG_WORDS = ("spdx license identifier", "license expression", "license", "licence")
PRECEDENCE = {"with": 3, "and": 2, "or": 1}

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in _LOWER)
_TOKEN = re.compile(r"[ \t]*(?:([()])|([0-9a-z][0-9a-z.+-]*))")
_QUOTE = re.compile("[ \t\"']*")
_IDENTIFIER = re.compile(f"({'|'.join(sorted(IDENTIFIERS, key=len, reverse=True))})(?:-?v?[0-9][0-9.]*+|-only|-or-later|-clause|[+])*+")


@lru_cache(maxsize=1)
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    """Phrases over words, each between spaces, and tags over the text."""
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in (BASE | NOTICES).items():
        phrases.add_word(f" {phrase} ", (phrase.count(" ") + 1, len(phrase) + 1, label, phrase in BASE, False))
    for words in _TAG_WORDS:
        phrases.add_word(f" {words} ", (0, 0, "", False, True))
    for tag in TAGS:
        tags.add_word(tag, len(tag))
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def identified(token: str) -> str | None:
    """The label of an identifier, with or without a version."""
    if token.startswith("licenseref-"):
        return "custom"
    found = _IDENTIFIER.fullmatch(token)
    return IDENTIFIERS[found[1]] if found else None


@dataclass(frozen=True)
class Value:
    """What a part of an expression grants, and the labels in it."""

    freedom: float
    labels: frozenset[str]


def _apply(op: str, a: Value, b: Value) -> Value:
    if op == "with":
        return Value(1 - (1 - a.freedom) / 2, a.labels)
    return Value((max if op == "or" else min)(a.freedom, b.freedom), a.labels | b.labels)


def parse(text: str, at: int = 0) -> Value | None:
    """The value of the longest expression of lower-case ``text`` from ``at`` on; None if there is none.

    Shunting-yard: values wait on one stack, operators and open parentheses on another. An
    operand that comes where none may ends the reading; operators without a right side are dropped, and
    parentheses that are never closed end with the expression.
    """
    values: list[Value] = []
    waiting: list[tuple[str, int]] = []  # operator or parenthesis, values below it
    wanted, at = True, _QUOTE.match(text, at).end()

    def settle(least: int) -> None:
        while waiting and waiting[-1][0] != "(" and PRECEDENCE[waiting[-1][0]] >= least:
            op, _ = waiting.pop()
            b, a = values.pop(), values.pop()
            values.append(_apply(op, a, b))

    while found := _TOKEN.match(text, at):
        token = found[1] or found[2].rstrip(".")
        if token == "(":
            if not wanted or waiting and waiting[-1][0] == "with":
                break
            waiting.append(("(", len(values)))
        elif token == ")":
            if wanted:
                break
            settle(0)
            if not waiting:
                break
            waiting.pop()
        elif token in PRECEDENCE:
            if wanted:
                break
            settle(PRECEDENCE[token])
            waiting.append((token, len(values)))
            wanted = True
        elif wanted and waiting and waiting[-1][0] == "with":
            values.append(Value(1.0, frozenset()))  # the name of an exception
            wanted = False
        else:
            label = identified(token) if wanted else None
            if label is None:
                break
            values.append(Value(FREEDOM[label], frozenset((label,))))
            wanted = False
        at = found.end()
    while waiting:  # what is not complete goes, with its operator
        op, below = waiting.pop()
        if op == "(":
            del values[below + 1:]
        elif len(values) > below:
            b, a = values.pop(), values.pop()
            values.append(_apply(op, a, b))
    return values[0] if values else None


@dataclass
class Scan:
    """What a text holds; places are word numbers from 0."""

    n_words: int
    base_places: list[int]
    base_labels: set[str]
    labels: set[str]
    places: list[tuple[int, int, str]]
    score: float


def scan(text: str) -> Scan:
    """The notices and expressions of one text."""
    phrases, tags = automata()
    raw = text.encode("utf-8", "replace")
    words = raw.translate(_WORDS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    out, tagged, seen, number = Scan(len(words), [], set(), set(), [], 1.0), False, 0, 0
    for end, (size, length, label, base, tag) in phrases.iter(line):
        if tag:
            tagged = True
            continue
        number += line.count(" ", seen, end)  # spaces before the one that ends the phrase: its words are complete
        seen = end
        first = number - size
        out.places.append((first, first + size, label))
        if base:
            out.base_places.append(first)
            out.base_labels.add(label)
    said, last = set(), 0
    for _, end, label in sorted(out.places, key=lambda p: (p[0], -p[1])):
        if end > last:  # not inside a longer one
            said.add(label)
            last = end
    out.labels = out.base_labels | said
    granted = [FREEDOM[label] for label in said - {"reserved"}]
    if tagged:
        lower = raw.translate(_LOWER).decode("latin-1")
        for end, _ in tags.iter(lower):
            value = parse(lower, end + 1)
            if value is not None:
                out.labels |= value.labels
                granted.append(value.freedom)
    out.score = min(granted, default=0.0 if out.labels else 1.0)
    return out


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, ``notices`` (array of first word, end, label), base places and labels, all labels, score."""
    schema = ("doc_id long, n_words long, notices array<struct<first:bigint,end:bigint,label:string>>, base_places array<bigint>, "
              "base_labels array<string>, labels array<string>, score double")
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string())])),
             pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()]
    names = ["doc_id", "n_words", "notices", "base_places", "base_labels", "labels", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small(batches):
            found = [scan(t.as_py()) for t in rows.column(1)]
            columns = [[s.n_words for s in found], [[{"first": a, "end": b, "label": n} for a, b, n in s.places] for s in found],
                       [s.base_places for s in found], [sorted(s.base_labels) for s in found], [sorted(s.labels) for s in found],
                       [s.score for s in found]]
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds[1:])]], names=names)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), whole(docs[text_col]).alias("t")).mapInArrow(run, schema)


@query("op11_licence_scan")
def licence_scan(documents: DataFrame) -> DataFrame:
    joined = lambda c: F.array_join(c, ",")
    return scan_licences(documents).select(
        "doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"), F.array_min("base_places").alias("first_word"),
        F.array_max("base_places").alias("last_word"), joined("base_labels").alias("base_labels"), joined("labels").alias("labels"), "score")
