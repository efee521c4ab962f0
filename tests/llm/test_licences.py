"""Licence scans against plain Python, and expressions by hand."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import licences

PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def base_brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if tuple(words[i:i + len(phrase)]) == phrase]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


HARD = ["CC BY", "cc-by cc by\ncc", "CC BY CC BY", "ALL Rights_Reserved, all rights reserved", "gnu general public licenses", "general public license" * 3,
        "général public license general public license", "Kcc by", "a\x00cc by\x7fby", "all all rights rights reserved reserved", "", " ", "ccby", "İcc by",
        "all rights reserved general public license cc by", "general public license " * 500, "\U0001f600 cc by \U0001f600"]


def test_base_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    hard = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    both = docs.union(hard)
    want = {r.doc_id: base_brute(r.text) for r in both.collect()}
    got = licences.licence_scan(both).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id], r
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels == ",".join(sorted(set(r.labels.split(","))))


@pytest.mark.parametrize("text, freedom, labels", [
    ("mit", 0.9, "mit"), ("mit or gpl-3.0 and agpl-3.0", 0.9, "agpl gpl mit"), ("(mit or gpl-3.0) and agpl-3.0", 0.3, "agpl gpl mit"),
    ("gpl-2.0-only with classpath-exception-2.0", 0.7, "gpl"), ("gpl-2.0 with x and mit", 0.7, "gpl mit"),
    ("mit and cc0-1.0 or agpl-3.0", 0.9, "agpl cc0 mit"), ("mit or", 0.9, "mit"), ("mit or later", 0.9, "mit"), ("mit mit gpl", 0.9, "mit"),
    ("mit and (apache-2.0 or", 0.9, "apache mit"), ("mit and (", 0.9, "mit"), ("((bsd-3-clause))", 0.9, "bsd"), ("mit)", 0.9, "mit"), ('"isc"', 0.9, "isc"),
    ("licenseref-own or gplv3+", 0.5, "custom gpl"), ("cc-by-nc-sa-4.0", 0.2, "cc-by-nc-sa"), ("gpl with (mit)", 0.4, "gpl"), ("mit\nor gpl", 0.9, "mit"),
    ("lgpl-2.1-or-later.", 0.6, "lgpl")])
def test_expressions(text, freedom, labels):
    value = licences.parse(text)
    assert value.freedom == pytest.approx(freedom) and sorted(value.labels) == labels.split()


@pytest.mark.parametrize("text", ["", "()", "or mit", "unknown", ") mit", "with mit", "not-a-licence and mit"])
def test_no_expression(text):
    assert licences.parse(text) is None


def test_notices_and_tags():
    said = lambda t: (sorted(licences.scan(t).labels), round(licences.scan(t).score, 3))
    assert said("Licensed under CC BY-NC 4.0.") == (["cc-by", "cc-by-nc"], 0.2)
    assert said("GNU Lesser General Public License") == (["gpl", "lgpl"], 0.6)
    assert said("All rights reserved.") == (["reserved"], 0.0)
    assert said("All rights reserved. Released under the MIT License.") == (["mit", "reserved"], 0.9)
    assert said("// SPDX-License-Identifier: MIT OR GPL-3.0-only\n") == (["gpl", "mit"], 0.9)
    assert said("License: see below") == ([], 1.0) and said("nothing") == ([], 1.0)
    assert said("license: gpl\nlicense: agpl-3.0") == (["agpl", "gpl"], 0.3)


@pytest.mark.parametrize("unit", ["cc by ", "license: mit or ", "license: (", "license: mit-1", "SPDX-License-Identifier: ", "-1", "("])
def test_time_is_linear_in_the_text(unit):
    def seconds(n):
        text, begun = "license: mit" + unit * (n // len(unit)), time.perf_counter()
        licences.scan(text)
        return time.perf_counter() - begun
    seconds(10_000)
    assert seconds(2_000_000) < 40 * max(min(seconds(200_000) for _ in range(3)), 0.01)


def test_licence_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "cc by"), (4, "cc by"), (4, "cc by"), (5, "word " * 300_000 + "cc by")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("t", "labels", "score", "n_words", "notices")})
    got = licences.licence_scan(docs).collect()
    assert len(got) == len(rows) and [r.n_base for r in got if r.doc_id == 4] == [1, 1]
    assert [(r.first_word, r.n_words) for r in got if r.doc_id == 5] == [(300_000, 300_002)]
    assert {(r.n_words, r.first_word, r.labels, r.score) for r in got if r.doc_id in (1, 2, 3)} == {(0, None, "", 1.0)}
    assert licences.licence_scan(docs.limit(0)).collect() == []
