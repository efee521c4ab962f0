"""Markup that used to lose text, and time that grows with the length of one text only."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extract, pii, secrets
from tidemark.llm.text import outside


def said(page):
    return [text for text, _, _ in html_extract.blocks(page)]


@pytest.mark.parametrize("page, want", [
    ("<article><p class=it's>Hello</p><p>Second</p><p>More of it's text</p></article>", ["Hello", "Second", "More of it's text"]),
    ('<p>a<img alt="a"" src=x>b</p><p>c</p>', ["a", "b", "c"]),
    ("<p>x</p><svg><![CDATA[no text]]></svg><p>y</p>", ["x", "y"]),
    ('<p title="a > b">x</p><p title=\'c > d\'>y</p>', ["x", "y"]),
    ('<p title="open>one</p><p>two</p>', ["one", "two"]),
    ("<p>one</p><div data-x='it>two</div><p>three</p>", ["one", "two", "three"]),
    ("<p>one <b and no end", ["one <b and no end"]),
    ("<p>a < b and 1 <3</p>", ["a < b and 1 <3"]),
    ('<a b = "x>y" c>text</a><div\n class\n=\n"q">t2</div>', ["text", "t2"]),
    ("<P>one</p></div></q><p>two", ["one", "two"]),
    ("<p title=>x</p>", ["x"]),
])
def test_no_text_is_lost(page, want):
    got = said(page)
    assert got == want


UNITS = {"div": "<div>", "text": "<div>x ", "bold": "<b ", "less": "<", "quoted": '<a b="x>y" ', "open quote": "<a b='", "end": "<div></x>", "head": "<head>",
         "comment": "<!--", "script": "<script>", "paragraph": "<div><p></div></q>", "equals": "<a =", "inline": "<span>x", "list": "<li>x<td>y"}


@pytest.mark.parametrize("name", sorted(UNITS))
def test_blocks_take_time_in_proportion(name):
    def seconds(n):
        page, begun = UNITS[name] * (n // len(UNITS[name])), time.perf_counter()
        html_extract.blocks(page)
        return time.perf_counter() - begun
    seconds(10_000)
    assert seconds(1_000_000) < 30 * max(min(seconds(100_000) for _ in range(2)), 0.01)


def test_deep_nesting():
    begun = time.perf_counter()
    assert said("<div>" * 20_000 + "x" + "</div>" * 20_000 + "y") == ["x", "y"]
    assert time.perf_counter() - begun < 3


@pytest.mark.parametrize("kind", ["base64", "hex lines", "words"])
def test_secrets_in_one_long_text(spark, kind):
    """4 MB in one text take about as long a character as a tenth of it."""
    rng = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    line = {"base64": lambda: "".join(rng.choices(letters, k=1000)), "words": lambda: "plain_words_and_names joined " * 30,
            "hex lines": lambda: "".join(rng.choices("0123456789abcdef", k=40)) + " " + "".join(rng.choices(letters, k=40)) + "\n"}[kind]

    def seconds(n):
        text = ""
        parts, size = [], 0
        while size < n:
            parts.append(line())
            size += len(parts[-1])
        text = "".join(parts)
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).persist()
        docs.count()
        begun = time.perf_counter()
        row = secrets.secret_scan(docs).first()
        docs.unpersist()
        return time.perf_counter() - begun, row
    seconds(10_000)
    one, _ = seconds(400_000)
    ten, row = seconds(4_000_000)
    assert ten < 25 * max(one, 0.4), (one, ten)
    if kind == "hex lines":
        assert row.n_hex >= 40_000 and "random" in row.spans


@pytest.mark.parametrize("kind", ["groups", "phones", "mails"])
def test_personal_data_in_one_long_text(spark, kind):
    """A table of numbers as one text."""
    rng = random.Random(3)
    d = lambda k: f"{rng.randrange(10 ** k):0{k}d}"
    unit = {"groups": lambda: f"{d(2)} ", "phones": lambda: f"call {d(3)}-{d(3)}-{d(4)}\n", "mails": lambda: f"a{d(4)}@b.com "}[kind]

    def seconds(n):
        text = "".join(unit() for _ in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1).persist()
        docs.count()
        begun = time.perf_counter()
        row = pii.pii(docs).first()
        docs.unpersist()
        return time.perf_counter() - begun, row
    seconds(300)
    one, _ = seconds(1_500)
    ten, row = seconds(15_000)
    assert ten < 20 * max(one, 0.5), (one, ten)
    assert row.n_email == (15_000 if kind == "mails" else 0) and (kind != "phones" or row.spans.count("number_group") > 14_000)


def test_outside_equals_comparing_all(spark):
    rng = random.Random(9)
    rows = []
    for i in range(200):
        span = lambda: (lambda s: (s, s + rng.randint(1, 9)))(rng.randrange(60))
        rows.append((i, sorted(span() for _ in range(rng.randrange(8))), sorted(span() for _ in range(rng.randrange(6)))))
    kind = "array<struct<start: bigint, end: bigint>>"
    df = spark.createDataFrame(rows, f"i INT, a {kind}, b {kind}")
    for r in df.withColumn("free", outside(F.col("a"), F.col("b"))).collect():
        assert [tuple(x) for x in r.free] == [tuple(x) for x in r.a if not any(x.start < y.end and y.start < x.end for y in r.b)]
