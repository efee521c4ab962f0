"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, classifier, exact_dedup, html_extract, mixing, ngram_join, pii, quality_rules, secrets, substring)

LONG = "lorem ipsum dolor sit amet consectetur " * 6000
ROWS = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c"), (5, "A b c"), (5, "A b c"), (6, LONG), (7, "x" * 50_000),
        (None, "seven words are not enough for anything"), (9, "a b c")]
SCHEMA = "doc_id long, text string"
CLASH = ("n", "h", "norm", "kept", "tie", "size", "start", "source_size", "token", "rep", "label", "words", "t", "base", "s", "g", "m0", "d2", "low")


@pytest.fixture(scope="module")
def edge(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({
        "lang": F.lit(None).cast("string"), "source": F.when(F.col("doc_id") > 3, F.lit("s")),
        "n_chars": F.length("text").cast("long")})
    return docs.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def empty(edge):
    return edge.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


QUERIES = {
    "pii": pii.pii, "ngram_join": ngram_join.ngram_join, "substring": substring.substring_dedup,
    "quality_rules": quality_rules.quality_rules, "bpe": bpe.bpe, "mixing": mixing.mix_sources,
    "secrets": secrets.secret_scan, "exact_dedup": exact_dedup.exact_dedup}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_row_and_empty_tables(edge, empty, name):
    got = QUERIES[name](edge).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in ROWS)
    assert QUERIES[name](empty).collect() == []


def test_exact_dedup_edges(edge):
    got = by_id(exact_dedup.exact_dedup(edge))
    assert {got[i]["keep_id"] for i in (1, 2, 3)} == {3} and got[1]["group_size"] == 3  # the longest original stays
    assert got[9]["keep_id"] == 4 and got[5]["keep_id"] == 5 and got[5]["group_size"] == 2
    assert got[1]["text_sha256"] == hashlib.sha256(b"").hexdigest()


def test_colliding_hashes_are_told_apart(edge):
    forced = exact_dedup.duplicate_classes(edge, content_hash=lambda c: F.lit("same"))
    assert sorted(map(str, forced.collect())) == sorted(map(str, exact_dedup.duplicate_classes(edge).collect()))


def test_drop_exact_duplicates_keeps_one_row_of_each(edge):
    assert sorted(str(r.doc_id) for r in exact_dedup.drop_exact_duplicates(edge).collect()) == ["3", "4", "5", "6", "7", "None"]


def test_ngram_edges(edge):
    got = by_id(ngram_join.ngram_join(edge))
    assert got[1]["n_shingles"] == 0 and got[2]["component_id"] == 2 and got[3]["component_id"] == 3
    assert {got[i]["component_id"] for i in (4, 5, 9)} == {4}  # case is ignored
    assert got[None]["n_shingles"] == 3 and got[None]["component_id"] is None
    assert got[6]["n_shingles"] == 6


def test_substring_edges(edge, spark):
    got = by_id(substring.substring_dedup(edge))
    assert all(r["n_removed"] == 0 for r in got.values()) and got[6]["n_words"] == 36_000
    twice = spark.createDataFrame([(1, LONG), (1, LONG), (2, LONG), (None, LONG)], SCHEMA)
    rows = sorted((str(r.doc_id), r.n_removed) for r in substring.substring_dedup(twice).collect())
    assert rows == [("1", 0), ("1", 0), ("2", 36_000), ("None", 36_000)]


def test_quality_edges(edge):
    got = by_id(quality_rules.quality_rules(edge))
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and not got[1]["kept"]
    assert got[6]["n_repeat_words"] == 36_000 and not got[6]["kept"]


def test_mixing_edges(edge):
    got = by_id(mixing.mix_sources(edge))
    assert got[1]["taken"] == 0 and got[1]["size"] == 0
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())


def test_mixed_documents_edges(edge, empty):
    out = mixing.mixed_documents(edge)
    assert out.columns == edge.columns
    assert all(r.text and r.n_chars == len(r.text) for r in out.collect())
    assert mixing.mixed_documents(empty).collect() == []


def test_classifier_edges(edge, empty, spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, None), (6, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = classifier.fit(edge, labels)
    assert len(model.thresholds) == 0  # one usable label
    got = classifier.rate(edge, model).collect()
    assert len(got) == len(ROWS)
    kept = {r.doc_id: r.kept for r in got}
    assert not kept[1] and not kept[2] and not kept[3] and kept[4] and kept[6]
    assert classifier.rate(empty, classifier.fit(empty, labels.limit(0))).collect() == []
    assert classifier.select_good(edge, labels).columns == edge.columns


def test_classifier_counts_repeated_rows_once(spark):
    rows = [(i, f"some {'fine' if i % 2 else 'poor'} words {i % 7}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    one, more = (classifier.fit(spark.createDataFrame(r, SCHEMA), labels) for r in (rows, rows + rows[:1] * 500))
    assert (one.weights == more.weights).all() and (one.thresholds == more.thresholds).all()


def test_bpe_looks_up_short_prefixes_only():
    class Counted(dict):
        asked = 0

        def __contains__(self, key):
            self.asked += len(key) > bpe.KEPT
            return dict.__contains__(self, key)
    with open(bpe.default_vocabulary(), "rb") as f:
        automaton = bpe.Tokenizer(f.read()).automaton
    want = automaton.encode(b"ab" * 500)
    automaton.paths = Counted()
    assert automaton.encode(b"ab" * 500) == want and automaton.paths.asked == 0


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p"), (3, "u", "plain &amp; text"),
                                   (None, "u", "<article><p>" + "One sentence here. " * 5000)], "page_id long, url string, html string")
    got = html_extract.html_extract(pages.withColumns({"text": F.lit(1), "n_chars": F.lit("clash")})).collect()
    assert len(got) == 5 and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert all(r.n_chars == len(r.text) for r in got)
    assert [r.n_chars for r in got if r.page_id is None] == [len("One sentence here. " * 5000) - 1]
    assert html_extract.html_extract(pages.limit(0)).collect() == []
