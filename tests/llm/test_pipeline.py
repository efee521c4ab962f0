"""The pipeline: each stage on its own input, and the result against its parts."""

from __future__ import annotations

import hashlib
import json
import re

import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tidemark.llm import bpe, classifier, exact_dedup, mixing, ngram_join
from tidemark.llm.tables import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), "test-stage")
        out.append(docs)
    return out


def test_columns_and_order(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == corpus_pipeline.COLUMNS for df in stages[:-1])


def test_each_stage_takes_effect(spark, stages):
    raw, good, unique, distinct, mixed, tokens = stages
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    model = classifier.fit(raw, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert ids(good) == ids(classifier.rate(raw, model).filter("kept")) and good.count() < raw.count()
    assert ids(unique) == ids(exact_dedup.exact_dedup(good).filter("kept"))
    assert ids(distinct) == ids(ngram_join.ngram_join(unique).filter("doc_id = component_id"))
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(distinct).collect()}
    got = dict.fromkeys(taken, 0)
    for r in mixed.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == taken


def test_result(spark, stages):
    library = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    want = sorted((r.doc_id, hashlib.sha256(json.dumps(library.encode(r.text, add_special_tokens=False).ids, separators=(",", ":")).encode()).hexdigest())
                  for r in stages[4].collect())
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in got) == want
    assert all(r.same for r in got)


def test_nulls_and_an_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a few good words", None, None, 16), (None, "a few good words", "en", "s", 16),
            (3, "a few good words", None, None, 16)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SMALL), "test-stage")
        assert {r.doc_id for r in docs.collect()} == ({3} if data else set())


def test_rows_without_an_id_and_ids_on_two_texts(spark):
    """Documents are rows: only rows equal in id and text, copies and near copies are dropped."""
    words = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    a, b, c, near = words(1), words(2), words(3), words(3) + " and"
    rows = [(5, a), (5, b), (5, a), (3, b), (None, c), (None, words(4)), (None, words(5)), (None, words(4)), (7, near)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    say = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    unique = [(5, a), (3, b), (None, c), (None, words(4)), (None, words(5)), (7, near)]
    assert say(exact_dedup.drop_exact_duplicates(docs)) == sorted(unique, key=str)
    left = [x for x in unique if x != (None, c)]
    assert say(ngram_join.drop_similar(docs)) == sorted(left, key=str)
    found = {(r.doc_id, r.component_id) for r in ngram_join.ngram_join(docs).collect()}
    assert found == {(5, 5), (5, 3), (3, 3), (None, 7), (None, None), (7, 7)}
    mixed = mixing.mixed_documents(spark.createDataFrame(left, "doc_id long, text string").withColumn("source", F.lit("s")), count_col=None)
    assert sorted(w for r in mixed.collect() for w in r.text.split()) == sorted(w for _, t in left for w in t.split())
