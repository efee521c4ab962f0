"""A training corpus from raw documents, in stages that are written as Parquet and read again.

Stages, in order: the quality classifier drops toxic and bad documents; of exact copies one stays; of
documents connected by 80 % of their word 5-grams one stays; sources are mixed to their target weights
(a document taken in several passes comes once per pass); the result is encoded and decoded again.

Every stage takes the columns doc_id, text, lang, source, n_chars and all but the last return them. Null
texts are rejected by the first stage; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, classifier, exact_dedup, mixing, ngram_join
from tidemark.llm.tables import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.select_good(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs.select(COLUMNS))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_similar(docs.select(COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs.select(COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and whether decoding them gives the text back."""
    return bpe.encode_checked(docs.select(COLUMNS), bpe.default_vocabulary(), keep=("source",))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("BPE encoding", tokens),
]

#: SQL cannot express the classifier, the mix or the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs.select("doc_id", "source", "n_tokens", F.sha2(F.to_json("ids"), 256).alias("ids_sha256"), "same")
