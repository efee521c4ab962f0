"""Exact duplicates: group by a 128-bit content hash, compare the bytes inside groups.

``duplicate_classes`` returns one row per document with the document that stays. Equal means equal
after deleting white space (`[\\x20\\x09-\\x0D]`). Of a class the row with the longest original text
stays, then the one with the smallest id.

Defined results: a null text counts as empty (all empty texts are one class); a null id sorts after
all others; ``duplicate_classes`` gives rows with one id and class the same answer; extra columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.text import SPACE, row_key, whole


def _first() -> list[Column]:
    """What orders the rows of a class: the longest, then the smallest id, null last."""
    return [(-F.col("n")).alias("shorter"), F.col("doc_id").isNull().alias("none"), F.col("doc_id")]


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    The aggregate groups by hash and bytes, so two texts under one hash stay apart; it combines on
    the map side, so a group of copies of any size leaves each map task as one row. The answer goes
    back to the documents by a join of narrow rows that AQE can split on a hot class.
    """
    text = whole(docs[text_col])
    keyed = docs.select(docs[id_col].cast("long").alias("doc_id"), F.length(text).alias("n"),
                        F.regexp_replace(text, f"{SPACE}+", "").alias("norm"))
    keyed = keyed.select("doc_id", "n", "norm", content_hash(F.col("norm")).alias("h"))
    classes = (keyed.groupBy("h", "norm")
               .agg(F.count(F.lit(1)).alias("group_size"), F.min(F.struct(*_first())).alias("best"))
               .select("h", F.sha2("norm", 256).alias("text_sha256"), "group_size", F.col("best.doc_id").alias("keep_id")))
    members = keyed.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"))
    return (members.join(classes, ["h", "text_sha256"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each class one row, decided per row and not per id.

    Ids may be null or stand on several texts; of rows equal in id and text one stays.
    """
    text, doc_id = whole(docs[text_col]), docs[id_col].cast("long")
    keyed = docs.select(row_key(doc_id, text).alias("key"), doc_id.alias("doc_id"), F.length(text).alias("n"),
                        F.regexp_replace(text, f"{SPACE}+", "").alias("norm"))
    kept = (keyed.select("key", "doc_id", "n", "norm", F.md5("norm").alias("h")).groupBy("h", "norm")
            .agg(F.min(F.struct(*_first(), "key")).alias("best")).select(F.col("best.key").alias("_row key")))
    rows = docs.withColumn("_row key", row_key(doc_id, text))
    return rows.join(kept, "_row key", "left_semi").dropDuplicates(["_row key"]).drop("_row key")


SQL = r"""
WITH k AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256 FROM k)
"""


@query("op10_exact_dedup", sql=SQL)
def exact_dedup(documents: DataFrame) -> DataFrame:
    return duplicate_classes(documents)
