"""Operators that prepare text for model training; nothing else in the library imports them."""

from tidemark.llm import (  # noqa: F401  importing registers the queries
    bpe, classifier, exact_dedup, hard_negatives, html_extract, licences, mixing, ngram_join, pii, quality_rules, secrets, substring,
    whitening)
from tidemark.llm.registry import ORACLES, QUERIES  # noqa: F401
