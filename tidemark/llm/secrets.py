"""Secrets in text: fixed formats, and strings that a Markov model of random characters explains better.

Two character-pair models, one of random keys and one of ordinary identifiers and words, are trained
from labelled samples drawn by rule on the driver. A run of 20 or more key characters is a secret when
the log-likelihood ratio per pair exceeds a threshold set on held-out samples. Scoring is an array
expression; no Python runs on the executors.

Defined results: a null text counts as empty; a text without finds gives zero counts and empty spans;
every row gives one row, repeated rows included; extra columns are ignored.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.text import matches_if, outside, span_text, whole

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

# Common words that identifiers are made of.
WORDS = (
    "the and for with this that from have not are was were which their would there about could other into "
    "user name value index count list table column query result error config option default parent child "
    "request response handler manager service factory builder context session message event stream buffer "
    "file path folder directory version number date time update delete insert select create remove "
    "information international representation communication understanding organisation administration "
    "und der die das ein eine nicht mit auf ist sich werden haben sein keit heit ung lich schaft gesellschaft "
    "que les des pour dans une sur est avec sont tion ment eux elle au oir eau ation naturellement "
    "los las del por una con para como pero esta ciones ado ido mente dad cion importante").split()
_LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABET = _LOWER + _LOWER.upper() + "0123456789"
OTHER = len(ALPHABET)
STATES = OTHER + 1


def labelled_samples(n: int = 4000, seed: int = 7) -> list[tuple[str, int]]:
    """Strings with label 1 for random keys and 0 for ordinary identifiers, drawn by rule."""
    rng = random.Random(seed)
    random_sets = (ALPHABET + "+/", ALPHABET + "-_", ALPHABET, _LOWER + "0123456789",
                   _LOWER.upper() + "0123456789", "0123456789abcdef", "0123456789ABCDEF", ALPHABET)
    joins = ("_", "-", "", "/", "=")
    out = []
    for _ in range(n):
        letters = rng.choice(random_sets)
        out.append(("".join(rng.choice(letters) for _ in range(rng.randint(20, 64))), 1))
        parts: list[str] = []
        while sum(map(len, parts)) < 20:
            parts.append(rng.choice(WORDS))
        style, join = rng.randrange(4), rng.choice(joins)
        text = "".join(p.capitalize() for p in parts) if style == 0 else join.join(parts)
        if style == 1:
            text = text.upper()
        if rng.random() < 0.2:
            text += rng.choice(("_", "-", "")) + str(rng.randint(0, 2030))
        out.append((text, 0))
    for _ in range(n // 8):  # rulers and padding are ordinary too
        out.append((rng.choice("-=_+/0xA1") * rng.randint(20, 60), 0))
        day = f"{rng.randint(1990, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        out.append((f"{day}/{day}/{rng.choice(WORDS)}", 0))
    return out


def _states(text: str) -> list[int]:
    found = (ALPHABET.find(c) for c in text)
    return [OTHER if i < 0 else i for i in found]


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, float]:
    """Log-likelihood ratios of character pairs, and the threshold on their mean.

    The threshold is the lowest that at most one ordinary held-out sample in a thousand exceeds.
    """
    train, held = labelled_samples(seed=7), labelled_samples(seed=8)
    counts = np.ones((2, STATES, STATES))
    for text, label in train:
        s = _states(text)
        np.add.at(counts[label], (s[:-1], s[1:]), 1)
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    ratio = logs[1] - logs[0]
    means = lambda label: np.array([np.mean(ratio[s[:-1], s[1:]]) for x, y in held if y == label for s in [_states(x)]])
    return ratio, float(max(np.quantile(means(0), 0.999), 0.0))


def mean_ratio(value: Column) -> Column:
    """Mean log-likelihood ratio of the character pairs of an ASCII string."""
    ratio, _ = model()
    by_code = [OTHER] * 128
    for i, c in enumerate(ALPHABET):
        by_code[ord(c)] = i
    states = F.split(F.lit(",".join(map(str, by_code))), ",").cast("array<int>")
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratio.ravel())), ",").cast("array<double>")
    letters = F.filter(F.split(value, ""), lambda c: c != "")  # one pass; a substring by position would walk from the start each time
    codes = F.transform(letters, lambda c: F.get(states, F.ascii(c)))
    total = F.aggregate(codes, F.struct(F.lit(-1).alias("p"), F.lit(0.0).alias("s")), lambda acc, c: F.struct(
        c.alias("p"), (acc.s + F.when(acc.p < 0, F.lit(0.0)).otherwise(F.get(table, acc.p * STATES + c))).alias("s")),
        lambda acc: acc.s)
    return total / F.greatest(F.length(value) - 1, F.lit(1))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float | None = None) -> DataFrame:
    """doc_id and ``found``: array<struct<start, rank, end, kind, value>> of every row.

    Ranks 0 to 2 are the fixed formats; rank 3 (``random``) are model finds that overlap none of them.
    """
    limit = model()[1] if threshold is None else threshold
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), whole(docs[text_col]).alias("t"))
    t = F.col("t")
    rows = rows.select(
        "doc_id",
        F.filter(matches_if(t, t.rlike(ASSIGN), ASSIGN),
                 lambda m: F.length(F.regexp_extract(m.value, ASSIGN, 1)) >= 12).alias("assign"),
        matches_if(t, t.contains("AKIA"), ACCESS).alias("access"),
        matches_if(t, t.rlike(HEX), HEX).alias("hex"),
        matches_if(t, t.rlike(CANDIDATE), CANDIDATE).alias("candidates"))
    kinds = ("assign", "access", "hex")
    said = lambda name, rank: F.transform(F.col(name), lambda m: F.struct(
        m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(name).alias("kind"), m.value.alias("value")))
    rows = rows.withColumn("base", F.concat(*[said(k, i) for i, k in enumerate(kinds)]))
    free = outside(F.col("candidates"), F.col("base"))
    rows = rows.withColumn("free", free).withColumn("random", F.filter(F.col("free"), lambda c: mean_ratio(c.value) > limit))
    return rows.select("doc_id", F.concat(F.col("base"), said("random", 3)).alias("found"))


@query("op9_secret_scan")
def secret_scan(documents: DataFrame) -> DataFrame:
    found = scan_secrets(documents)
    base = F.filter(F.col("found"), lambda s: s["rank"] < 3)
    count = lambda rank: F.size(F.filter(F.col("found"), lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))
