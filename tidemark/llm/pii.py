"""Personal data: fixed formats, and candidate spans accepted by gradient-boosted trees.

Generators propose overlapping spans with high recall (spelled-out addresses, number groups, account
numbers). Of a run of numbers, every sequence of its groups of digits is proposed (``MIN_CHARS`` characters
or more, ``MAX_DIGITS`` digits or fewer), and the run as a whole. Boosted trees over format and context features score each span; per generator, the lowest
score with a precision of 0.98 or more on held-out samples is its threshold. The trees are trained on
the driver from a bounded number of labelled samples drawn by rule (``SAMPLES``), with the features
computed by the same column expressions as in scoring, and are then one column expression.

Defined results: a null text counts as empty; a text without finds gives zero counts and empty spans;
every row gives one row, repeated rows included; extra columns are ignored.
"""

from __future__ import annotations

import json
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.text import NO_MATCHES, below, let, matches_if, outside, running_sums, span_text, whole

_LOCAL = "[A-Za-z0-9._%+-]"
# The contract's patterns, written so that no run of characters is tried twice: a match can begin
# inside a run only where the previous one ended.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

GENERATORS = {
    "spelled_email": r"[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]\x20?(?i:dot)\x20?[\])])\x20?[A-Za-z0-9-]++)++",
    "number_group": r"[(]?[0-9][0-9().\x20/-]{5,}[0-9]",
    "account": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?\b",
}
MAY = {
    "spelled_email": r"[\[(]\x20?(?i:at)\x20?[\])]",
    "number_group": r"[0-9][0-9().\x20/-]{5}",
    "account": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
}
CONTEXT = 24
_PIECE = 256
SAMPLES = 1500
#: Lines of two or three adjacent numbers, of which every proposed span is a sample.
LINES = 200
#: Shortest span of a run of numbers, as in its pattern, and the most digits of a phone number (E.164).
MIN_CHARS, MAX_DIGITS = 7, 15
FEATURES = ("n_chars", "n_digits", "n_seps", "n_groups", "digit_share", "longest_group", "opens_paren", "dashed_3_2_4",
            "date_like", "mod97", "says_phone", "says_id", "says_mail", "says_bank", "says_other", "n_upper",
            "grouped_3_3_4", "n_spaces", "joined_before", "joined_after", "number_before", "number_after")


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def term(i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + term(i))
    return total % 10 == 0


def _mod97(v: Column) -> Column:
    """Whether an account number of two letters, two digits and more has the right check digits."""
    plain = F.replace(v, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))
    step = lambda a, c: (a * F.when(c.rlike("[A-Z]"), 100).otherwise(10)
                         + F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48)) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _parts_of_run(run: Column) -> Column:
    """The spans proposed in a run of numbers, as an array of structs like the run's.

    The run is cut once into groups of digits and what stands between; a span joins a few of these pieces.
    """
    def spans(p: Column) -> Column:
        pieces, ends = p["pieces"], p["ends"]
        first = F.when(F.get(pieces, F.lit(0)).rlike("^[0-9]"), F.lit(0)).otherwise(F.lit(1))  # where the first group stands
        n = F.floor((F.size(pieces) - first + 1) / 2).cast("int") - 1

        def one(i: Column, j: Column) -> Column:
            at, last = first + 2 * i, first + 2 * j
            inside = F.array_join(F.slice(pieces, at + 1, last - at + 1), "")
            opened = F.coalesce(F.get(pieces, at - 1).endswith("("), F.lit(False)) & inside.contains(")")
            low = run.start + F.coalesce(F.get(ends, at - 1), F.lit(0)) - opened.cast("long")
            return F.struct(low.alias("start"), (run.start + F.get(ends, last)).alias("end"),
                            F.concat(F.when(opened, "(").otherwise(""), inside).alias("value"))
        all_of = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.transform(
            F.sequence(i, F.least(i + MAX_DIGITS - 1, n)), lambda j: one(i, j))))
        return F.filter(all_of, lambda c: (F.length(c.value) >= MIN_CHARS) & (F.length(_digits(c.value)) <= MAX_DIGITS)
                        & ((c.start != run.start) | (c.end != run.end)))
    pieces = F.regexp_extract_all(run.value, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    cut = let(pieces, lambda x: F.struct(x.alias("pieces"), running_sums(F.transform(x, lambda y: F.length(y))).alias("ends")))
    return F.concat(F.array(run), let(cut, spans)).cast(NO_MATCHES)


def _around(text: Column, spans: Column, body) -> Column:
    """``body(span, text before, text after)`` for each of ``spans``, with up to ``CONTEXT`` characters on both sides.

    The text is cut once into pieces of equal length, so a span far from its beginning costs no more.
    """
    def seen(pieces: Column) -> Column:
        def part(low: Column, size: Column) -> Column:
            k = F.floor(low / _PIECE).cast("int")
            two = F.concat(*[F.coalesce(F.get(pieces, k + i), F.lit("")) for i in (0, 1)])
            return F.substring(two, (low - k * _PIECE + 1).cast("int"), size.cast("int"))

        def one(c: Column) -> Column:
            low = F.greatest(c.start - CONTEXT, F.lit(0))
            near = F.struct(part(low, c.start - low).alias("before"), part(c.end, F.lit(CONTEXT)).alias("after"))
            return let(near, lambda x: body(c, x["before"], x["after"]))
        return F.transform(spans, one)
    return let(F.when(F.size(spans) > 0, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))), seen)


def _best_first(scored: Column, none: Column) -> Column:
    """Of spans with scores (``score``, ``c``) those that are taken from the highest score down, unless they overlap one that was.

    Spans that no chain of overlaps connects do not matter to each other, so each such cluster is decided by itself.
    """
    def overlap(a: Column, b: Column) -> Column:
        return (a.start < b.end) & (b.start < a.end)

    def decided(cluster: Column) -> Column:
        ranked = F.sort_array(F.transform(cluster, lambda o: F.struct(
            (-o.score).alias("score"), o.c.start.alias("start"), (-o.c.end).alias("end"), o.c.alias("c"))))
        return F.aggregate(ranked, none, lambda a, o: F.when(F.exists(a, lambda q: overlap(o.c, q)), a).otherwise(F.concat(a, F.array(o.c))))

    def clusters(p: Column) -> Column:
        spans, starts, ends = p["spans"], p["starts"], p["ends"]
        begins = lambda x: below(ends, x, True) == below(starts, x, False)  # noqa: E731  all that began before have ended
        cuts = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (
            (i == 0) | (F.get(starts, i) != F.get(starts, i - 1))) & begins(F.get(starts, i)))
        return let(cuts, lambda x: F.flatten(F.transform(x, lambda i, k: decided(
            F.slice(spans, i + 1, F.coalesce(F.get(x, k + 1), F.size(spans)) - i)))))

    placed = F.sort_array(F.transform(scored, lambda o: F.struct(o.c.start.alias("start"), o.c.end.alias("end"), o.score.alias("score"), o.c.alias("c"))))
    parts = let(placed, lambda x: F.struct(x.alias("spans"), F.transform(x, lambda o: o.start).alias("starts"),
                                           F.array_sort(F.transform(x, lambda o: o.end)).alias("ends")))
    return F.when(F.size(scored) > 0, let(parts, clusters)).otherwise(none)


def _parts(text: str) -> set[tuple[int, int]]:
    """``_parts_of_run`` of all runs of a text, for the samples."""
    out = set()
    for run in re.finditer(GENERATORS["number_group"], text):
        out.add(run.span())
        groups = [m.span() for m in re.compile("[0-9]+").finditer(text, *run.span())]
        for i, (low, _) in enumerate(groups):
            for _, end in groups[i:]:
                start = low - (low > run.start() and text[low - 1] == "(" and ")" in text[low:end])
                if end - start >= MIN_CHARS and sum(map(str.isdigit, text[low:end])) <= MAX_DIGITS:
                    out.add((start, end))
    return out


def features(value: Column, before: Column, after: Column) -> Column:
    """Format features of a span and features of the text before and after it, as an array<double>."""
    near = F.lower(before)
    says = lambda words: near.rlike(rf"\b(?:{words})\b")
    digits = _digits(value)
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    ordered = {
        "n_chars": F.length(value), "n_digits": F.length(digits),
        "n_seps": F.length(F.regexp_replace(value, r"[^ ().,/\[\]-]", "")), "n_groups": F.size(groups),
        "digit_share": F.length(digits) / F.length(value),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "opens_paren": value.startswith("("), "dashed_3_2_4": value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "date_like": value.rlike(r"^(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{2,4})$"),
        "mod97": F.when(value.rlike("^[A-Z]{2}[0-9]{2}"), _mod97(value)).otherwise(F.lit(False)),
        "says_phone": says("tel|phone|telephone|call|mobile|fax|cell|whatsapp|telefon|tél"),
        "says_id": says("ssn|social security|passport|tax id|national id"),
        "says_mail": says("mail|email|e-mail|contact|write|reach"),
        "says_bank": says("iban|account|bank|konto|transfer"),
        "says_other": says("order|invoice|isbn|serial|version|ref|no|item|page|date|total|year|art"),
        "n_upper": F.length(F.regexp_replace(value, "[^A-Z]", "")),
        "grouped_3_3_4": value.rlike(r"^(?:[(][0-9]{3}[)]|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"),
        "n_spaces": F.length(F.regexp_replace(value, "[^ ]", "")),
        "joined_before": before.rlike(r"[0-9][)]?[./-]?[(]?$"), "joined_after": after.rlike(r"^[)]?[./-]?[(]?[0-9]"),
        "number_before": before.rlike(r"[0-9][().\x20/-]*$"), "number_after": after.rlike(r"^[().\x20/-]*[0-9]"),
    }
    return F.array(*[ordered[name].cast("double") for name in FEATURES])


def labelled_samples(n: int = SAMPLES, seed: int = 11) -> list[dict]:
    """Spans with the text before them and label 1 for personal data, drawn by rule."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 8)))

    def account(right: bool) -> str:
        body = rng.choice(("DE", "FR", "ES", "GB")), d(18)
        turned = "".join(str(ord(c) - 55) if c.isalpha() else c for c in body[1] + body[0] + "00")
        check = 98 - int(turned) % 97
        text = f"{body[0]}{check if right else (check + rng.randint(1, 90)) % 97:02d}{body[1]}"
        return " ".join(text[i:i + 4] for i in range(0, len(text), 4)) if rng.random() < 0.5 else text

    at, dot = ("[at]", "(at)", "[ at ]", " (at) "), (".", "[dot]", " (dot) ")
    out = []
    for i in range(n):
        phone = rng.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(3)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}"))
        cases = [
            ("number_group", phone, rng.choice(("call ", "tel: ", "phone ", "mobile: ", "fax ")), 1),
            ("number_group", f"{d(3)}-{d(2)}-{d(4)}", rng.choice(("ssn ", "social security: ", f"{word()} ", "national id ")), 1),
            ("number_group", rng.choice((d(8), d(12), d(16), f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(3)} {d(3)} {d(3)}",
                                         f"{d(1)}.{d(2)}.{d(3)}.{d(3)}", f"{d(4)} {d(4)} {d(4)} {d(4)}", phone.replace("(", "").replace(")", ""))),
             rng.choice(("order ", "invoice no ", "isbn ", "serial ", f"{word()} ", f"{word()}, ", "version ", "total ")), 0),
            ("spelled_email", f"{word()}{rng.choice(at)}{word()}{rng.choice(dot)}{rng.choice(('com', 'org', 'net', 'de'))}",
             rng.choice(("mail ", "contact ", f"{word()} ")), 1),
            ("spelled_email", f"{word()} (at) {word()}{rng.choice(('.', ' .'))}{word()}", f"{word()} ", 0),
            ("account", account(True), rng.choice(("iban ", "account ", f"{word()} ")), 1),
            ("account", account(False), rng.choice(("serial ", "ref ", f"{word()} ")), 0),
        ]
        kind, value, near, label = cases[i % len(cases)]
        out.append({"kind": kind, "value": value, "near": f"{word()} {near}", "after": rng.choice(("", " ", f" {word()}", ". ", ", ")),
                    "label": label, "held": i // len(cases) % 3 == 0})
    says = re.compile(r"\b(?:call|tel|phone|mobile|fax)\b")
    for i in range(LINES):
        line, private = f"{word()} " + rng.choice(("call ", "tel: ", "phone ", "mobile: ", "fax ", f"{word()} ", "", "order ")), set()
        for k in range(rng.choice((2, 2, 3))):
            if k:
                line += rng.choice((" ", " ", " ", "  ", ". ", " / ", "/", " - ", ") "))
            low, form = len(line), rng.randrange(8)
            value = (f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}",
                     f"{d(4)}-{d(2)}-{d(2)}", d(rng.randint(1, 4)), f"{d(2)}/{d(2)}/{d(4)}")[form]
            line += value
            if form in (0, 3, 4) or form < 3 and says.search(line[max(0, low - CONTEXT):low]):
                private.add((low, len(line)))
        line += rng.choice(("", f" {word()}", "."))
        out += [{"kind": "number_group", "value": line[a:b], "near": line[max(0, a - CONTEXT):a], "after": line[b:b + CONTEXT],
                 "label": int((a, b) in private), "held": i % 3 == 0} for a, b in sorted(_parts(line))]
    return out


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A regression tree on gradients: a value, or (feature, threshold, left, right)."""
    best = (1e-6, None, None)
    score = lambda a, b: a * a / (b + 1.0)
    if depth:
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, gs, hs = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut):
                gain = score(gs[cut], hs[cut]) + score(gs[-1] - gs[cut], hs[-1] - hs[cut]) - score(gs[-1], hs[-1])
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], j, (v[cut[k]] + v[cut[k] + 1]) / 2)
    if best[1] is None:
        return float(-0.3 * g.sum() / (h.sum() + 1.0))
    left = x[:, best[1]] < best[2]
    return best[1], float(best[2]), _grow(x[left], g[left], h[left], depth - 1), _grow(x[~left], g[~left], h[~left], depth - 1)


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    j, cut, left, right = tree
    return np.where(x[:, j] < cut, _apply(left, x), _apply(right, x))


@lru_cache(maxsize=1)
def _fitted(samples: str) -> tuple[tuple, dict[str, float]]:
    rows = json.loads(samples)
    x, y = np.array([r["x"] for r in rows]), np.array([float(r["label"]) for r in rows])
    held, kinds = np.array([r["held"] for r in rows]), np.array([r["kind"] for r in rows])
    trees, total = [], np.zeros(len(x))
    for _ in range(30):
        p = 1 / (1 + np.exp(-total))
        tree = _grow(x[~held], (p - y)[~held], (p * (1 - p))[~held], 3)
        trees.append(tree)
        total += _apply(tree, x)
    limits = {}
    for kind in GENERATORS:
        own = held & (kinds == kind)
        order = np.argsort(-total[own], kind="stable")
        scores, right = total[own][order], np.cumsum(y[own][order])
        ok = np.flatnonzero((right / np.arange(1, len(right) + 1) >= 0.98) & (np.append(scores[1:], -np.inf) < scores))
        limits[kind] = float(max(scores[ok[-1]], 0.0)) if len(ok) else float("inf")
    return tuple(trees), limits


_SAMPLE_ROWS: dict[int, str] = {}


def model(spark: SparkSession) -> tuple[tuple, dict[str, float]]:
    """The trees and the threshold of each generator, trained once in a driver process."""
    if SAMPLES not in _SAMPLE_ROWS:
        text = F.lit(json.dumps(labelled_samples()))
        rows = F.inline(F.from_json(text, "array<struct<kind:string,value:string,near:string,after:string,label:int,held:boolean>>"))
        found = spark.range(1).select(rows).select("kind", "label", "held", features(F.col("value"), F.col("near"), F.col("after")).alias("x"))
        _SAMPLE_ROWS[SAMPLES] = json.dumps([r.asDict() for r in found.collect()])  # SAMPLES rows and the spans of LINES lines
    return _fitted(_SAMPLE_ROWS[SAMPLES])


def _score(trees: tuple, x: Column) -> Column:
    def tree(t) -> Column:
        if isinstance(t, float):
            return F.lit(t)
        return F.when(x[t[0]] < t[1], tree(t[2])).otherwise(tree(t[3]))
    total = F.lit(0.0)
    for t in trees:
        total = total + tree(t)
    return total


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``base`` and ``added``: array<struct<start, rank, end, kind, value>> of every row.

    Accepted candidates that overlap no fixed format are added from the highest score down (of equal
    scores: the earlier, then the longer one first), unless they overlap one that was added.
    """
    trees, limits = model(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), whole(docs[text_col]).alias("t"))
    t = F.col("t")
    rows = rows.select(
        "doc_id", "t",
        matches_if(t, t.contains("@"), EMAIL).alias("email"),
        F.filter(matches_if(t, t.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), IP),
                 lambda m: F.forall(F.split(m.value, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike(
                     "^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))).alias("ip"),
        F.filter(matches_if(t, t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), CARD), lambda m: F.when(
            F.length(_digits(m.value)).between(14, 19), luhn(_digits(m.value))).otherwise(False)).alias("card"),
        F.filter(matches_if(t, t.rlike(r"\+[0-9]"), PHONE), lambda m: F.length(_digits(m.value)).between(10, 15)).alias("phone"),
        *[matches_if(t, t.rlike(MAY[k]), p).alias(k) for k, p in GENERATORS.items()])
    rows = rows.withColumn("number_group", F.flatten(F.transform("number_group", _parts_of_run)))
    said = lambda name, rank: F.transform(F.col(name), lambda m: F.struct(
        m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(name).alias("kind"), m.value.alias("value")))
    rows = rows.withColumn("base", F.concat(*[said(k, i) for i, k in enumerate(BASE)]))
    rows = rows.withColumn("open", outside(F.concat(*[said(k, len(BASE) + i) for i, k in enumerate(GENERATORS)]), F.col("base")))
    rows = rows.withColumn("open", _around(F.col("t"), F.col("open"), lambda c, before, after: F.struct(
        c.alias("c"), features(c.value, before, after).alias("x"))))
    rows = rows.withColumn("open", F.transform(F.col("open"), lambda o: F.struct(_score(trees, o.x).alias("score"), o.c.alias("c"))))
    limit = lambda c: F.element_at(F.create_map(*[F.lit(v) for kv in limits.items() for v in kv]), c.kind)
    rows = rows.withColumn("open", F.filter(F.col("open"), lambda o: o.score >= limit(o.c)))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>")
    added = _best_first(F.col("open"), none)
    return rows.select("doc_id", "base", added.alias("added"))


@query("op1_pii")
def pii(documents: DataFrame) -> DataFrame:
    found = scan_pii(documents)
    count = lambda rank: F.size(F.filter(F.col("base"), lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"))
