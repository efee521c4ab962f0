"""Native text columns: white space, and positions of pattern matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
_CHUNK = 256


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(doc_id: Column, text: Column) -> Column:
    """128-bit identity of a row by its id, which may be null or stand on several texts, and its text."""
    return F.unhex(F.md5(F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("null")), text)))


def _scan(lengths: Column, start: Column) -> Column:
    """Running sums of ``lengths`` after ``start``; quadratic, so for short arrays only."""
    step = lambda acc, x: F.struct((acc.p + x).alias("p"), F.concat(acc.a, F.array(acc.p + x)).alias("a"))
    first = F.struct(start.cast("long").alias("p"), F.array().cast("array<long>").alias("a"))
    return F.aggregate(lengths, first, step, lambda acc: acc.a)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; a column used inside a lambda is computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(lengths: Column) -> Column:
    """Running sums of an array of any length, in chunks so that the cost stays near linear."""
    def summed(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x))
        return let(totals, lambda t: F.flatten(F.zip_with(parts, F.zip_with(_scan(t, F.lit(0)), t, lambda e, x: e - x), _scan)))

    def chunked(array: Column) -> Column:
        n = F.floor((F.size(array) - 1) / _CHUNK).cast("int")
        return let(F.transform(F.sequence(F.lit(0), n), lambda c: F.slice(array, c * _CHUNK + 1, F.lit(_CHUNK))), summed)

    none = F.array().cast("array<long>")
    return let(lengths.cast("array<long>"), lambda a: F.when(F.size(a) > 0, chunked(a)).otherwise(none))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, end, value>>, in code points, end exclusive.

    What lies between matches comes from split(), what matches from regexp_extract_all(); running
    sums of their lengths are the positions. The pattern must not match the empty string.
    """
    found = F.struct(F.regexp_extract_all(text, F.lit(f"(?:{pattern})"), F.lit(0)).alias("values"),
                     F.transform(F.split(text, f"(?:{pattern})", -1), lambda g: F.length(g)).alias("gaps"))

    def placed(f: Column) -> Column:
        lengths = F.zip_with(f.gaps, f["values"], lambda g, v: g + F.coalesce(F.length(v), F.lit(0)))
        ends = F.slice(running_sums(lengths), F.lit(1), F.size(f["values"]))
        return F.zip_with(ends, f["values"], lambda e, v: F.struct(
            (e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))
    return let(found, placed)


NO_MATCHES = "array<struct<start:bigint,end:bigint,value:string>>"


def matches_if(text: Column, may: Column, pattern: str) -> Column:
    """The matches where the cheap test ``may`` holds, else none."""
    return F.when(may, matches(text, pattern)).otherwise(F.array().cast(NO_MATCHES)).cast(NO_MATCHES)


def below(numbers: Column, x: Column, equal: bool) -> Column:
    """How many of some sorted numbers are below ``x`` (or equal to it), by halving."""
    def step(at: Column, k: Column) -> Column:
        n = F.get(numbers, at + k - 1)
        return F.when((at + k <= F.size(numbers)) & ((n <= x) if equal else (n < x)), at + k).otherwise(at)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(26, -1, -1)]), F.lit(0), step)


def outside(spans: Column, taken: Column) -> Column:
    """Those of ``spans`` that overlap none of ``taken``; both arrays of structs with start and end.

    A span overlaps as many as begin before its end, less those that end before it begins, which is
    counted in sorted arrays, so that long texts with many spans of both kinds cost little more per span.
    """
    ends = F.struct(F.array_sort(F.transform(taken, lambda b: b.start)).alias("first"), F.array_sort(F.transform(taken, lambda b: b.end)).alias("last"))
    free = let(ends, lambda e: F.filter(spans, lambda c: below(e["first"], c.end, False) == below(e["last"], c.start, True)))
    return F.when((F.size(spans) == 0) | (F.size(taken) == 0), spans).otherwise(free)


def span_text(spans: Column) -> Column:
    """kind:start:end of array<struct<start, rank, end, kind>>, sorted by start and rank, comma-joined."""
    said = F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(said, ",")
