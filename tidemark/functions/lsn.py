"""Log sequence numbers: 10 bytes, stored as 0x + 20 upper-case hex digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LSN_DEFAULT = "0x" + "0" * 20
LSN_BYTES = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lsn_hex(value: Column | str) -> Column:
    """Binary to text; NULL becomes the all-zero default."""
    return F.coalesce(F.concat(F.lit("0x"), F.hex(_col(value))), F.lit(LSN_DEFAULT))


def lsn_bin(text: Column | str) -> Column:
    """Text to 10 bytes, with or without 0x; anything else gives the minimum."""
    digits = F.regexp_replace(_col(text), "^0[xX]", "")
    valid = digits.rlike(f"^[0-9A-Fa-f]{{{2 * LSN_BYTES}}}$")
    return F.coalesce(F.unhex(F.when(valid, digits)), F.unhex(F.lit("00" * LSN_BYTES)))


def capture_instance(table: Column | str) -> Column:
    """Name of the change table; the schema is always dbo."""
    return F.concat(F.lit("dbo_"), _col(table))


def merge_predicate(keys: Column | str) -> Column:
    """``s.k = t.k AND ..`` from an array of key names; an error when it is empty."""
    names = _col(keys)
    parts = F.transform(names, lambda k: F.concat(F.lit("s."), k, F.lit(" = t."), k))
    return F.when(F.size(names) > 0, F.array_join(parts, " AND ")).otherwise(
        F.raise_error(F.lit("No primary key columns found")))


def merge_predicate_text(keys: Sequence[str]) -> str:
    """The same predicate for a key list known on the driver."""
    if not keys:
        raise ValueError("No primary key columns found")
    return " AND ".join(f"s.{k} = t.{k}" for k in keys)
