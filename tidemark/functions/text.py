"""Message bodies, JSON text, byte blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEARCH_TEXT_CHARS = 150
SEARCH_PAGE_SIZE = 50
BLOCK_CLOSING_BYTE = 254


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """Split on LF or CR LF."""
    return F.split(_col(text), "\r?\n")


def first_json_line(body: Column | str, schema: T.StructType | str) -> Column:
    """A payload may hold several JSON lines; parse the first."""
    return F.from_json(F.split(_col(body), "\n", 2)[0], schema)


def parse_json_or_default(text: Column | str, schema: T.StructType) -> Column:
    """Malformed or missing JSON gives a struct with NULL fields."""
    empty = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return F.coalesce(F.from_json(_col(text), schema), empty)


def json_path_or_root(doc: Column | str, path: str) -> Column:
    """The object at ``path``, or the whole document when it has none."""
    d = _col(doc)
    return F.coalesce(F.get_json_object(d, f"$.{path}"), d)


def json_message(key: Column | str, value: Column | str) -> Column:
    """``{"key":"value"}`` with the key taken from a column."""
    k = F.lit(key) if isinstance(key, str) else key
    return F.to_json(F.create_map(k, _col(value).cast("string")))


def tag_message(serial: Column | str, price: Column | str) -> Column:
    """``{"Tag":{"Serial":..,"Price":..}}``; an unknown price is left out."""
    return F.to_json(F.struct(F.struct(_col(serial).alias("Serial"), _col(price).alias("Price")).alias("Tag")))


def create_envelope(*columns: str) -> Column:
    """Row to the text of a create message: ``{"data":{..},"operation":"create"}``."""
    return F.to_json(F.struct(F.struct(*columns).alias("data"), F.lit("create").alias("operation")))


def encode_uri_component(text: Column | str) -> Column:
    """Percent-encoding that leaves A-Z a-z 0-9 - _ . ! ~ * ' ( ) as they are."""
    encoded = F.url_encode(_col(text))
    for raw, wanted in (("\\+", "%20"), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        encoded = F.regexp_replace(encoded, raw, wanted)
    return encoded


def search_text(text: Column | str, base_url: str, offset: Column | int = 0) -> Column:
    """Search URL for the first 150 characters, trimmed."""
    off = F.lit(offset) if isinstance(offset, int) else offset
    query = F.regexp_replace(F.substring(_col(text), 1, SEARCH_TEXT_CHARS), r"(?U)^[\s\uFEFF]+|[\s\uFEFF]+$", "")
    return F.concat(
        F.lit(base_url + "?q="), encode_uri_component(query), F.lit(f"&count={SEARCH_PAGE_SIZE}&offset="),
        off.cast("string"), F.lit("&responseFilter=Webpages&safesearch=Strict"))


def split_message(body: Column | str) -> Column:
    """Speed, throttle, engine speed and acceleration from a comma message."""
    parts = F.split(_col(body), ",")

    def number(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i + 1)).try_cast("float")
    return F.struct(number(5).alias("speed"), number(7).alias("throttle"),
                    number(8).alias("rpm"), number(10).alias("acceleration"))


def block_to_text(block: Column | str, keep_nul: bool = False, max_steps: int | None = None) -> Column:
    """Characters of a byte block from index 2 up to the first 0 or 254.

    A stop byte at index 0 or 1 gives an empty text. A device that walks a fixed number
    of steps is read with ``max_steps``; without it the whole block counts. ``keep_nul`` keeps the NUL a reader that appends before it tests leaves
    at the end of a block closed by 0.
    """
    b = _col(block)
    capped = b if max_steps is None else F.slice(b, 1, max_steps + 1)
    stops = F.filter(
        F.transform(capped, lambda x, i: F.when(x.isin(0, BLOCK_CLOSING_BYTE), i)), lambda i: i.isNotNull())
    stop = F.coalesce(F.try_element_at(stops, F.lit(1)), F.size(capped))
    length = F.greatest(stop - 2, F.lit(0))
    text = F.array_join(F.transform(F.slice(capped, F.lit(3), length), lambda x: F.char(x)), "")
    if keep_nul:
        closed = F.try_element_at(capped, (stop + 1).cast("int")) == 0
        text = F.when(closed & (stop >= 2), F.concat(text, F.decode(F.unhex(F.lit("00")), "UTF-8"))).otherwise(text)
    return text


def bytes_to_hex(data: Column | str, digits: int) -> Column:
    """First ``digits`` hex digits, upper case."""
    return F.substring(F.hex(_col(data)), 1, digits)


def utf8_decode(data: Column | str) -> Column:
    """Bytes to text."""
    return F.decode(_col(data), "UTF-8")


def random_id() -> Column:
    return F.uuid()


def now() -> Column:
    return F.current_timestamp()


def to_binary(text: Column | str) -> Column:
    return _col(text).cast("binary")


def nan_to_null(value: Column | str) -> Column:
    """NaN is a value of its own; this turns it into NULL where that is wanted."""
    c = _col(value)
    return F.when(~F.isnan(c), c)
