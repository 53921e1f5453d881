"""Text expressions: topics, names, trimming, repair of wrongly decoded text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace that JSON readers and text stripping ignore.
WHITESPACE = " \t\r\n\f\x0b"
# Fixed value: path parts that name a table when a cluster of topics has them.
TABLE_KEYWORDS = "(energo|dcuk|camea|ttndata|bilina|cez|decin|mve)"
# A text that is a column name already.
COLUMN_NAME = r"^[a-z][a-z0-9]*(_[a-z0-9]+)*\z"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank_to_null(text: Column) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(text), F.lit(""))


def null_to_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def city_from_topic(topic: Column) -> Column:
    """First part of ``/city/a/b…``; any other shape has no known city."""
    parts = F.split(F.btrim(topic, F.lit("/")), "/")
    return F.when(topic.startswith("/") & (F.size(parts) >= 3), parts[0]).otherwise(F.lit("Unknown"))


def city_by_position(topic: Column) -> Column:
    """The part after the first slash, whatever the number of parts."""
    return blank_to_null(F.split_part(topic, F.lit("/"), F.lit(2)))


def column_name(path: Column) -> Column:
    """A safe column name: lower case, runs of other signs become one ``_``."""
    return leading_letter(F.btrim(F.regexp_replace(F.lower(path), "[^a-z0-9]+", "_"), F.lit("_")))


def leading_letter(name: Column) -> Column:
    """``col_`` before a name that is empty or starts with a digit."""
    return F.regexp_replace(name, "^(?=[0-9]|$)", "col_")


def legacy_column_name(path: Column, when_empty: str) -> Column:
    """Older naming: outer ``_`` dropped, ``-`` and ``.`` become ``_``."""
    name = F.translate(F.lower(F.btrim(path, F.lit("_"))), "-.", "__")
    return F.when(name == "", F.lit(when_empty)).otherwise(name)


def topic_parts(topic: Column) -> Column:
    return F.filter(F.split(topic, "/"), lambda part: part != "")


def logical_topic(topic: Column, depth: int = 3) -> Column:
    """The first ``depth`` path parts; topics that agree on them load together."""
    return F.concat(F.lit("/"), F.array_join(F.slice(topic_parts(topic), 1, depth), "/"))


def topic_table(topic: Column) -> Column:
    """Staging table name of one topic."""
    flat = F.translate(F.btrim(topic, F.lit("/")), "-:./", "____")
    return F.lower(F.concat(F.lit("stg_"), F.regexp_replace(flat, "__", "_")))


def _central_signs() -> tuple[str, str, str]:
    """The upper signs of Windows-1250, the Latin-1 signs of the same bytes, and the Latin-1
    signs of bytes it does not have; from the codec itself."""
    upper = [bytes([b]) for b in range(128, 256)]
    known = [b for b in upper if b.decode("cp1250", errors="ignore")]
    lacking = "".join(b.decode("latin-1") for b in upper if b not in known)
    return "".join(b.decode("cp1250") for b in known), "".join(b.decode("latin-1") for b in known), lacking


def decode_bytes(payload: Column) -> Column:
    """Bytes to text: UTF-8, else Windows-1250, else Latin-1.

    Spark has no Windows-1250 decoder, so the Latin-1 text is translated sign by sign.
    """
    signs, same_bytes, lacking = _central_signs()
    latin = F.decode(payload, "ISO-8859-1")
    text = payload.cast("string")
    return (
        F.when(F.is_valid_utf8(text), text)
        .when(F.translate(latin, lacking, "") == latin, F.translate(latin, same_bytes, signs))
        .otherwise(latin)
    )


def encode_central(text: Column) -> Column:
    """Text to the bytes of Windows-1250, ``?`` for signs it does not have."""
    signs, same_bytes, _ = _central_signs()
    kept = F.regexp_replace(text, f"[^\\x00-\\x7F{signs}]", "?")
    return F.encode(F.translate(kept, signs, same_bytes), "ISO-8859-1")


def encode_latin(text: Column) -> Column:
    """Text to the bytes of Latin-1, ``?`` for signs it does not have."""
    return F.encode(F.regexp_replace(text, "[^\\x00-\\xFF]", "?"), "ISO-8859-1")


def repair_utf8_read_as_latin1(text: Column) -> Column:
    """Undo UTF-8 bytes that were read as Latin-1; what cannot be undone is dropped."""
    only_latin = F.regexp_replace(text, "[^\\x00-\\xFF]", "")
    redone = F.make_valid_utf8(F.encode(only_latin, "ISO-8859-1").cast("string"))
    return F.translate(redone, "�", "")
