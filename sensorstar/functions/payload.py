"""JSON payload expressions on VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorstar.functions.text import once, strip

CAMERA_STRUCT = (
    "detectionType string, utc string, lp string, sensor string, "
    "vehClass string, ilpc string, velocity string"
)

# Signs a JSON value starts with, and the blanks that may come before it.
_JSON_STARTS = '{["-0123456789tfn \t\r\n'


def camera_list(payload: Column) -> Column:
    """The camera fields as text, in a list of one unless the payload is bad.

    The payload is read as the only element of a list, because a reader of a bare
    object ignores text that follows it.
    """
    return F.from_json(
        F.concat(F.lit("["), payload, F.lit("]")), f"array<struct<{CAMERA_STRUCT}>>", {"allowSingleQuotes": "false"}
    )


def json_value(text: Column) -> Column:
    """The VARIANT of a text that is one whole JSON value, else NULL.

    Spark's parser ignores text after the first value. The text is read as the first of two
    elements of a list, whose second is the text's own digest: a text that closes the list
    itself would have to hold its digest to have a tail. A text that starts like no JSON
    value is not parsed.
    """

    def read(digest: Column) -> Column:
        marked = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]')))

        def first(items: Column) -> Column:
            return F.when((F.size(items) == 2) & (text_of(F.get(items, F.lit(1))) == digest), F.get(items, F.lit(0)))

        return once(as_list(marked), first)

    return F.when(F.contains(F.lit(_JSON_STARTS), F.left(text, F.lit(1))), once(F.md5(text), read))


def double_quoted(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit('"'))


def looks_like_json(text: Column) -> Column:
    """Starts and ends like an object or like a list."""
    return bracketed(strip(text))


def bracketed(stripped: Column) -> Column:
    return (stripped.startswith("{") & stripped.endswith("}")) | (stripped.startswith("[") & stripped.endswith("]"))


def only_single_quotes(text: Column) -> Column:
    return text.startswith("{") & text.contains("'") & ~text.contains('"')


def as_object(value: Column) -> Column:
    """Members of an object, NULL for any other value."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_list(value: Column) -> Column:
    """Elements of a list, NULL for any other value."""
    return F.try_variant_get(value, "$", "array<variant>")


def kind(value: Column) -> Column:
    """``OBJECT``, ``ARRAY``, ``VOID``, ``BOOLEAN``, ``BIGINT``, ``DECIMAL``, ``DOUBLE`` or ``STRING``."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def tolerant_payload(payload: Column) -> Column:
    """The VARIANT a message stands for, never failing on bad text.

    Valid JSON is taken as it is; an object written with single quotes only is
    read with double quotes; any other text becomes ``{"raw_value": text}``. A
    list holding one object stands for that object.
    """

    def read(text: Column) -> Column:
        # an object that holds single quotes and no double ones is no JSON as it stands
        written = once(F.when(only_single_quotes(text), double_quoted(text)).otherwise(text), json_value)
        return F.coalesce(
            written,
            F.when(text.isNotNull(), F.to_variant_object(F.struct(text.alias("raw_value")))),
        )

    return unwrapped(once(strip(payload), read))


def unwrapped(value: Column) -> Column:
    """The object of a one-element list, else the value itself."""

    def only_object(v: Column) -> Column:
        first = F.when(F.size(as_list(v)) == 1, F.try_variant_get(v, "$[0]", "variant"))
        return F.coalesce(F.when(as_object(first).isNotNull(), first), v)

    return once(value, only_object)


def first_of_list(value: Column) -> Column:
    """Element 0 of a non-empty list, else the value itself."""
    return once(value, lambda v: F.coalesce(F.when(F.size(as_list(v)) > 0, F.try_variant_get(v, "$[0]", "variant")), v))


def text_of(value: Column) -> Column:
    """Text of a scalar, JSON text of a container, NULL for JSON null."""
    return F.try_variant_get(value, "$", "string")
