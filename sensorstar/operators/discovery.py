"""Schema discovery: column types, new columns, conformance, wide staging."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.functions import numbers
from sensorstar.functions import payload as P
from sensorstar.session import broadcast_counted, pinned

# Dates and times in ISO form (calendar or week dates).
ISO_TIME = (
    r"^\d{4}(-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])|(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])"
    r"|-W(0[1-9]|[1-4]\d|5[0-3])(-[1-7])?|W(0[1-9]|[1-4]\d|5[0-3])[1-7]?)"
    r"(.([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?)?)?$"
)
# Fixed value: digits with at most one point.
DIGITS = r"^\s*([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"

# A whole number written out.
WHOLE = r"^\s*[+-]?[0-9]+\s*$"

# Column type -> Spark type of its values.
SPARK_TYPES = {
    "BOOLEAN": "boolean",
    "BIGINT": "bigint",
    "DOUBLE PRECISION": "double",
    "TIMESTAMPTZ": "timestamp_ntz",
    "JSONB": "string",
    "TEXT": "string",
}

# Column types that a value may not fit.
CHECKED_TYPES = ("BIGINT", "DOUBLE PRECISION", "BOOLEAN", "TIMESTAMPTZ")

# Room for a type number (from 1) beside an id in one long.
_CODES = 8


def real_date(text: Column) -> Column:
    """Whether the date that a text in ISO form starts with exists: day of the month,
    week of the year (53 only where the year has it), year from 1 on."""
    year, rest = F.left(text, F.lit(4)), F.replace(F.substring(text, 5, 10), F.lit("-"))
    week = F.substring(rest, 2, 2).try_cast("int")
    weeks = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    day = F.concat_ws("-", year, F.substring(rest, 1, 2), F.substring(rest, 3, 2)).try_cast("date")
    exists = F.when(rest.startswith("W"), week <= weeks).otherwise(day.isNotNull())
    return F.coalesce((year != "0000") & exists, F.lit(False))


def column_type(value: Column, numeric_text: bool = True) -> Column:
    """The column type a value asks for. A missing value asks for text.

    Without ``numeric_text``, digits in a text stay text.
    """
    kind, text = P.kind(value), P.text_of(value)
    whole = F.schema_of_variant(value).rlike(r"^DECIMAL\(\d+,0\)$") & ~text.contains(".")
    found = (
        F.when(kind == "BOOLEAN", F.lit("BOOLEAN"))
        .when((kind == "BIGINT") | whole, F.lit("BIGINT"))
        .when(kind.isin("DECIMAL", "DOUBLE", "FLOAT"), F.lit("DOUBLE PRECISION"))
        .when(kind.isin("OBJECT", "ARRAY"), F.lit("JSONB"))
        .when(text.rlike(ISO_TIME) & real_date(text), F.lit("TIMESTAMPTZ"))
    )
    if numeric_text:
        found = found.when(text.rlike(DIGITS), F.lit("DOUBLE PRECISION"))
    return found.otherwise(F.lit("TEXT"))


def catalogue(leaves: DataFrame, group: str = "topic", numeric_text: bool = True) -> DataFrame:
    """One row per group and path; the value seen first decides the type.

    Id and type are packed into one number, whose minimum is the first value's:
    that keeps the aggregation in hash tables, without sorting the leaves. The
    result is metadata: its size follows the number of paths, not of messages.
    """
    names = list(SPARK_TYPES)
    kind = column_type(F.col("value"), numeric_text)
    code = F.array_position(F.array(*[F.lit(n) for n in names]), kind)
    packed = leaves.select(F.col(group), "path", (F.col("id") * _CODES + code).alias("_packed"))
    found = packed.groupBy(group, "path").agg(F.min("_packed").alias("_first"), F.count("*").alias("leaves"))
    first_code = F.pmod("_first", F.lit(_CODES)).cast("int")
    return found.select(
        group,
        "path",
        F.element_at(F.array(*[F.lit(n) for n in names]), first_code).alias("type"),
        F.shiftright((F.col("_first") - first_code), 3).alias("first_seen_id"),
        "leaves",
    )


def safe_types(leaves: DataFrame, group: str = "topic") -> DataFrame:
    """Per group and path, the type that all its values share."""
    return leaves.groupBy(F.col(group), "path").agg(F.schema_of_variant_agg("value").alias("type"))


def added_columns(found: DataFrame, known: DataFrame, group: str = "topic") -> DataFrame:
    """Columns a table does not have yet, with the type to create them with."""
    by = list(dict.fromkeys([group, "path"]))
    return found.join(known.select(*by), by, "left_anti")


def evolved(known: DataFrame, found: DataFrame, group: str = "topic") -> DataFrame:
    """The catalogue after a load: types of known columns never change."""
    return known.unionByName(added_columns(found, known, group))


def batch_columns(leaves: DataFrame, *by: str) -> DataFrame:
    """Sorted column names that occur in each batch."""
    names = leaves.select(*by, "path").distinct()
    return names.groupBy(*by).agg(F.array_sort(F.collect_set("path")).alias("columns"))


def as_number(value: Column) -> Column:
    """A number, a flag as 0 or 1, or the number written in a text."""
    text = F.when(P.kind(value) == "STRING", P.text_of(value))
    other = F.when(P.kind(value) != "STRING", F.try_variant_get(value, "$", "double"))
    return F.coalesce(other, numbers.number_or_null(text))


def conformed(value: Column, column_type_name: str) -> Column:
    """The value in its column's type, NULL when it does not fit."""
    if column_type_name == "BIGINT":
        # Digits alone are exact beyond 2^53; only fractions and powers go through a double.
        exact = F.when(P.text_of(value).rlike(WHOLE), F.trim(P.text_of(value)).try_cast("bigint"))
        other = F.when(~F.coalesce(P.text_of(value).rlike(WHOLE), F.lit(False)), as_number(value))
        return F.coalesce(exact, F.rint(other).try_cast("bigint"))
    if column_type_name == "DOUBLE PRECISION":
        return as_number(value)
    if column_type_name == "BOOLEAN":
        return F.when(P.kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    if column_type_name == "TIMESTAMPTZ":
        moment = P.text_of(value).try_cast("timestamp").cast("timestamp_ntz")
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment)
    return P.text_of(value)


def conform_leaves(leaves: DataFrame, columns: DataFrame, group: str = "topic") -> DataFrame:
    """Leaves beside their column's type, with the value in the column of its kind:
    ``whole`` for whole numbers, exactly, ``number`` for other numbers, ``text`` for the
    rest; and whether the value had to be dropped because it does not fit."""
    # The catalogue is small and joined to every leaf; a shuffle by path would
    # put all leaves of a common path into one task.
    known = pinned(columns.select(group, "path", "type"))
    typed = leaves.join(broadcast_counted(known), [group, "path"])
    value, kind = F.col("value"), F.col("type")
    found = typed.withColumn("whole", F.when(kind == "BIGINT", conformed(value, "BIGINT")))
    found = found.withColumn("number", F.when(kind == "DOUBLE PRECISION", as_number(value)))
    fits = F.coalesce("whole", "number").isNotNull()
    for name in ("BOOLEAN", "TIMESTAMPTZ"):
        fits = fits | ((kind == name) & conformed(value, name).isNotNull())
    plain = kind.isin("TEXT", "JSONB")
    found = found.withColumn("rejected", F.col("text").isNotNull() & ~plain & ~fits)
    numeric = kind.isin("BIGINT", "DOUBLE PRECISION")
    return found.withColumn("text", F.when(~numeric | F.col("rejected"), F.col("text")))


def wide(
    rows: DataFrame, keep: Sequence[str], columns: Mapping[str, str], name: Callable[[str], str] = lambda path: path
) -> DataFrame:
    """One row per message with one typed column per path; a projection, no shuffle.

    ``columns`` maps path to column type; a path a message lacks is NULL.
    """
    mapped = rows.withColumn("_map", F.map_from_entries("leaves"))
    typed = [conformed(F.try_element_at("_map", F.lit(path)), kind).alias(name(path)) for path, kind in sorted(columns.items())]
    return mapped.select(*keep, *typed)


def column_types(columns: DataFrame) -> dict[str, str]:
    """The catalogue of one table, on the driver (metadata only)."""
    return {row["path"]: row["type"] for row in columns.select("path", "type").collect()}
