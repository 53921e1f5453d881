"""Nested payloads to flat ``(path, value)`` leaves, inside the row.

Each level rewrites the list of entries of a row: an object becomes one entry per
member, a list one per element, a scalar stays. Nothing is exploded or shuffled
until leaves are asked for as rows. The number of levels follows the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.functions import payload as P
from sensorstar.functions.text import COLUMN_NAME, column_name, leading_letter, legacy_column_name, once, strip
from sensorstar.session import spread

# Levels that a payload takes besides its nesting: text that is not JSON is first
# wrapped as ``raw_value``, and the scalars inside the last container are read.
_WRAPPED = 2
# Opening brackets that are taken as levels without looking at where they stand.
_SHALLOW = 3


def nesting(payload: Column) -> Column:
    """How deep a text nests at most: its own brackets, plus all opening brackets of
    one of its strings (a string may hold JSON again). A text that ends inside a
    string may be no JSON; all its opening brackets count."""
    return _nesting(_signs(payload), _opening(payload))


def _opening(payload: Column) -> Column:
    without = [F.length(F.replace(payload, F.lit(sign), F.lit(""))) for sign in "{["]
    return 2 * F.length(payload) - without[0] - without[1]


def _signs(payload: Column) -> Column:
    """Brackets and quotes of a text in their order, without escaped ones."""
    return F.regexp_replace(F.regexp_replace(payload, r"\\.", ""), r'[^\[\]{}"]+', "")


def _nesting(written: Column, opening: Column) -> Column:
    signs = F.filter(F.split(written, ""), lambda sign: sign != "")

    def state(depth: Column, most: Column, inside: Column, text: Column) -> Column:
        return F.struct(depth.alias("depth"), most.alias("most"), inside.alias("inside"), text.alias("text"))

    def step(s: Column, sign: Column) -> Column:
        opens = sign.isin("{", "[")
        quote = sign == '"'
        outside = ~s["inside"] & ~quote
        down = F.greatest(s["depth"] - 1, F.lit(0))
        depth = F.when(~outside, s["depth"]).when(opens, s["depth"] + 1).otherwise(down)
        text = F.when(quote, F.lit(0)).when(s["inside"] & opens, s["text"] + 1).otherwise(s["text"])
        return state(depth, F.greatest(s["most"], depth + text), s["inside"] != quote, text)

    zero = F.lit(0)
    found = F.aggregate(signs, state(zero, zero, F.lit(False), zero), step)
    return once(found, lambda s: F.when(s["inside"], opening).otherwise(s["most"]))


def nesting_bound(rows: DataFrame, column: str = "payload") -> int:
    """Levels that every payload of ``rows`` needs at most; more change nothing. Only texts
    with more opening brackets than a few are read sign by sign, and of those with the same
    brackets and quotes in the same order one."""
    opening = _opening(F.col(column))
    shapes = rows.select(opening.alias("_opening"), F.when(opening > _SHALLOW, _signs(F.col(column))).alias("_signs")).distinct()
    opening = F.col("_opening")
    deep = F.when(opening <= _SHALLOW, opening).otherwise(_nesting(F.col("_signs"), opening))
    return (shapes.agg(F.max(deep)).first()[0] or 0) + _WRAPPED


def _entry(path: Column, value: Column, done: Column | bool = False) -> Column:
    """``done`` marks a leaf: later levels pass it on unread."""
    done = done if isinstance(done, Column) else F.lit(done)
    return F.struct(path.alias("path"), value.alias("value"), done.alias("done"))


def _expand(rows: DataFrame, column: str, step: Callable[[Column], Column], levels: int) -> DataFrame:
    """One column update per level: a single nested expression would take the
    analyzer more passes than it allows."""

    def level(entry: Column) -> Column:
        return F.when(entry["done"], F.array(entry)).otherwise(step(entry))

    def expanded(entries: Column) -> Column:
        unfinished = F.exists(entries, lambda entry: ~entry["done"])
        return F.when(unfinished, F.flatten(F.transform(entries, level))).otherwise(entries)

    for _ in range(levels):
        rows = rows.withColumn(column, once(F.col(column), expanded))
    return rows


def value_in_text(scalar: Column) -> Column:
    """The JSON value written in a text, single quotes allowed; NULL if none is."""
    return once(
        strip(P.text_of(scalar)), lambda text: F.when(P.bracketed(text), P.json_value(P.double_quoted(text)))
    )


def _may_hold_json(value: Column) -> Column:
    """Whether the text of a scalar has a bracket that JSON could end with."""
    return F.coalesce(P.text_of(value).rlike(r"[}\]]"), F.lit(False))


def _is_leaf(value: Column) -> Column:
    return P.as_object(value).isNull() & P.as_list(value).isNull() & ~_may_hold_json(value)


def _by_position(entry: Column) -> Column:
    path, value = entry["path"], entry["value"]

    def named(key: Column) -> Column:
        joined = F.lower(F.concat(path, key))
        return F.concat(F.when(joined.rlike(COLUMN_NAME), joined).otherwise(column_name(joined)), F.lit("_"))

    def numbered(i: Column) -> Column:
        return F.concat(path, i.cast("string"), F.lit("_"))

    def children(v: Column) -> Column:
        return F.coalesce(
            F.transform(F.map_entries(P.as_object(v)), lambda kv: _entry(named(kv["key"]), kv["value"], _is_leaf(kv["value"]))),
            F.transform(P.as_list(v), lambda item, i: _entry(numbered(i), item, _is_leaf(item))),
        )

    def scalar(inner: Column) -> Column:
        return F.coalesce(children(inner), F.array(_entry(path, F.coalesce(inner, value), done=True)))

    leaf = F.array(_entry(path, value, done=True))
    return F.coalesce(children(value), F.when(_may_hold_json(value), once(value_in_text(value), scalar)).otherwise(leaf))


def _members(entry: Column, blank_key: str | None) -> Column:
    """Object members under their plain names."""

    def named(key: Column) -> Column:
        shown = key if blank_key is None else F.when(key == "", F.lit(blank_key)).otherwise(strip(key))
        return F.concat(entry["path"], shown, F.lit("_"))

    return F.transform(F.map_entries(P.as_object(entry["value"])), lambda kv: _entry(named(kv["key"]), kv["value"]))


def _list_as_text(entry: Column) -> Column:
    path = F.when(entry["path"] == "", F.lit("array_")).otherwise(entry["path"])
    return F.when(P.as_list(entry["value"]).isNotNull(), F.array(_entry(path, P.text_of(entry["value"]).cast("variant"), done=True)))


def _by_first_element(entry: Column) -> Column:
    """A list of containers is represented by its first element."""
    first = F.get(P.as_list(entry["value"]), F.lit(0))
    container = P.as_object(first).isNotNull() | P.as_list(first).isNotNull()
    represented = F.when(container, F.array(_entry(F.concat(entry["path"], F.lit("array_")), first)))
    return F.coalesce(_members(entry, None), represented, _list_as_text(entry), _leaf(entry))


def _by_list_text(entry: Column) -> Column:
    return F.coalesce(_members(entry, "unknown"), _list_as_text(entry), _leaf(entry))


def _leaf(entry: Column) -> Column:
    return F.array(_entry(entry["path"], entry["value"], done=True))


def _name_by_position(path: Column) -> Column:
    name = F.btrim(path, F.lit("_"))
    return F.when(F.left(path, F.lit(1)).between("a", "z"), name).otherwise(leading_letter(name))


# mode -> (one level, leaf path to column name)
MODES: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "index": (_by_position, _name_by_position),
    "first": (_by_first_element, lambda path: legacy_column_name(path, "value")),
    "text": (_by_list_text, lambda path: legacy_column_name(F.when(path == "", F.lit("value")).otherwise(path), "col_1")),
}


def with_leaves(rows: DataFrame, value: str, levels: int, mode: str = "index") -> DataFrame:
    """Adds ``leaves``, the leaves of a VARIANT column as ``array<struct<path,
    value>>``; empty containers vanish. When two members get the same name, the
    first in raw key order stays; in the older modes the last."""
    step, name = MODES[mode]
    start = F.when(F.col(value).isNotNull(), F.array(_entry(F.lit(""), F.col(value))))
    rows = _expand(rows.withColumn("leaves", start), "leaves", step, levels)

    def named(entry: Column) -> Column:
        return F.struct(name(entry["path"]).alias("path"), entry["value"].alias("value"))

    kept = _first_of_each_name if mode == "index" else _last_of_each_name
    return rows.withColumn("leaves", once(F.transform("leaves", named), kept))


def _first_of_each_name(entries: Column) -> Column:
    paths = F.transform(entries, lambda e: e["path"])
    unique = F.size(F.array_distinct(paths)) == F.size(entries)
    first = once(paths, lambda p: F.filter(entries, lambda e, i: F.array_position(p, e["path"]) == i + 1))
    return F.when(unique, entries).otherwise(first)


def _last_of_each_name(entries: Column) -> Column:
    return F.reverse(_first_of_each_name(F.reverse(entries)))


def flattened(landing: DataFrame, levels: int | None = None) -> DataFrame:
    """Landing rows with ``leaves``: every payload value under its column name."""
    landing = spread(landing)
    depth = nesting_bound(landing) if levels is None else levels
    parsed = landing.withColumn("_value", P.tolerant_payload(F.col("payload")))
    return with_leaves(parsed, "_value", depth).drop("_value")


def leaf_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per leaf: ``path``, the VARIANT ``value``, its ``kind`` and ``text``."""
    # explode_outer: the filter that explode implies would compute the leaves twice
    exploded = rows.select(*keep, F.explode_outer("leaves").alias("_leaf")).where(F.col("_leaf").isNotNull())
    value = F.col("_leaf")["value"]
    return exploded.select(
        *keep, F.col("_leaf")["path"].alias("path"), value.alias("value"), P.kind(value).alias("kind"), P.text_of(value).alias("text")
    )


def element_rows(landing: DataFrame) -> DataFrame:
    """A list payload gives one row per element; text that is not JSON gives an
    object with the text as ``value``."""
    text = F.struct(F.col("payload").alias("value"))
    value = F.coalesce(P.json_value(F.col("payload")), F.when(F.col("payload").isNotNull(), F.to_variant_object(text)))
    parsed = landing.withColumn("_value", value)
    parsed = parsed.withColumn("_items", F.coalesce(P.as_list(F.col("_value")), F.array("_value")))
    items = parsed.select("*", F.posexplode_outer("_items").alias("element", "value")).drop("_value", "_items")
    return items.where(F.col("element").isNotNull())


def flattened_elements(landing: DataFrame, mode: str, levels: int | None = None) -> DataFrame:
    landing = spread(landing)
    depth = nesting_bound(landing) if levels is None else levels
    return with_leaves(element_rows(landing), "value", depth, mode).drop("value")


# ---- structure signatures -------------------------------------------------------------


def _state(name: Column, value: Column, done: Column) -> Column:
    return F.struct(name.alias("name"), value.alias("value"), done.cast("boolean").alias("done"))


def _signature_step(state: Column) -> Column:
    name, value, open_ = state["name"], state["value"], F.lit(False)

    def from_text(found: Column) -> Column:
        inner = P.json_value(F.when(P.only_single_quotes(strip(found)), P.double_quoted(found)).otherwise(found))
        scalar = F.array(_state(F.concat(_without_last(name), F.lit(":scalar")), value, F.lit(True)))
        opened = once(
            inner,
            lambda v: F.when(v.isNotNull(), F.array(_state(F.concat(name, F.lit("subjson:object_")), v, open_))),
        )
        return F.when(P.looks_like_json(found), F.coalesce(opened, scalar))

    members = F.transform(
        F.map_entries(P.as_object(value)),
        lambda kv: _state(F.concat(name, kv["key"], F.lit(":object_")), kv["value"], open_),
    )
    listed = F.transform(F.slice(P.as_list(value), 1, 1), lambda v: _state(F.concat(name, F.lit("array:")), v, open_))
    return F.coalesce(members, listed, once(P.text_of(value), from_text), F.array(state))


def _without_last(name: Column) -> Column:
    return F.coalesce(F.nullif(F.left(name, F.length(name) - 1), F.lit("")), F.lit("value"))


def with_signature(rows: DataFrame, value: str, levels: int) -> DataFrame:
    """Adds ``keys``, the sorted set of paths and kinds in a payload; equal for
    payloads of the same structure whatever their values."""
    rows = rows.withColumn("keys", F.array(_state(F.lit(""), F.col(value), F.lit(False))))
    rows = _expand(rows, "keys", _signature_step, levels)

    def named(state: Column) -> Column:
        plain = F.concat(_without_last(state["name"]), F.lit(":value"))
        return F.translate(F.lower(F.when(state["done"], state["name"]).otherwise(plain)), "-.", "__")

    return rows.withColumn("keys", F.array_sort(F.array_distinct(F.transform("keys", named))))


def topic_structures(latest: DataFrame, levels: int | None = None) -> DataFrame:
    """Structure keys per topic from its newest payload; no keys, no row."""
    # text inside text needs a level to open it besides the level of its members
    depth = 2 * (nesting_bound(latest) if levels is None else levels) + 1
    parsed = latest.withColumn("_value", P.first_of_list(P.json_value(F.col("payload"))))
    parsed = parsed.where(F.col("_value").isNotNull())
    return with_signature(parsed, "_value", depth).select("topic", "keys").where(F.size("keys") > 0)


def topic_columns(latest: DataFrame, levels: int | None = None) -> DataFrame:
    """Flattened key names per topic (lists by their first element)."""
    depth = nesting_bound(latest) if levels is None else levels
    parsed = latest.withColumn("_value", P.first_of_list(P.json_value(F.col("payload"))))
    parsed = parsed.where(F.col("_value").isNotNull())
    paths = F.transform("leaves", lambda e: e["path"])
    keyed = with_leaves(parsed, "_value", depth, "first").select("topic", F.array_sort(paths).alias("keys"))
    return keyed.where(F.size("keys") > 0)
