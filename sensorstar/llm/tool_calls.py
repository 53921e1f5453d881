"""Tool calls of conversations: linked with their results, ordered, checked, written.

Built-in functions only. Calls and results meet by a hash join on the conversation and
the call's id. A call may name others whose results it needs; it comes after them.
Arguments are checked against the tool's schema, and every call becomes one line of
canonical JSON: keys sorted, no white space.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import stored
from sensorstar.operators.numbering import number_rows_within
from sensorstar.session import broadcast_up_to

# Conversations with needs that point forward: two numbers each.
BROADCAST = 1_000_000

#: A tool's parameters: name, type (of ``TYPES``, or the texts that are allowed), whether
#: it must be given.
Schemas = dict[str, list[tuple[str, "str | tuple[str, ...]", bool]]]
COLUMNS = ["conv_id", "call_id", "order_no", "status", "errors", "n_results", "line"]
# Beginnings of the names that Spark has for values of each type.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}


def _member(name: str) -> Column:
    """A member of the arguments, whatever signs its name has."""
    return F.try_element_at(F.try_variant_get("parsed", "$", "map<string,variant>"), F.lit(name))


def _fits(value: Column, kind: str | tuple[str, ...]) -> Column:
    if not isinstance(kind, str):
        return F.schema_of_variant(value).startswith("STRING") & F.try_variant_get(value, "$", "string").isin(*kind)
    names = [F.schema_of_variant(value).startswith(name) for name in TYPES[kind]]
    return reduce(or_, names)


def _schema_errors(schemas: Schemas) -> Column:
    """What is wrong with ``arguments``, in the order of the schema, then of the names
    the schema does not have."""
    checks, allowed = [], F.array().cast("array<string>")
    for tool, parameters in schemas.items():
        mine = F.col("name") == tool
        allowed = F.when(mine, F.array(*[F.lit(p) for p, _, _ in parameters]).cast("array<string>")).otherwise(allowed)
        for parameter, kind, required in parameters:
            given = F.array_contains("given", parameter)
            fits = F.coalesce(_fits(_member(parameter), kind), F.lit(False))
            shown = kind if isinstance(kind, str) else "one of " + "|".join(kind)
            if required:
                checks.append(F.when(mine & ~given, F.lit(f"missing {parameter}")))
            checks.append(F.when(mine & given & ~fits, F.lit(f"not {shown}: {parameter}")))
    unknown = F.transform(F.array_sort(F.array_except("given", allowed)), lambda name: F.concat(F.lit("unknown "), name))
    found = F.concat(F.array(*checks), unknown) if checks else unknown
    no_tool = ~F.col("name").isin(*schemas)
    first = F.when(F.col("name").isNull(), F.lit("no tool")).when(no_tool, F.lit("unknown tool"))
    first = F.coalesce(first, F.when(F.col("given").isNull(), F.lit("arguments are not an object")))
    return F.when(first.isNotNull(), F.array(first)).otherwise(F.filter(found, lambda e: e.isNotNull()))


def _edges(known: DataFrame) -> DataFrame:
    """``(conv_id, number, needed)``: numbers of calls and of calls they need."""
    wanted = known.select("conv_id", "number", F.explode("needs").alias("need")).where("need is not null")
    there = known.select("conv_id", F.col("call_id").alias("need"), F.col("number").alias("needed"))
    return stored(wanted.join(there, ["conv_id", "need"]).select("conv_id", "number", "needed").distinct())


def _levels(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls of ``edges`` in topological order, and those in or behind a circle.

    A call is placed in the round after the last of what it needs: at the highest number
    it reaches, its own included, and one ``step`` behind what it needs there. What is
    left when a round places nothing needs itself in the end, or a call that does.
    Rounds follow the longest chain.
    """
    pairs = edges.groupBy("conv_id", "number").agg(F.count("*").alias("waiting"))
    place = F.struct(F.col("number").alias("place"), F.lit(0).cast("long").alias("step")).alias("at")
    waiting = stored(pairs.select("conv_id", "number", "waiting", place))
    ends = edges.select("conv_id", F.col("needed").alias("number")).distinct()
    placed = stored(ends.join(pairs, ["conv_id", "number"], "left_anti").select("conv_id", "number", place))
    found = placed
    while True:
        behind = F.struct(F.col("at.place").alias("place"), (F.col("at.step") + 1).alias("step"))
        reached = placed.select("conv_id", F.col("number").alias("needed"), behind.alias("behind"))
        met = edges.join(reached, ["conv_id", "needed"]).groupBy("conv_id", "number")
        met = met.agg(F.count("*").alias("met"), F.max("behind").alias("behind"))
        after = waiting.join(met, ["conv_id", "number"], "left").select(
            "conv_id",
            "number",
            (F.col("waiting") - F.coalesce("met", F.lit(0))).alias("waiting"),
            F.greatest("at", "behind").alias("at"),
        )
        after = stored(after)
        placed, waiting = after.where("waiting = 0").drop("waiting"), after.where("waiting > 0")
        if placed.isEmpty():
            return found.select("conv_id", "number", "at.*"), waiting.select("conv_id", "number")
        found = found.union(placed)


def _order(known: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """``(conv_id, number, place, step)`` of calls that may move, and ``(conv_id, number)``
    of those in or behind a circle; None where every call already follows what it needs.

    Only needs that point forward move anything or close a circle, and all that moves
    lies between the first and the last number such needs of a conversation touch. Calls
    in or behind a circle stay where they stand.
    """
    edges = _edges(known)
    forward = edges.where("needed >= number").groupBy("conv_id").agg(F.min("number").alias("low"), F.max("needed").alias("high"))
    forward = stored(forward)
    conversations = forward.count()
    if not conversations:
        return None
    inner = edges.join(broadcast_up_to(forward, conversations, BROADCAST), "conv_id")
    inner = stored(inner.where("number between low and high and needed between low and high").drop("low", "high"))
    placed, circles = _levels(inner)
    circles = stored(circles)
    newest = circles
    while not newest.isEmpty():
        reached = newest.select("conv_id", F.col("number").alias("needed"))
        behind = edges.join(reached, ["conv_id", "needed"]).select("conv_id", "number").distinct()
        newest = stored(behind.join(circles, ["conv_id", "number"], "left_anti"))
        circles = circles.union(newest)
    return placed, circles


def _numbered(calls: DataFrame) -> DataFrame:
    """Calls with their ``number`` by position in the conversation, null positions last;
    and whether each is the ``first`` row of its id. Equal rows are told apart by ``row``."""
    ties = ["position", "call_id", "tie", "row"]
    calls = stored(
        calls.withColumns({"tie": F.xxhash64("name", "arguments"), "row": F.monotonically_increasing_id(), "unplaced": F.col("position").isNull()})
    )
    numbered = number_rows_within(calls.where("conv_id is not null"), ["conv_id"], ["unplaced", *ties], "number")
    numbered = stored(numbered.unionByName(calls.where("conv_id is null"), allowMissingColumns=True).drop("tie", "row", "unplaced"))
    first = numbered.where("number is not null and call_id is not null").groupBy("conv_id", "call_id").agg(F.min("number").alias("number"))
    numbered = numbered.join(first.withColumn("first", F.lit(True)), ["conv_id", "call_id", "number"], "left")
    return numbered.withColumn("first", F.coalesce("first", F.col("call_id").isNull() | F.col("conv_id").isNull()))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas, needs: str = "after") -> DataFrame:
    """One row per call, and one per result without a call:
    ``conv_id, call_id, order_no, status, errors, n_results, line``.

    ``calls`` has ``conv_id, call_id, position, name, arguments`` (JSON text); ``results``
    has ``conv_id, call_id, position, content``. The argument ``needs`` names one call, or a
    list of them, that must come first; names that are not calls of the conversation do not
    count. ``order_no`` counts the calls of a conversation from 1 in an order in which each
    comes after all it needs, and moves only calls that need a later one: right behind it.

    ``status``: ``linked``; ``waiting`` (no result); ``repeated`` (the id was used at
    an earlier position, or in the same row before); ``cyclic`` (needs itself in the end, or
    a call that does, answered or not; it stays where it stood); ``orphan`` (a result without
    a call, not numbered; its line has its id and content).
    ``n_results`` counts a call's results. The line of the id's first call has them
    whatever its status: the first as ``result``, the others in order as
    ``later_results``. Null ids meet nothing: their calls wait, their results are orphans.
    Calls at one position follow their ids; a null position comes last. Of rows that repeat
    an id at its first position one is the first, the others are ``repeated``.
    Arguments that are null or no object leave ``errors`` and no arguments in the
    line. Empty tables give no rows. Further columns are not read.
    """
    calls = _numbered(calls.select("conv_id", "call_id", "position", "name", "arguments"))
    parsed = F.try_parse_json("arguments")
    is_object = F.startswith(F.schema_of_variant("parsed"), F.lit("OBJECT"))
    names = F.map_keys(F.from_json("arguments", "map<string,string>"))
    calls = calls.withColumn("parsed", parsed).withColumn("given", F.when(is_object, F.array_distinct(names)))
    needed = _member(needs)
    calls = stored(
        calls.select(
            "conv_id",
            "call_id",
            "number",
            "name",
            "first",
            F.when(is_object, F.to_json("parsed")).alias("arguments"),
            _schema_errors(schemas).alias("errors"),
            F.coalesce(F.try_variant_get(needed, "$", "array<string>"), F.array(F.try_variant_get(needed, "$", "string"))).alias("needs"),
        )
    )
    known = calls.where("first and call_id is not null and conv_id is not null")
    order = _order(known.select("conv_id", "call_id", "number", "needs"))

    results = results.select("conv_id", "call_id", "position", "content")
    in_order = F.sort_array(F.collect_list(F.struct(F.col("position").isNull().alias("unplaced"), "position", "content")))
    answers = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(in_order.alias("answers"))
    linked = calls.join(answers, ["conv_id", "call_id"], "left")
    linked = linked.withColumn("n_results", F.when(F.col("first"), F.size("answers")))
    linked = linked.withColumn("n_results", F.greatest(F.coalesce("n_results", F.lit(0)), F.lit(0)).cast("long"))
    if order is None:
        linked = linked.withColumns({"cyclic": F.lit(False), "order_no": F.col("number")})
    else:
        placed, circles = order
        spots = calls.where("conv_id is not null").select("conv_id", "number").join(placed, ["conv_id", "number"], "left")
        spots = spots.join(circles.withColumn("cyclic", F.lit(True)), ["conv_id", "number"], "left")
        spots = spots.withColumns({"place": F.coalesce("place", "number"), "step": F.coalesce("step", F.lit(0).cast("long"))})
        spots = number_rows_within(spots, ["conv_id"], ["place", "step", "number"], "order_no")
        linked = linked.join(spots.select("conv_id", "number", "cyclic", "order_no"), ["conv_id", "number"], "left")
    status = (
        F.when(~F.col("first"), "repeated")
        .when(F.coalesce("cyclic", F.lit(False)), "cyclic")
        .when(F.col("n_results") > 0, "linked")
        .otherwise("waiting")
    )
    result = F.when(F.col("n_results") > 0, F.get("answers", F.lit(0))["content"]).alias("result")
    later = F.when(F.col("n_results") > 1, F.transform(F.slice("answers", 2, F.size("answers")), lambda a: a["content"])).alias("later_results")
    quoted = F.to_json(F.struct(F.col("call_id").alias("id"), later, "name", result))
    rest = F.substring(quoted, 2, 1 << 30)
    arguments = F.coalesce(F.concat(F.lit('"arguments":'), "arguments", F.when(rest == "}", "").otherwise(",")), F.lit(""))
    line = F.concat(F.lit("{"), arguments, rest)
    errors = F.array_join("errors", "; ")
    rows = linked.withColumns({"status": status, "errors": errors, "line": line}).select(COLUMNS)
    orphans = results.join(known.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti").select(
        "conv_id",
        "call_id",
        F.lit(None).cast("long").alias("order_no"),
        F.lit("orphan").alias("status"),
        F.lit("").alias("errors"),
        F.lit(1).cast("long").alias("n_results"),
        F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result"))).alias("line"),
    )
    return rows.union(orphans)


# The tools that the turns of the conversations table are read as calls of.
TOOLS: Schemas = {
    "search": [("after", "string", False), ("limit", "integer", True), ("query", "string", True)],
    "measure": [("text", "string", True), ("unit", "string", True)],
    "remember": [("after", "string", False), ("text", "string", True)],
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from whole turns: a user's turn is a call, an assistant's turn
    the result of the call one turn earlier. The text's length picks the tool. Some
    calls need the call two turns earlier or later, some lack an argument, have one of
    another type or break off, and some results have another id."""
    turn, text = F.col("turn").cast("long"), F.coalesce("text", F.lit(""))

    def named(number: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), number)

    users = conversations.where("role = 'user'")
    kind, fault = F.length(text) % 3, (F.col("conv_id") + turn) % 10
    limit = F.when(fault == 3, F.to_json(F.struct(F.lit("many").alias("limit")))).otherwise(F.to_json(F.struct((turn + 1).alias("limit"))))
    search = F.concat(
        F.lit('{"after":"'), named(turn + 2), F.lit('",'), F.substring(limit, 2, 1 << 30)
    )
    search = F.concat(F.regexp_replace(search, r"\}$", ""), F.lit(","), F.substring(F.to_json(F.struct(text.alias("query"))), 2, 1 << 30))
    measure = F.to_json(F.struct(text.alias("text"), F.when(fault != 5, "words").alias("unit")))
    remember = F.to_json(F.struct(F.when(turn >= 2, named(turn - 2)).alias("after"), text.alias("text")))
    arguments = F.when(fault == 7, F.lit('{"text":')).when(kind == 0, search).when(kind == 1, measure).otherwise(remember)
    name = F.when(kind == 0, "search").when(kind == 1, "measure").otherwise("remember")
    calls = users.select("conv_id", named(turn).alias("call_id"), turn.alias("position"), name.alias("name"), arguments.alias("arguments"))
    answers = conversations.where("role = 'assistant'")
    lost = (F.col("conv_id") + turn) % 13 == 5
    call_id = F.when(lost, F.concat(F.lit("lost_"), F.col("conv_id"), F.lit("_"), turn)).otherwise(named(turn - 1))
    results = answers.select("conv_id", call_id.alias("call_id"), turn.alias("position"), F.col("text").alias("content"))
    return calls, results


def other_turns(conversations: DataFrame) -> DataFrame:
    """Turns that are neither calls nor results, in the columns of ``link_calls``: not
    numbered, with their content, role and turn as the line."""
    role = F.col("role")
    others = conversations.where(role.isNull() | ~role.isin("user", "assistant"))
    line = F.to_json(F.struct(F.col("text").alias("content"), "role", "turn"))
    return others.select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("long").alias("order_no"),
        F.lit("turn").alias("status"),
        F.lit("").alias("errors"),
        F.lit(0).cast("long").alias("n_results"),
        line.alias("line"),
    )


def conversation_calls(conversations: DataFrame) -> DataFrame:
    """The turns of the conversations table as linked calls, and those of further
    roles as they are."""
    return link_calls(*turns_as_calls(conversations), TOOLS).union(other_turns(conversations))
